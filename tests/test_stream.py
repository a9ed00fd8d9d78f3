from datetime import date
from pathlib import Path

import pytest
from test_ingest import SOURCE, audits, deliver, totals

from tripwright.sources.tables import Store, last_loaded_month, read_quarantine
from tripwright.sources.versions import create_file
from tripwright.streaming.landing_stream import ingest_new_months


@pytest.fixture
def run(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))

    def once():
        ingest_new_months(spark, store, landing, str(tmp_path / "progress"))

    return landing, store, once


def test_each_month_is_loaded_once(spark, run):
    landing, store, once = run
    deliver(spark, landing, "2024-01", 1, 2)
    deliver(spark, landing, "2024-02", 3)
    once()
    assert totals(spark, store) == [1, 2, 3]
    assert last_loaded_month(spark, store, SOURCE) == date(2024, 2, 1)
    once()  # nothing new
    assert len(audits(spark, store)) == 2
    deliver(spark, landing, "2024-03", 4)
    once()
    assert totals(spark, store) == [1, 2, 3, 4]
    assert [entry[0] for entry in audits(spark, store)] == ["2024-01", "2024-02", "2024-03"]


def test_a_part_that_arrives_later_does_not_displace_the_first(spark, run):
    landing, store, once = run
    deliver(spark, landing, "2024-01", 1, 2)
    once()
    later = spark.read.parquet(f"{landing}/yellow_tripdata_2024-01.parquet").limit(1)
    later.write.mode("append").parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    once()
    assert len(totals(spark, store)) == 3


def test_a_corrupt_month_is_set_aside_and_heals(spark, run):
    landing, store, once = run
    deliver(spark, landing, "2024-01", 1)
    create_file(spark, f"{landing}/yellow_tripdata_2024-02.parquet", "not Parquet")
    deliver(spark, landing, "2024-03", 3)
    once()
    assert totals(spark, store) == [1, 3]
    (note,) = read_quarantine(spark, store).collect()
    assert (note.month, note.healed) == ("2024-02", False) and note.error_message
    once()  # the same delivery is not tried again
    assert len(audits(spark, store)) == 3
    deliver(spark, landing, "2024-04", 4)
    once()
    assert totals(spark, store) == [1, 3, 4]
    (tmp := Path(f"{landing}/yellow_tripdata_2024-02.parquet")).rename(f"{landing}/old")
    deliver(spark, landing, "2024-02", 2)
    assert tmp.exists()
    once()
    assert totals(spark, store) == [1, 2, 3, 4]
    (note,) = read_quarantine(spark, store).collect()
    assert note.healed and note.error_message is None
