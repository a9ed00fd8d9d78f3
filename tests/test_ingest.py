from datetime import date, datetime
from decimal import Decimal

import pytest
from frames import CAMEL_ROW, frame

from tripwright.operators.reports import audit_report
from tripwright.plans import ingest
from tripwright.schemas import AUDIT, RAW, WATERMARK
from tripwright.sources.tables import (
    Store,
    last_loaded_month,
    read_audit,
    read_raw,
    read_watermark,
    set_last_loaded_month,
)

SOURCE = "nyc_taxi_yellow"
NOW = datetime(2024, 4, 10)


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


def deliver(spark, landing, month, *totals, vendor="VendorID", number=float, folder=""):
    """A monthly file with one trip per total, picked up on its first days."""
    rows = []
    for day, total in enumerate(totals, 1):
        row = {**CAMEL_ROW, "tpep_pickup_datetime": f"{month}-{day:02d} 08:00:00"}
        row |= {"tpep_dropoff_datetime": f"{month}-{day:02d} 08:30:00", "total_amount": float(total)}
        row["passenger_count"] = number(row["passenger_count"])
        row[vendor] = row.pop("VendorID")
        rows.append(row)
    df = frame(spark, *(rows or [CAMEL_ROW]))
    df = df if rows else df.limit(0)
    path = f"{landing}/{folder}yellow_tripdata_{month}.parquet"
    df.coalesce(1).write.mode("overwrite").parquet(path)


def totals(spark, store, file=None):
    rows = read_raw(spark, store)
    if file:
        rows = rows.where(rows.source_file == f"yellow_tripdata_{file}.parquet")
    return sorted(row.total_amount for row in rows.collect())


def audits(spark, store):
    rows = read_audit(spark, store).collect()
    return sorted((row.month, row.status, row.rows_loaded) for row in rows)


def test_absent_tables_are_empty(spark, store):
    assert read_raw(spark, store).columns == RAW.names
    assert read_raw(spark, store).count() == 0
    assert read_watermark(spark, store).columns == WATERMARK.names
    assert read_audit(spark, store).columns == AUDIT.names
    assert last_loaded_month(spark, store, SOURCE) is None


def test_load_month(spark, store, landing):
    deliver(spark, landing, "2024-01", 1, 2, 3)
    ticks = iter([datetime(2024, 2, 1, 0, 0, 0), datetime(2024, 2, 1, 0, 1, 30, 555000)])
    result = ingest.load_month(spark, store, landing, "2024-01", clock=lambda: next(ticks))
    assert result == {"month": "2024-01", "rows_loaded": 3}
    raw = read_raw(spark, store)
    assert [f.dataType for f in raw.schema] == [f.dataType for f in RAW]
    assert {row.source_file for row in raw.collect()} == {"yellow_tripdata_2024-01.parquet"}
    assert last_loaded_month(spark, store, SOURCE) == date(2024, 1, 1)
    (audit,) = read_audit(spark, store).collect()
    assert tuple(audit) == (
        SOURCE, "2024-01", "yellow_tripdata_2024-01.parquet", "success", 3, None,
        datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 1, 30, 555000), Decimal("90.55"),
    )


def test_loading_again_replaces_only_that_month(spark, store, landing):
    deliver(spark, landing, "2024-01", 1, 2, 3)
    deliver(spark, landing, "2024-02", 7)
    ingest.load_months(spark, store, landing, ["2024-01", "2024-02"])
    ingest.load_months(spark, store, landing, ["2024-01", "2024-02"])
    assert totals(spark, store) == [1, 2, 3, 7]
    deliver(spark, landing, "2024-01", 5, 6)
    ingest.load_month(spark, store, landing, "2024-01")
    assert totals(spark, store) == [5, 6, 7]
    # unconditional: loading an older month moves the watermark back
    assert last_loaded_month(spark, store, SOURCE) == date(2024, 1, 1)
    assert len(audits(spark, store)) == 5


def test_an_emptied_file_empties_its_month(spark, store, landing):
    deliver(spark, landing, "2024-01", 1, 2)
    deliver(spark, landing, "2024-02", 7)
    ingest.load_months(spark, store, landing, ["2024-01", "2024-02"])
    deliver(spark, landing, "2024-01")
    assert ingest.load_month(spark, store, landing, "2024-01")["rows_loaded"] == 0
    assert totals(spark, store) == [7]
    deliver(spark, landing, "2024-01", 4)
    ingest.load_month(spark, store, landing, "2024-01")
    assert totals(spark, store) == [4, 7]


def test_headers_types_and_layouts_may_differ(spark, store, landing):
    deliver(spark, landing, "2024-01", 1, 2)
    deliver(spark, landing, "2024-02", 3, vendor="vendor_id", number=int)
    deliver(spark, landing, "2024-03", 4, folder="source_file=")
    loaded = ingest.load_months(spark, store, landing, ["2024-01", "2024-02", "2024-03"])
    assert [entry["rows_loaded"] for entry in loaded] == [2, 1, 1]
    rows = read_raw(spark, store).collect()
    assert {row.vendor_id for row in rows} == {2}
    assert {row.passenger_count for row in rows} == {4}
    assert totals(spark, store, "2024-03") == [4]


def test_a_plain_file_is_a_month(spark, store, landing, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "landing").mkdir()
    table = pa.table({name: [value] for name, value in CAMEL_ROW.items()})
    pq.write_table(table, f"{landing}/yellow_tripdata_2024-01.parquet")
    assert ingest.load_month(spark, store, landing, "2024-01")["rows_loaded"] == 1
    assert read_raw(spark, store).first().total_amount == Decimal("39.44")


def test_a_month_that_fails_is_audited_and_holds_up_no_other(spark, store, landing):
    deliver(spark, landing, "2024-01", 1, 2)
    ingest.load_month(spark, store, landing, "2024-01")
    deliver(spark, landing, "2024-01", 9)
    with pytest.raises(Exception, match="2024-02"):
        ingest.load_months(spark, store, landing, ["2024-01", "2024-02"])
    assert totals(spark, store) == [9]
    assert last_loaded_month(spark, store, SOURCE) == date(2024, 1, 1)
    assert audits(spark, store) == [
        ("2024-01", "success", 1), ("2024-01", "success", 2), ("2024-02", "error", None),
    ]
    errors = read_audit(spark, store).where("status = 'error'").collect()
    assert all("PATH_NOT_FOUND" in row.error_message for row in errors)


def test_a_bad_value_fails_the_load(spark, store, landing):
    deliver(spark, landing, "2024-01", 1e9)  # more than DECIMAL(10,2) holds
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        ingest.load_month(spark, store, landing, "2024-01")
    assert totals(spark, store) == []
    assert audits(spark, store) == [("2024-01", "error", None)]


def test_load_next_walks_to_the_running_month(spark, store, landing):
    for month in ("2024-01", "2024-02", "2024-03", "2024-04"):
        deliver(spark, landing, month, 1)
    assert ingest.load_next(spark, store, landing, now=NOW)["month"] == "2024-01"
    assert ingest.load_next(spark, store, landing, now=NOW)["month"] == "2024-02"
    assert [e["month"] for e in ingest.catch_up(spark, store, landing, now=NOW)] == [
        "2024-03", "2024-04",
    ]
    before = audits(spark, store)
    skipped = ingest.load_next(spark, store, landing, now=NOW)
    assert skipped == {"skipped": True, "reason": "nothing due"}
    assert ingest.catch_up(spark, store, landing, now=NOW) == []
    assert audits(spark, store) == before


def test_watermarks_of_sources_are_apart(spark, store):
    set_last_loaded_month(spark, store, "a", date(2024, 1, 1))
    set_last_loaded_month(spark, store, "b", date(2024, 5, 1))
    set_last_loaded_month(spark, store, "a", date(2024, 2, 1))
    assert last_loaded_month(spark, store, "a") == date(2024, 2, 1)
    assert last_loaded_month(spark, store, "b") == date(2024, 5, 1)
    assert read_watermark(spark, store).count() == 2


def test_audit_report_shows_the_latest_run_first(spark, store, landing):
    for month in ("2024-01", "2024-02"):
        deliver(spark, landing, month, 1)
        ingest.load_month(spark, store, landing, month)
    report = audit_report(read_audit(spark, store))
    assert report.columns == ["month", "status", "rows_loaded", "duration_secs", "started_at"]
    assert [row.month for row in report.collect()] == ["2024-02", "2024-01"]


def test_written_files_are_sorted_by_pickup(spark, store, landing):
    import glob

    import pyarrow.parquet as pq

    rows = [
        {**CAMEL_ROW, "tpep_pickup_datetime": f"2024-01-{1 + i * 7 % 28:02d} 08:00:00"} for i in range(28)
    ]
    frame(spark, *rows).coalesce(1).write.parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    deliver(spark, landing, "2024-02", 3, 2, 1)
    ingest.load_months(spark, store, landing, ["2024-01", "2024-02"])
    files = glob.glob(f"{store.raw}/data/*/*/*.parquet")
    assert len(files) == 2
    for file in files:
        pickups = pq.read_table(file, partitioning=None)["tpep_pickup_datetime"].to_pylist()
        assert pickups == sorted(pickups)


def test_catch_up_waits_for_what_nobody_delivered(spark, store, landing):
    deliver(spark, landing, "2024-01", 1)
    deliver(spark, landing, "2024-02", 2)
    assert [e["month"] for e in ingest.catch_up(spark, store, landing, now=NOW)] == [
        "2024-01", "2024-02",
    ]
    assert {status for _, status, _ in audits(spark, store)} == {"success"}


def test_catch_up_stops_at_a_gap_and_says_so(spark, store, landing):
    deliver(spark, landing, "2024-01", 1)
    deliver(spark, landing, "2024-03", 3)
    with pytest.raises(FileNotFoundError, match="2024-02"):
        ingest.catch_up(spark, store, landing, now=NOW)
    assert totals(spark, store) == [1]
    assert last_loaded_month(spark, store, SOURCE) == date(2024, 1, 1)
    assert audits(spark, store) == [("2024-01", "success", 1), ("2024-02", "error", None)]


def test_parts_of_a_month_may_have_different_headers(spark, store, landing, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "landing" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir(parents=True)
    renamed = {"VendorID": "vendor_id", "Airport_fee": "airport_fee"}
    for i, names in enumerate(({}, renamed)):
        table = pa.table({names.get(name, name): [value] for name, value in CAMEL_ROW.items()})
        pq.write_table(table, folder / f"part-{i}.parquet")
    assert ingest.load_month(spark, store, landing, "2024-01")["rows_loaded"] == 2
    rows = read_raw(spark, store).collect()
    assert [(r.vendor_id, r.airport_fee) for r in rows] == [(2, Decimal("1.75"))] * 2
