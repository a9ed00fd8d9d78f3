from datetime import date

import pytest
from frames import daily, staged
from pyspark.sql import functions as F

from tripwright.operators.rollups import daily_mart
from tripwright.operators.upsert import (
    merge_by_key,
    monthly,
    newest_date,
    read_daily,
    refresh_daily,
    write_months,
)
from tripwright.schemas import DAILY
from tripwright.sources.versions import NotBuilt, SchemaChanged


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "daily")


def counts(df):
    return {str(row.trip_date): row.total_trips for row in df.collect()}


def days(spark, *pairs):
    return staged(spark, *[{"day": day} for day, n in pairs for _ in range(n)])


BASE = [("2023-12-30", 1), ("2024-01-01", 2), ("2024-01-30", 3), ("2024-01-31", 4), ("2024-02-01", 5)]


def test_first_run_builds_everything(spark, path):
    result = refresh_daily(spark, days(spark, *BASE), path)
    assert counts(result) == dict(BASE)
    assert result.columns == DAILY.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in DAILY]


def test_incremental_equals_full_when_history_is_unchanged(spark, path):
    later = [*BASE, ("2024-02-02", 6), ("2024-03-05", 7)]
    refresh_daily(spark, days(spark, *BASE), path)
    incremental = refresh_daily(spark, days(spark, *later), path)
    assert sorted(incremental.collect()) == sorted(daily_mart(days(spark, *later)).collect())


def test_lookback_takes_late_trips_of_three_dates(spark, path):
    refresh_daily(spark, days(spark, *BASE), path)
    late = [("2024-01-01", 9), ("2024-01-29", 9), ("2024-01-30", 9), ("2024-01-31", 9), ("2024-02-01", 9)]
    result = refresh_daily(spark, days(spark, *late), path)
    assert counts(result) == {
        "2023-12-30": 1, "2024-01-01": 2,  # older than the lookback, untouched
        "2024-01-30": 9, "2024-01-31": 9, "2024-02-01": 9,
    }


def test_a_date_without_new_rows_stays(spark, path):
    refresh_daily(spark, days(spark, *BASE), path)
    result = refresh_daily(spark, days(spark, ("2024-02-01", 6)), path)
    assert counts(result) == {**dict(BASE), "2024-02-01": 6}


def test_no_new_trips_changes_nothing(spark, path):
    refresh_daily(spark, days(spark, *BASE), path)
    assert counts(refresh_daily(spark, days(spark, *BASE).limit(0), path)) == dict(BASE)


def test_empty_table_is_built_in_full(spark, path):
    refresh_daily(spark, days(spark, *BASE).limit(0), path)
    assert newest_date(spark, path) is None
    assert counts(refresh_daily(spark, days(spark, *BASE), path)) == dict(BASE)


def test_future_pickup_blocks_until_full_refresh(spark, path):
    refresh_daily(spark, days(spark, *BASE, ("2090-01-01", 1)), path)
    later = days(spark, *BASE, ("2024-02-02", 6), ("2090-01-01", 1))
    assert "2024-02-02" not in counts(refresh_daily(spark, later, path))
    assert counts(refresh_daily(spark, later, path, full_refresh=True))["2024-02-02"] == 6


def test_full_refresh_drops_what_is_gone(spark, path):
    refresh_daily(spark, days(spark, *BASE), path)
    rest = BASE[2:]
    assert counts(refresh_daily(spark, days(spark, *rest), path, full_refresh=True)) == dict(rest)


def test_changed_table_schema_is_refused(spark, path):
    table = monthly(path)
    old = daily(spark, ("2024-01-01", 2, 3)).drop("avg_tip")
    table.commit(spark, None, old.schema, write_months(old, table, {}))
    with pytest.raises(SchemaChanged):
        refresh_daily(spark, days(spark, *BASE), path)
    assert table.read(spark, old.schema, table.built(spark)).count() == 1


def test_merge_by_key(spark):
    old = daily(spark, ("2024-01-01", 1, 1), ("2024-01-02", 2, 2))
    new = daily(spark, ("2024-01-02", 9, 9), ("2024-01-03", 3, 3))
    assert counts(merge_by_key(old, new, "trip_date")) == {
        "2024-01-01": 1, "2024-01-02": 9, "2024-01-03": 3,
    }
    unknown = old.withColumn("trip_date", F.lit(None).cast("date")).limit(1)
    assert merge_by_key(old.union(unknown), unknown, "trip_date").count() == 4
    assert merge_by_key(old.union(old), new, "trip_date").count() == 4  # 2 + 2 replaced by new ones
    with pytest.raises(SchemaChanged):
        merge_by_key(old, new.withColumn("total_trips", F.col("total_trips").cast("int")), "trip_date")
    with pytest.raises(SchemaChanged):
        merge_by_key(old, new.withColumn("more", F.lit(1)), "trip_date")


def test_newest_date(spark, path):
    assert newest_date(spark, path) is None
    with pytest.raises(NotBuilt):
        read_daily(spark, path)
    refresh_daily(spark, days(spark, *BASE), path)
    assert newest_date(spark, path) == date(2024, 2, 1)
    assert read_daily(spark, path).count() == 5
