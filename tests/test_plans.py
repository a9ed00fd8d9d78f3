"""What the physical plans must and must not contain."""

import re
from datetime import date

import pytest

from tripwright.operators.reports import top_zones
from tripwright.operators.rollups import daily_mart, file_summary, zone_mart
from tripwright.operators.staging import stage_trips
from tripwright.operators.trends import revenue_trends
from tripwright.operators.upsert import since
from tripwright.plans.queries import QUERIES
from tripwright.plans.stored_queries import QUERIES as STORED_QUERIES
from tripwright.sources.lineitem import lineitem_trips
from tripwright.sources.tables import Store, read_raw, replace_files

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    store = Store(str(tmp_path_factory.mktemp("plans")))
    replace_files(lineitem_trips(spark, SF), store.raw)
    return read_raw(spark, store)


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def read_columns(df) -> set[str]:
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", formatted(df)).group(1)))


def test_filters_and_columns_reach_the_scan(raw):
    mart = daily_mart(stage_trips(raw))
    assert read_columns(mart) == {
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "tip_amount", "total_amount",
    }
    text = formatted(mart)
    assert "GreaterThanOrEqual(total_amount,0.00)" in text
    assert "GreaterThanOrEqual(trip_distance,0.0)" in text
    assert "IsNotNull(tpep_dropoff_datetime)" in text


def test_lookback_bound_reaches_the_scan(raw):
    text = formatted(daily_mart(since(stage_trips(raw), date(2001, 10, 1))))
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2001-10-01T00:00)" in text


def test_one_file_is_one_partition(raw):
    one = raw.where("source_file = 'yellow_tripdata_1999-01.parquet'").select("vendor_id")
    assert "(source_file#" in re.search(r"PartitionFilters: \[(.*)\]", formatted(one)).group(1)
    assert one.inputFiles() and len(raw.inputFiles()) > 50


def test_daily_shuffles_partial_sums_once(raw):
    text = plan(daily_mart(stage_trips(raw)))
    assert text.count("Exchange ") == 1
    assert "partial_sum" in text and "SortAggregate" not in text


def test_zone_shuffles_partial_sums_twice(raw):
    text = plan(zone_mart(stage_trips(raw)))
    assert text.count("Exchange ") == 2
    assert "ObjectHashAggregate" not in text


def test_trends_add_one_exchange_to_daily(raw):
    text = plan(revenue_trends(daily_mart(stage_trips(raw))))
    assert text.count("Exchange ") == 2 and text.count("SinglePartition") == 1
    assert text.count("lag(") == 2


def test_file_summary_reads_one_column(raw):
    assert read_columns(file_summary(raw)) == {"tpep_pickup_datetime"}


def test_top_k_does_not_sort_everything(raw):
    assert "TakeOrderedAndProject" in plan(top_zones(zone_mart(stage_trips(raw))))


LAZY = [
    name
    for name in QUERIES
    if name not in {
        "daily_incremental", "load_month_idempotent", "watermark_next_month", "audit_log",
        "stored_marts", "stream_ingest", *STORED_QUERIES,
    }
]


@pytest.mark.parametrize("name", LAZY)
def test_queries_stay_on_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in text
