"""Named queries over the given tables: (spark, sf_dir) -> DataFrame.

Trips are derived from ``lineitem``. Queries about stored tables write to a new
folder under ``spark.checkpoint.dir`` first and return a read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.exact import ratio
from tripwright.functions.months import following_month, next_month
from tripwright.operators import quality, reports
from tripwright.operators.normalize import normalize_columns
from tripwright.operators.rollups import daily_mart, file_summary, mode_per_key, zone_mart
from tripwright.operators.staging import stage_trips
from tripwright.operators.trends import (
    growth,
    last_week,
    moving_averages,
    rank_in_month,
    revenue_trends,
)
from tripwright.operators.upsert import merge_by_key, refresh_daily
from tripwright.plans import build
from tripwright.plans.delivered import LOADED_AT, deliver, loaded
from tripwright.plans.ingest import load_month
from tripwright.plans.stored_queries import QUERIES as STORED_QUERIES
from tripwright.schemas import SOURCE_NAME
from tripwright.session import work_dir
from tripwright.sources.lineitem import as_delivered, lineitem_trips
from tripwright.sources.tables import (
    Store,
    last_loaded_month,
    read_audit,
    read_raw,
    read_watermark,
)
from tripwright.streaming.landing_stream import ingest_new_months

Query = Callable[[SparkSession, str], DataFrame]


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(lineitem_trips(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_mart(staged(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_mart(staged(spark, sf_dir))


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_trends(daily(spark, sf_dir))


# -- normalization and scalar parts -------------------------------------------


def raw_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camel-case headers in, one column missing, one unknown."""
    delivered = as_delivered(lineitem_trips(spark, sf_dir))
    return normalize_columns(
        delivered.drop("Airport_fee").withColumn("meter_serial", F.lit("M-7"))
    )


def zone_mode_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mode_per_key(staged(spark, sf_dir), "pu_location_id", "do_location_id")


def moving_avg_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moving_averages(daily(spark, sf_dir).select("trip_date", "total_trips", "total_revenue"))


def wow_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily(spark, sf_dir).select("trip_date", "total_trips", "total_revenue")
    return growth(last_week(days))


def revenue_rank_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_in_month(daily(spark, sf_dir).select("trip_date", "total_revenue"))


def demand_trend_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends(spark, sf_dir).groupBy("demand_trend").agg(F.count(F.lit(1)).alias("days"))


def trip_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest staged date and overall mean fare."""
    return daily(spark, sf_dir).agg(
        F.max("trip_date").alias("newest_date"),
        F.sum("total_trips").alias("total_trips"),
        F.expr(ratio("sum(total_revenue)", "sum(total_trips)", 2)).alias("avg_fare"),
    )


# -- quality --------------------------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows without a dropoff time or zone, one per missing value."""
    raw = lineitem_trips(spark, sf_dir).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "do_location_id", "total_amount"
    )
    checks = [quality.not_null(name) for name in raw.columns]
    return quality.violations(raw, checks)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys: none in the marts, pickup zones repeat in staging."""
    trips, days = staged(spark, sf_dir), daily(spark, sf_dir)
    frames = [
        ("stg_yellow_trips", trips, "pu_location_id"),
        ("mart_trips_daily", days, "trip_date"),
        ("mart_trips_zone", zones(spark, sf_dir), "pickup_zone_id"),
    ]
    found = [
        quality.duplicates(df, key).select(
            F.lit(model).alias("model"), F.col(key).cast("string").alias("duplicate_key"), "copies"
        )
        for model, df, key in frames
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips paid by neither card nor cash."""
    trips = staged(spark, sf_dir).select("pickup_at", "pu_location_id", "payment_type")
    return quality.violations(trips, [quality.accepted_values("payment_type", (1, 2))])


def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows outside the inclusive amount range or the exclusive one of this query."""
    raw = lineitem_trips(spark, sf_dir).select(
        "tpep_pickup_datetime", "pu_location_id", "total_amount", "trip_distance"
    )
    checks = [
        quality.between("total_amount", 0, 1000),
        quality.between("trip_distance", 0.25, 12.5, strictly=True),
    ]
    return quality.violations(raw, checks)


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status at four moments around the two limits."""
    as_of = [LOADED_AT + timedelta(hours=h) for h in (6, 24, 30, 49)]
    return quality.freshness(lineitem_trips(spark, sf_dir), "loaded_at", as_of)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, days = staged(spark, sf_dir), daily(spark, sf_dir)
    return build.check_all(trips, days, zone_mart(trips), revenue_trends(days))


# -- incremental processing and stored tables -----------------------------------


def _arrived_until(trips: DataFrame, days_back: int) -> DataFrame:
    """Trips picked up before the last ``days_back`` dates: the state of an earlier run."""
    newest = trips.agg(F.max(F.to_date("pickup_at"))).first()[0]
    cut = newest - timedelta(days=days_back)
    return trips.where(F.col("pickup_at") < F.lit(cut).cast("timestamp_ntz"))


def daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build on an earlier state, then one incremental run over all trips."""
    trips = staged(spark, sf_dir)
    path = work_dir(spark, "daily")
    refresh_daily(spark, _arrived_until(trips, 400), path)
    return refresh_daily(spark, trips, path)


def daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for part of the dates replaced by key: revenue dates get a zeroed tip column."""
    days = daily(spark, sf_dir)
    changed = days.where(F.dayofmonth("trip_date") == 1).withColumn(
        "total_tips", F.lit(0).cast("decimal(18,2)")
    )
    return merge_by_key(days, changed, "trip_date")


def load_month_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month loaded twice is every month loaded once."""
    store, _ = loaded(spark, sf_dir, "load", times=2)
    return read_raw(spark, store)


def watermark_next_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = loaded(spark, sf_dir, "watermark")
    return read_watermark(spark, store).withColumn(
        "next_month", following_month(F.col("last_loaded_month"))
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One success per month, and the failure of a month that was not delivered."""
    store, landing = loaded(spark, sf_dir, "audit")
    missing = next_month(last_loaded_month(spark, store, SOURCE_NAME), LOADED_AT)
    try:
        load_month(spark, store, landing, missing)
    except FileNotFoundError:
        pass  # recorded in the audit table, which is the point here
    return read_audit(spark, store).select(
        "source_name", "month", "source_file", "status", "rows_loaded",
        (F.col("error_message").isNotNull()).alias("has_error"),
    )


def stored_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, build and read back the trends mart from stored tables."""
    store, _ = loaded(spark, sf_dir, "marts")
    build.build_marts(spark, store)
    return build.trends(spark, store)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stream")
    landing, _ = deliver(spark, sf_dir, base)
    store = Store(f"{base}/store")
    ingest_new_months(spark, store, landing, f"{base}/progress", loaded_at=LOADED_AT)
    return read_raw(spark, store)


QUERIES: dict[str, Query] = {
    "trips_raw": lineitem_trips,
    "raw_normalize": raw_normalize,
    "stg_trips": staged,
    "mart_trips_daily": lambda s, d: reports.by_date(daily(s, d)),
    "mart_trips_zone": lambda s, d: reports.by_trips(zones(s, d)),
    "mart_revenue_trends": lambda s, d: reports.by_date(trends(s, d)),
    "zone_mode_dropoff": zone_mode_dropoff,
    "trip_totals": trip_totals,
    "moving_avg_7": moving_avg_7,
    "wow_growth": wow_growth,
    "revenue_rank_in_month": revenue_rank_in_month,
    "demand_trend_counts": demand_trend_counts,
    "trends_calendar": lambda s, d: revenue_trends(daily(s, d), calendar=True),
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_between": dq_between,
    "dq_freshness": dq_freshness,
    "dq_report": dq_report,
    "daily_incremental": daily_incremental,
    "daily_upsert": daily_upsert,
    "load_month_idempotent": load_month_idempotent,
    "watermark_next_month": watermark_next_month,
    "audit_log": audit_log,
    "stored_marts": stored_marts,
    "stream_ingest": stream_ingest,
    "raw_file_summary": lambda s, d: file_summary(lineitem_trips(s, d)),
    "top_zones": lambda s, d: reports.top_zones(zones(s, d)),
    "latest_days": lambda s, d: reports.latest_days(daily(s, d)),
    "latest_trends": lambda s, d: reports.latest_trends(trends(s, d)),
    **STORED_QUERIES,
}
