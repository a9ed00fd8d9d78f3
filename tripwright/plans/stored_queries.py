"""Named queries over stored tables: what loads, rebuilds and reports leave behind."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.months import month_of, month_start
from tripwright.operators import reports
from tripwright.operators.rollups import daily_mart, zone_mart
from tripwright.operators.staging import stage_trips
from tripwright.operators.upsert import monthly, read_daily, refresh_daily
from tripwright.plans import build
from tripwright.plans.delivered import LOADED_AT, new_store, redeliver, spoil
from tripwright.plans.ingest import FAILURES, catch_up, load_month, load_months, load_next
from tripwright.schemas import SOURCE_NAME
from tripwright.session import work_dir
from tripwright.sources.lineitem import lineitem_trips
from tripwright.sources.tables import (
    Store,
    read_audit,
    read_quarantine,
    read_raw,
    set_last_loaded_month,
)
from tripwright.sources.versions import SchemaChanged
from tripwright.streaming.landing_stream import ingest_new_months


def _now(months: list[str]) -> datetime:
    return datetime.combine(month_start(months[-1]), datetime.min.time())


def _rows_by_month(spark: SparkSession, store: Store, step: str) -> DataFrame:
    month = F.substring("source_file", len("yellow_tripdata_") + 1, 7)
    return (
        read_raw(spark, store)
        .groupBy(month.alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(step).alias("step"), "month", F.lit("stored").alias("status"), "rows")
    )


def catch_up_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third month is spoilt: two are in after the first call, all after it came anew."""
    store, landing, months = new_store(spark, sf_dir, "gap")
    spoil(spark, landing, months[2])
    before = month_start(months[0]) - timedelta(days=1)
    set_last_loaded_month(spark, store, SOURCE_NAME, before.replace(day=1))
    try:
        catch_up(spark, store, landing, now=_now(months), loaded_at=LOADED_AT)
    except FAILURES:
        pass  # recorded in the audit table, which is the point here
    first = _rows_by_month(spark, store, "first call")
    redeliver(spark, sf_dir, landing, months[2])
    catch_up(spark, store, landing, now=_now(months), loaded_at=LOADED_AT)
    audit = read_audit(spark, store).select(
        F.lit("audit").alias("step"), "month", "status", F.col("rows_loaded").alias("rows")
    )
    return first.unionByName(_rows_by_month(spark, store, "second call")).unionByName(audit)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spoilt month is set aside while the others load, and loads when it came anew."""
    store, landing, months = new_store(spark, sf_dir, "quarantine")
    progress = f"{work_dir(spark, 'quarantine')}/progress"
    spoil(spark, landing, months[1])
    ingest_new_months(spark, store, landing, progress, loaded_at=LOADED_AT)
    first = _rows_by_month(spark, store, "first call")

    def aside(step: str) -> DataFrame:
        healed = F.when(F.col("healed"), "healed").otherwise("set aside")
        rows = read_quarantine(spark, store).select(
            F.lit(step).alias("step"), "month", healed.alias("status"), F.lit(None).cast("long").alias("rows")
        )
        return spark.createDataFrame(rows.collect(), rows.schema)  # one row a month set aside

    noted = aside("first call")
    redeliver(spark, sf_dir, landing, months[1])
    ingest_new_months(spark, store, landing, progress, loaded_at=LOADED_AT)
    second = _rows_by_month(spark, store, "second call")
    return first.unionByName(noted).unionByName(second).unionByName(aside("second call"))


def _rebuilt(spark: SparkSession, sf_dir: str, label: str, full_refresh: bool) -> Store:
    """A store built on half of a month, which was then loaded whole."""
    store, landing, months = new_store(spark, sf_dir, label)
    redeliver(spark, sf_dir, landing, months[1], F.col("vendor_id") == 1)
    load_months(spark, store, landing, months, loaded_at=LOADED_AT)
    build.build_marts(spark, store)
    build.check_store(spark, store).collect()
    redeliver(spark, sf_dir, landing, months[1])
    load_month(spark, store, landing, months[1], loaded_at=LOADED_AT)
    build.build_marts(spark, store, full_refresh)
    return store


def stored_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from the sums kept for each file, after one file was replaced."""
    return build.zones(spark, _rebuilt(spark, sf_dir, "zones", full_refresh=False))


def stored_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a store, of which the staging ones were counted anew for one file."""
    return build.check_store(spark, _rebuilt(spark, sf_dir, "checks", full_refresh=True))


def stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days after two incremental runs over months that came one after the other."""
    store, landing, months = new_store(spark, sf_dir, "days")
    for some in (months[:-2], months[-2:-1], months[-1:]):
        load_months(spark, store, landing, some, loaded_at=LOADED_AT)
        build.build_marts(spark, store)
    return build.daily(spark, store)


def stored_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files loaded at different times, the newest neither first nor last."""
    store, landing, months = new_store(spark, sf_dir, "fresh")
    for month, hours in zip(months, (0, 5, 2)):
        load_month(spark, store, landing, month, loaded_at=LOADED_AT + timedelta(hours=hours))
    as_of = [LOADED_AT + timedelta(hours=5 + h) for h in (6, 24, 30, 49)]
    return build.freshness_of(spark, store, as_of)


def load_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is due after the last month: nothing is loaded and nothing written."""
    store, landing, months = new_store(spark, sf_dir, "skip")
    load_months(spark, store, landing, months[-2:], loaded_at=LOADED_AT)
    result = load_next(spark, store, landing, now=_now(months))
    raw = read_raw(spark, store).agg(F.count(F.lit(1)).alias("raw_rows"))
    return raw.select(
        F.lit(result.get("skipped", False)).alias("skipped"),
        F.lit(result.get("reason")).alias("reason"),
        F.lit(read_audit(spark, store).count()).cast("long").alias("audit_rows"),
        "raw_rows",
    )


def _with_position(spark: SparkSession, ordered: DataFrame, label: str) -> DataFrame:
    """Ordered rows as a report file has them, with the line that each is on."""
    path = work_dir(spark, label)
    ordered.coalesce(1).write.parquet(path)
    return spark.read.parquet(path).select("*", (F.col("_metadata.row_index") + 1).alias("position"))


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads an hour apart, the latest first, with their own times."""
    store, landing, months = new_store(spark, sf_dir, "report")
    for hour, month in enumerate(months[:3]):
        start = LOADED_AT + timedelta(hours=hour)
        ticks = iter([start, start + timedelta(seconds=90 + hour)])
        load_month(spark, store, landing, month, loaded_at=LOADED_AT, clock=lambda t=ticks: next(t))
    return _with_position(spark, reports.audit_report(read_audit(spark, store)), "audit-report")


def daily_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_mart(stage_trips(lineitem_trips(spark, sf_dir)))
    return _with_position(spark, reports.by_date(days), "days-in-order")


def zones_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = zone_mart(stage_trips(lineitem_trips(spark, sf_dir)))
    return _with_position(spark, reports.by_trips(zones), "zones-in-order")


def schema_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which changes of its columns the daily mart refuses, and that its rows stay."""
    path = work_dir(spark, "guard")
    trips = stage_trips(lineitem_trips(spark, sf_dir))
    days = refresh_daily(spark, trips, path)
    table = monthly(path)
    changes = {
        "same columns": days,
        "column missing": days.drop("avg_tip"),
        "column added": days.withColumn("surcharges", F.lit(0)),
        "other type": days.withColumn("total_trips", F.col("total_trips").cast("int")),
        "other order": days.select(sorted(days.columns)),
    }
    rows = []
    for change, frame in changes.items():
        try:
            table.commit(spark, table.built(spark), frame.schema, {})
            rows.append((change, False))
        except SchemaChanged:
            rows.append((change, True))
    stored = read_daily(spark, path).count()
    attempts = spark.createDataFrame(rows, "change string, refused boolean")
    return attempts.withColumn("stored_days", F.lit(stored).cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        catch_up_gap,
        stream_quarantine,
        stored_zone,
        stored_checks,
        stored_daily,
        stored_freshness,
        load_skip,
        audit_report,
        daily_in_order,
        zones_in_order,
        schema_guard,
    )
}
