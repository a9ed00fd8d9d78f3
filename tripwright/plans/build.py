"""The model graph: raw -> staging (lazy) -> daily (incremental) -> trends, and zone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import lit
from pyspark.sql.types import StructType

from tripwright.operators.quality import freshness, report
from tripwright.operators.staging import stage_trips
from tripwright.operators.trends import CARRIED_ROWS, trends_from
from tripwright.operators.upsert import monthly, read_daily, refresh_daily, write_months
from tripwright.plans.checks import DAILY_CHECKS, STAGING_CHECKS, TRENDS_CHECKS, ZONE_CHECKS
from tripwright.plans.per_file import staging_failures, zones_from_sums
from tripwright.schemas import DAILY, TRENDS, ZONE
from tripwright.sources.tables import Store, file_facts, files_since, raw_version, read_raw
from tripwright.sources.versions import Part, Table

STAGING_TABLE = "stg_yellow_trips"
DAILY_TABLE = "mart_trips_daily"
ZONE_TABLE = "mart_trips_zone"
TRENDS_TABLE = "mart_revenue_trends"


def staging(spark: SparkSession, store: Store, first_day: date | None = None) -> DataFrame:
    """Staged trips; with a first day, only files that may hold one since then are opened."""
    version = raw_version(spark, store)
    files = files_since(version, first_day) if version and first_day else None
    return stage_trips(read_raw(spark, store, files))


def daily(spark: SparkSession, store: Store) -> DataFrame:
    return read_daily(spark, store.mart(DAILY_TABLE))


def _whole(store: Store, name: str) -> Table:
    return Table(store.mart(name), "build")


def zones(spark: SparkSession, store: Store) -> DataFrame:
    table = _whole(store, ZONE_TABLE)
    return table.read(spark, ZONE, table.built(spark))


def trends(spark: SparkSession, store: Store) -> DataFrame:
    table = monthly(store.mart(TRENDS_TABLE))
    return table.read(spark, TRENDS, table.built(spark))


def replace_mart(rows: DataFrame, table: Table, schema: StructType) -> None:
    """Rebuild a mart beside the one that is read, and change over when it is whole."""
    spark, base = rows.sparkSession, table.current(rows.sparkSession)
    folders = table.write(rows.withColumn(table.key, lit("whole")))
    gone = base.parts if base and not folders else ()
    table.commit(spark, base, schema, {k: Part(f) for k, f in folders.items()}, gone)


def refresh_trends(spark: SparkSession, store: Store) -> None:
    """Recompute trends from the first month whose daily rows changed, with carried rows."""
    days, table = monthly(store.mart(DAILY_TABLE)), monthly(store.mart(TRENDS_TABLE))
    now, base = days.built(spark), table.current(spark)
    have = base.parts if base else {}
    origin = {month: part.folder for month, part in now.parts.items()}
    changed = [m for m in origin if m not in have or have[m].facts["from"] != origin[m]]
    gone = [m for m in have if m not in origin]
    if base and not changed and not gone:
        return
    first = min([*changed, *gone], default="9999-12-01")
    tail = [m for m in origin if m >= first]
    # a month has rows, so seven of them hold the rows to carry
    before = sorted(m for m in origin if m < first)[-CARRIED_ROWS:]
    rows = trends_from(
        days.read(spark, DAILY, now, tail),
        days.read(spark, DAILY, now, before),
        date.fromisoformat(first),
    )
    parts = write_months(rows, table, {m: {"from": origin[m]} for m in tail}) if tail else {}
    table.commit(spark, base, TRENDS, parts, gone)


def build_marts(spark: SparkSession, store: Store, full_refresh: bool = False) -> None:
    """Refresh all marts, each of which keeps its rows until its new ones are whole.

    The daily mart is recomputed for a lookback window, the trends from the first month that
    changed, and the zone mart, whose totals span all of history, from sums kept for each file.
    """
    refresh_daily(
        spark,
        lambda first_day: staging(spark, store, first_day),
        store.mart(DAILY_TABLE),
        full_refresh,
    )
    replace_mart(zones_from_sums(spark, store), _whole(store, ZONE_TABLE), ZONE)
    refresh_trends(spark, store)


def check_all(
    staged: DataFrame, daily_rows: DataFrame, zone_rows: DataFrame, trend_rows: DataFrame
) -> DataFrame:
    """Failures of every declared check."""
    return (
        report(staged, STAGING_TABLE, STAGING_CHECKS)
        .unionByName(report(daily_rows, DAILY_TABLE, DAILY_CHECKS))
        .unionByName(report(zone_rows, ZONE_TABLE, ZONE_CHECKS))
        .unionByName(report(trend_rows, TRENDS_TABLE, TRENDS_CHECKS))
    )


def check_store(spark: SparkSession, store: Store) -> DataFrame:
    """Failures of every declared check over the stored tables; a mart that is absent raises.

    Staging failures are kept for each file, and counted again for files that changed only.
    """
    return (
        staging_failures(spark, store, STAGING_TABLE)
        .unionByName(report(daily(spark, store), DAILY_TABLE, DAILY_CHECKS))
        .unionByName(report(zones(spark, store), ZONE_TABLE, ZONE_CHECKS))
        .unionByName(report(trends(spark, store), TRENDS_TABLE, TRENDS_CHECKS))
    )


def freshness_of(spark: SparkSession, store: Store, as_of: Sequence[datetime]) -> DataFrame:
    """Age of the newest load by what is known of the files; no row is read."""
    return freshness(file_facts(spark, store), "loaded_at", as_of)
