"""Incremental daily mart: recompute a lookback window and replace those dates.

The table has a part for each month. A run writes the months it touches to new folders and then
makes them current in one step, together with the untouched ones, which stay where they are. No
path is read and written in one job, and a run that fails leaves the rows of the one before.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators.rollups import daily_mart
from tripwright.schemas import DAILY, LOOKBACK_DAYS
from tripwright.sources.versions import Part, SchemaChanged, Table, Version

MONTH = "trip_month"


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def guard_schema(table: DataFrame, rows: DataFrame) -> None:
    if table.dtypes != rows.dtypes:
        raise SchemaChanged(f"table has {table.dtypes}, new rows have {rows.dtypes}")


def merge_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those with the same key.

    Marking the rows and comparing within a key computes ``new`` once, where an
    anti-join against its keys would compute it a second time. A NULL key matches none, so rows
    with one are dealt by their values and not gathered.
    """
    guard_schema(existing, new)
    marked = existing.withColumn("_new", F.lit(False)).unionByName(
        new.withColumn("_new", F.lit(True))
    )
    values = ", ".join(f"`{name}`" for name in existing.columns)
    replaced = F.expr(
        f"max(_new) OVER (PARTITION BY {key}, if({key} IS NULL, xxhash64({values}), 0L))"
    )
    return (
        marked.withColumn("_replaced", replaced)
        .where(f"_new OR NOT _replaced OR {key} IS NULL")
        .select(existing.columns)
    )


def lookback_start(newest: date) -> date:
    return newest - timedelta(days=LOOKBACK_DAYS)


def since(staged: DataFrame, first_day: date) -> DataFrame:
    """Trips picked up on or after a date; a literal bound, so it reaches the scan."""
    return staged.where(F.col("pickup_at") >= F.lit(first_day).cast("timestamp_ntz"))


def monthly(path: str) -> Table:
    return Table(path, MONTH)


def read_daily(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """The stored mart; one that was never built is an error, not an empty table."""
    table = monthly(path)
    return table.read(spark, DAILY, version or table.built(spark))


def newest_date(spark: SparkSession, path: str) -> date | None:
    """The newest stored date, from the newest month."""
    table = monthly(path)
    version = table.current(spark)
    if version is None or not version.parts:
        return None
    newest = table.read(spark, DAILY, version, [max(version.parts)])
    return newest.agg(F.max("trip_date")).first()[0]


def write_months(rows: DataFrame, table: Table, facts: dict[str, dict]) -> dict[str, Part]:
    """New parts of a mart by date, one for each month; nobody reads them yet."""
    folders = table.write(rows.withColumn(MONTH, _month(F.col("trip_date"))).repartition(MONTH))
    return {month: Part(folder, facts.get(month, {})) for month, folder in folders.items()}


def refresh_daily(
    spark: SparkSession,
    staged: DataFrame | Callable[[date | None], DataFrame],
    path: str,
    full_refresh: bool = False,
) -> DataFrame:
    """Bring the stored daily mart up to date and return it.

    The first run, a run on an empty table and ``full_refresh`` build everything. Any
    other run recomputes the newest stored date, the two before it and whatever is
    newer. Trips older than that stay out until a full refresh, as does everything
    behind a pickup dated in the future. ``staged`` may be a function that gets the first
    date needed, and so need not read what is older.
    """
    table = monthly(path)
    base = table.current(spark)
    newest = None if full_refresh else newest_date(spark, path)
    first = None if newest is None else lookback_start(newest)
    trips = staged(first) if callable(staged) else staged
    if first is None:
        parts = write_months(daily_mart(trips), table, {})
        gone = set(base.parts) - set(parts) if base else set()
    else:
        months = [m for m in base.parts if m >= first.replace(day=1).isoformat()]
        touched = table.read(spark, DAILY, base, months)
        merged = merge_by_key(touched, daily_mart(since(trips, first)), "trip_date")
        parts, gone = write_months(merged, table, {}), set()
    return read_daily(spark, path, table.commit(spark, base, DAILY, parts, gone))
