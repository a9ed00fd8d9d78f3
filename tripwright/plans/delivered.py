"""A landing folder and stores made from the trips of the given tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.months import month_of, month_start, month_to_filename, months_due
from tripwright.plans.ingest import load_months
from tripwright.session import work_dir
from tripwright.sources.landing import PREFIX, write_landing
from tripwright.sources.lineitem import as_delivered, lineitem_trips
from tripwright.sources.tables import Store
from tripwright.sources.versions import create_file

LOADED_AT = datetime(2024, 2, 1)
HEADER_CHANGE = date(1998, 1, 1)  # first month delivered under the current headers


def deliver(spark: SparkSession, sf_dir: str, base: str) -> tuple[str, list[str]]:
    """All trips as monthly files, the earlier ones in an older header and type form."""
    landing = f"{base}/landing"
    trips = lineitem_trips(spark, sf_dir)
    old = F.col("tpep_pickup_datetime") < F.lit(HEADER_CHANGE).cast("timestamp_ntz")
    write_landing(trips.where(old).drop("loaded_at"), landing)
    write_landing(as_delivered(trips.where(~old)), landing)
    first, last = trips.agg(
        F.min("tpep_pickup_datetime"), F.max("tpep_pickup_datetime")
    ).first()
    before = month_start(month_of(first)) - timedelta(days=1)
    return landing, months_due(before, last)


def redeliver(
    spark: SparkSession, sf_dir: str, landing: str, month: str, keep: Column | None = None
) -> None:
    """A month delivered anew, whole or with some of its rows.

    Rebalancing joins what the tasks of the scan find; one task alone would read the whole table.
    """
    rows: DataFrame = lineitem_trips(spark, sf_dir)
    rows = rows.where(F.col("source_file") == month_to_filename(month))
    rows = rows if keep is None else rows.where(keep)
    folder = f"{landing}/{PREFIX}{month_to_filename(month)}"
    rows = rows.drop("source_file", "loaded_at").hint("rebalance")
    rows.write.mode("overwrite").parquet(folder)


def spoil(spark: SparkSession, landing: str, month: str) -> None:
    """Put a file that is no Parquet file among those of a month."""
    folder = f"{landing}/{PREFIX}{month_to_filename(month)}"
    create_file(spark, f"{folder}/part-spoilt.parquet", "this is not Parquet")


def new_store(spark: SparkSession, sf_dir: str, label: str) -> tuple[Store, str, list[str]]:
    base = work_dir(spark, label)
    landing, months = deliver(spark, sf_dir, base)
    return Store(f"{base}/store"), landing, months


def loaded(spark: SparkSession, sf_dir: str, label: str, times: int = 1) -> tuple[Store, str]:
    store, landing, months = new_store(spark, sf_dir, label)
    for _ in range(times):
        load_months(spark, store, landing, months, loaded_at=LOADED_AT)
    return store, landing
