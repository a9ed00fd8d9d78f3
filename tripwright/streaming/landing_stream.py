"""Pick up newly delivered months with Structured Streaming.

The stream lists files, it does not carry rows: a batch names the months that got
new files, and those months are loaded whole from the landing folder. That keeps
"replace by file" right when the parts of a month arrive in different batches or a
batch is replayed, and lets every month have its own schema. A file rewritten under
a name the stream has already seen is not noticed; reload its month with
``load_month``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.months import filename_in
from tripwright.plans.ingest import Clock, attempt_months, utc_now
from tripwright.schemas import FILE_PREFIX, FILE_SUFFIX, SOURCE_NAME
from tripwright.sources.landing import deliveries
from tripwright.sources.tables import Store, append_quarantine, read_quarantine

# the columns of Spark's binaryFile source, which a stream wants spelled out
FILE_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def new_files(spark: SparkSession, landing: str) -> DataFrame:
    """Paths of delivered files; the content column is pruned and never read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{FILE_SUFFIX}")
        .load(landing)
        .select("path")
    )


def months_in(paths: DataFrame) -> list[str]:
    """The distinct months among file paths, oldest first; at most one per calendar month."""
    month = F.substring(filename_in(F.col("path")), len(FILE_PREFIX) + 1, len("2024-01"))
    named = paths.where(F.col("path").contains(FILE_PREFIX))
    return sorted(row[0] for row in named.select(month).distinct().collect())


def open_quarantine(spark: SparkSession, store: Store, source: str) -> dict[str, str]:
    """Months set aside and not loaded since, with the delivery that failed."""
    rows = read_quarantine(spark, store).where(F.col("source_name") == source).where("NOT healed")
    return {row["month"]: row["delivery"] for row in rows.select("month", "delivery").collect()}


def _load(
    spark: SparkSession,
    store: Store,
    landing: str,
    months: list[str],
    source: str = SOURCE_NAME,
    clock: Clock = utc_now,
    **options,
) -> None:
    """Load what can be loaded, set aside what cannot, and note what has become sound."""
    aside = open_quarantine(spark, store, source)
    outcomes = attempt_months(
        spark, store, landing, months, source=source, clock=clock, **options
    )
    notes = [
        (source, o.month, o.file, o.mark, str(o.error) if o.error else None, o.error is None, clock())
        for o in outcomes
        if o.error or o.month in aside
    ]
    if notes:
        append_quarantine(spark, store, notes)


def ingest_new_months(
    spark: SparkSession,
    store: Store,
    landing: str,
    checkpoint: str,
    source: str = SOURCE_NAME,
    **options,
) -> None:
    """Load everything delivered since the last call, then stop.

    A month that cannot be loaded is set aside with its error and does not hold up the others or
    the next calls. It is tried again as soon as its files are others than those that failed.
    """

    def load(batch: DataFrame, _: int) -> None:
        _load(batch.sparkSession, store, landing, months_in(batch), source, **options)

    aside = open_quarantine(spark, store, source)
    now = deliveries(spark, landing, list(aside)) if aside else {}
    again = sorted(m for m, d in now.items() if d.mark != aside[m])
    if again:
        _load(spark, store, landing, again, source, **options)
    (
        new_files(spark, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
