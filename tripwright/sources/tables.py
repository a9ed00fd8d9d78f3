"""Stored tables under one root, and the writes that keep them whole."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.schemas import AUDIT, FILE_FACTS, QUARANTINE, RAW, WATERMARK
from tripwright.sources.versions import CommitConflict, Part, Table, Version

FILE = "source_file"
#: Log parts that are merged into one once there are more.
LOG_PARTS = 16


@dataclass(frozen=True)
class Store:
    root: str

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw(self) -> str:
        return self._at("raw", "trips")

    @property
    def watermark(self) -> str:
        return self._at("raw", "ingestion_watermark")

    @property
    def audit(self) -> str:
        return self._at("raw", "ingestion_audit")

    @property
    def quarantine(self) -> str:
        return self._at("raw", "quarantine")

    def per_file(self, name: str) -> Table:
        """A table computed from the raw rows of each file by itself."""
        return Table(self._at("staging", name), FILE)

    def mart(self, name: str) -> str:
        return self._at("marts", name)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A control table by its declared schema; one that was never written is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# -- raw rows, a part for each file ----------------------------------------------------


def raw_table(path: str) -> Table:
    return Table(path, FILE)


def raw_version(spark: SparkSession, store: Store) -> Version | None:
    return raw_table(store.raw).current(spark)


def read_raw(
    spark: SparkSession, store: Store, files: Collection[str] | None = None
) -> DataFrame:
    """Raw rows, of all files or of some; a store that nothing was loaded into has none."""
    version = raw_version(spark, store)
    if version is None:
        return spark.createDataFrame([], RAW)
    return raw_table(store.raw).read(spark, RAW, version, files)


def write_files(rows: DataFrame, path: str) -> dict[str, Part]:
    """Write raw rows to new folders, one for each file they name; nobody reads them yet.

    Input splits belong to few monthly files each, so this needs no shuffle. Sorting each task's
    rows by pickup time keeps the row-group ranges narrow; the file sort key is the order the
    partitioned writer asks for anyway. What is known of a file comes from a scan of two columns
    of what was written.
    """
    spark, table = rows.sparkSession, raw_table(path)
    folders = table.write(rows.sortWithinPartitions(FILE, "tpep_pickup_datetime"))
    written = Version(0, (), {file: Part(folder) for file, folder in folders.items()})
    found = (
        table.read(spark, RAW, written)
        .groupBy(FILE)
        .agg(
            F.expr("count(1) AS rows"),
            F.expr("string(min(tpep_pickup_datetime)) AS first_pickup"),
            F.expr("string(max(tpep_pickup_datetime)) AS last_pickup"),
            F.expr("string(max(loaded_at)) AS loaded_at"),
        )
        .collect()
    )
    return {row[FILE]: Part(folders[row[FILE]], row.asDict()) for row in found}


def commit_files(spark: SparkSession, path: str, parts: dict[str, Part]) -> Version:
    """Make files that were written the ones to read, all at once, in place of those before."""
    return raw_table(path).put(spark, RAW, parts)


def replace_files(rows: DataFrame, path: str) -> None:
    """Replace the files that raw rows name and leave all others alone."""
    commit_files(rows.sparkSession, path, write_files(rows, path))


def file_facts(spark: SparkSession, store: Store) -> DataFrame:
    """Rows, pickup range and load time of every loaded file, from the version alone."""
    version = raw_version(spark, store)
    rows = [
        tuple(part.facts.get(name) if name != FILE else file for name in FILE_FACTS.names)
        for file, part in (version.parts if version else {}).items()
    ]
    text = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name == "rows" else T.StringType()) for f in FILE_FACTS]
    )
    return spark.createDataFrame(rows, text).selectExpr(
        [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in FILE_FACTS]
    )


def files_since(version: Version, first_day: date) -> list[str]:
    """Files that may hold a pickup on or after a day, by their ranges."""
    return [
        file
        for file, part in version.parts.items()
        if part.folder and (part.facts["last_pickup"] or "") >= first_day.isoformat()
    ]


# -- watermark ---------------------------------------------------------------------------


def last_loaded_month(spark: SparkSession, store: Store, source: str) -> date | None:
    row = (
        read_table(spark, store.watermark, WATERMARK)
        .where(F.col("source_name") == source)
        .select("last_loaded_month")
        .first()
    )
    return row[0] if row else None


def set_last_loaded_month(spark: SparkSession, store: Store, source: str, month: date) -> None:
    """Record the month loaded last, also when it is an earlier one than before."""
    (
        spark.createDataFrame([(source, month)], WATERMARK)
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_name")
        .parquet(store.watermark)
    )


def read_watermark(spark: SparkSession, store: Store) -> DataFrame:
    return read_table(spark, store.watermark, WATERMARK).select(WATERMARK.names)


# -- logs ----------------------------------------------------------------------------------


def _log(path: str) -> Table:
    return Table(path, "batch")


def _append(spark: SparkSession, path: str, rows: Sequence[tuple], schema: T.StructType) -> None:
    """Add rows to a log, and merge its parts when they have become many."""
    table = _log(path)

    def write(frame: DataFrame) -> dict[str, Part]:
        batch = F.lit(uuid.uuid4().hex).alias("batch")
        folders = table.write(frame.coalesce(1).select("*", batch))
        return {key: Part(folder) for key, folder in folders.items()}

    new = write(spark.createDataFrame(rows, schema))
    version = table.put(spark, schema, new)
    if len(version.parts) > LOG_PARTS:
        merged = write(table.read(spark, schema, version))
        try:
            table.commit(spark, version, schema, merged, dropped=version.parts)
        except CommitConflict:
            pass  # others are appending; the next append merges


def _read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = _log(path)
    version = table.current(spark)
    return table.read(spark, schema, version) if version else spark.createDataFrame([], schema)


def audit_row(
    source: str,
    month: str,
    source_file: str,
    status: str,
    started_at: datetime,
    finished_at: datetime,
    rows_loaded: int | None = None,
    error_message: str | None = None,
) -> tuple:
    """Values in the order of the audit schema; times carry no zone."""
    took = Decimal((finished_at - started_at) // timedelta(milliseconds=10)) / 100
    return (
        source, month, source_file, status, rows_loaded, error_message,
        started_at, finished_at, took,
    )


def append_audit(spark: SparkSession, store: Store, rows: Sequence[tuple]) -> None:
    _append(spark, store.audit, rows, AUDIT)


def read_audit(spark: SparkSession, store: Store) -> DataFrame:
    return _read_log(spark, store.audit, AUDIT)


def append_quarantine(spark: SparkSession, store: Store, rows: Sequence[tuple]) -> None:
    _append(spark, store.quarantine, rows, QUARANTINE)


def read_quarantine(spark: SparkSession, store: Store) -> DataFrame:
    """The newest entry of each month that was set aside at some time."""
    latest = "row_number() OVER (PARTITION BY source_name, month ORDER BY noted_at DESC, healed DESC)"
    return (
        _read_log(spark, store.quarantine, QUARANTINE)
        .withColumn("latest", F.expr(latest))
        .where("latest = 1")
        .select(QUARANTINE.names)
    )
