"""Monthly Parquet files in a landing folder.

A month is a file ``yellow_tripdata_<yyyy-MM>.parquet``, a folder of that name, or a
``source_file=<name>`` folder as written by a partitioned Spark job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.months import filename_in, month_to_filename
from tripwright.sources.versions import listing

PREFIX = "source_file="


@dataclass(frozen=True)
class Delivery:
    """The files of a month, and what tells one delivery of it from the next."""

    month: str
    files: tuple[str, ...]
    mark: str


def deliveries(spark: SparkSession, landing: str, months: Sequence[str]) -> dict[str, Delivery]:
    """What the landing folder has of the months, from one listing and one for each folder."""
    root = landing.rstrip("/")
    wanted = {month_to_filename(month): month for month in months}
    found: dict[str, list[tuple[str, int, int]]] = {}
    for name, is_folder, size, changed in listing(spark, root):
        month = wanted.get(name.removeprefix(PREFIX))
        if month is None:
            continue
        files = found.setdefault(month, [])
        if not is_folder:
            files.append((f"{root}/{name}", size, changed))
            continue
        for part, inner, part_size, part_changed in listing(spark, f"{root}/{name}"):
            if not inner and part[0] not in "._":
                files.append((f"{root}/{name}/{part}", part_size, part_changed))
    return {
        month: Delivery(
            month,
            tuple(path for path, _, _ in files),
            ";".join(f"{path.removeprefix(root)}:{size}:{at}" for path, size, at in files),
        )
        for month, files in found.items()
    }


def delivered(spark: SparkSession, landing: str, months: Sequence[str]) -> set[str]:
    return set(deliveries(spark, landing, months))


def footer(spark: SparkSession, file: str) -> str:
    """What decides a file's schema, from its footer. A file that is no Parquet file raises."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
    )
    try:
        meta = reader.getFileMetaData()
        spark_schema = meta.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
        return f"{spark_schema}\n{meta.getSchema().toString()}"
    finally:
        reader.close()


def footers(spark: SparkSession, delivery: Delivery) -> dict[str, str]:
    return {file: footer(spark, file) for file in delivery.files}


def scan_files(spark: SparkSession, footers: dict[str, str]) -> list[DataFrame]:
    """Rows of files as delivered, one frame for each schema they have.

    Headers and types drift between months and between the parts of one, and a scan under the
    schema of one file would read the others' columns as NULL. The schemas are few, whatever the
    number of files.
    """
    groups: dict[str, list[str]] = {}
    for file, kind in footers.items():
        groups.setdefault(kind, []).append(file)
    return [
        spark.read.schema(spark.read.parquet(some[0]).schema).parquet(*some)
        for some in groups.values()
    ]


def month_file() -> Column:
    """The monthly file that a row of a scan comes from."""
    return filename_in(F.col("_metadata.file_path"))


def write_landing(rows: DataFrame, landing: str) -> None:
    """Deliver raw-shaped rows as one folder per ``source_file``.

    Rebalancing on the file name gathers a month into few files; adaptive execution
    cuts a month that outgrows a partition into several tasks.
    """
    (
        rows.hint("rebalance", F.col("source_file"))
        .write.mode("append")
        .partitionBy("source_file")
        .parquet(landing)
    )
