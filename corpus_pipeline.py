"""From documents to token records: five stages, each one operator of ``tripwright.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripwright.llm import pfair_mix, set_relations, site_bayes, token_records, winnowing
from tripwright.llm.common import arrow_rows, fresh, table
from tripwright.llm.queries import byte_tokenizer
from tripwright.session import work_dir

#: Texts in an Arrow batch. The JVM holds batches outside its heap, several at a time.
BATCH_TEXTS = 1024


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject."""
    with arrow_rows(spark, BATCH_TEXTS):
        return site_bayes.accepted(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    with arrow_rows(spark, BATCH_TEXTS):
        return set_relations.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't contaminated with benchmark items."""
    with arrow_rows(spark, BATCH_TEXTS):
        return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order in which their sources are to be read."""
    return pfair_mix.in_order(docs)


def records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token records, written in the order that the documents are stored in."""
    file, row = fresh(docs.columns, "stored_file", "stored_row")
    placed = docs.selectExpr("*", f"_metadata.file_name {file}", f"_metadata.row_index {row}")
    path = work_dir(spark, "corpus-records")
    token_records.write_records(placed, path, byte_tokenizer(), order=(file, row))
    return token_records.read_index(spark, path)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("records", records),
]

#: No SQL has the classifier, the schedule or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
