"""Tables computed from each raw file by itself, and kept up to date file by file.

What sums over all of history is kept as one additive state per file. When a file is loaded or
replaced, its state alone is computed again and takes the place of the old one; history is not
read. A state remembers the raw folder it was made from, so what has changed is known from the two
versions, without a scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.operators.quality import failures_by_key
from tripwright.operators.rollups import merged_sums, pair_sums, zones_of_pairs
from tripwright.operators.staging import stage_trips
from tripwright.plans.checks import STAGING_CHECKS
from tripwright.schemas import BIGINT, TEXT
from tripwright.sources.tables import FILE, Store, raw_version, read_raw
from tripwright.sources.versions import Part, Version

PAIR_SUMS = "zone_pair_sums"
CHECK_FAILURES = "check_failures"

CHECK_FAILURES_SCHEMA = T.StructType(
    [T.StructField(n, TEXT) for n in ("column_name", "check_name")]
    + [T.StructField("failures", BIGINT)]
)


def stale_files(raw: Version | None, kept: Version | None) -> tuple[list[str], list[str]]:
    """Files whose state is missing or of other rows, and files that are gone."""
    have = kept.parts if kept else {}
    now = raw.parts if raw else {}
    changed = [f for f, p in now.items() if f not in have or have[f].facts["from"] != p.folder]
    return changed, [f for f in have if f not in now]


def refresh(
    spark: SparkSession,
    store: Store,
    name: str,
    compute: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Bring a table of states up to date and return it; ``compute`` keeps ``source_file``."""
    table, raw = store.per_file(name), raw_version(spark, store)
    kept = table.current(spark)
    changed, gone = stale_files(raw, kept)
    rows = compute(stage_trips(read_raw(spark, store, changed)))
    schema = T.StructType([f for f in rows.schema if f.name != FILE])
    if changed or gone or kept is None:
        folders = table.write(rows.repartition(FILE)) if changed else {}
        parts = {f: Part(folders.get(f), {"from": raw.parts[f].folder}) for f in changed}
        kept = table.commit(spark, kept, schema, parts, gone)
    return table.read(spark, schema, kept)


def zone_pair_sums(spark: SparkSession, store: Store) -> DataFrame:
    return refresh(spark, store, PAIR_SUMS, lambda trips: pair_sums(trips, FILE))


def zones_from_sums(spark: SparkSession, store: Store) -> DataFrame:
    """The zone mart from the states of all files; only files that changed are read again."""
    return zones_of_pairs(merged_sums(zone_pair_sums(spark, store)))


def staging_failures(spark: SparkSession, store: Store, model: str) -> DataFrame:
    """Failures of the staging checks, of which only those in changed files are counted again."""
    counts = refresh(
        spark,
        store,
        CHECK_FAILURES,
        lambda trips: failures_by_key(trips, FILE, STAGING_CHECKS),
    )
    declared = spark.createDataFrame(
        [(c.column, c.name, 0) for c in STAGING_CHECKS], CHECK_FAILURES_SCHEMA
    )
    return (
        declared.unionByName(counts)
        .groupBy("column_name", "check_name")
        .agg(F.sum("failures").alias("failures"))
        .select(F.lit(model).alias("model"), "column_name", "check_name", "failures")
    )
