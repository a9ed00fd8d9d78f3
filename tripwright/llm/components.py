"""Connected components of an edge table, as joins and grouped minima.

Alternating large-star and small-star rounds: every node's larger neighbours are pointed at its
least neighbour, until each component is a star around its least node. A node of any degree is
a grouped minimum and a join, never a collected group, and each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every node with an edge.

    ``edges`` has two columns of one ordered type; loops and repeats are harmless.
    """
    a, b = edges.columns
    now = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "components",
    )
    seen = None
    while (mark := _fingerprint(now)) != seen:
        seen = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = _least(large)
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        now = stored(small, "components")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
