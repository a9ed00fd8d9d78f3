"""Exact top-k inner products over an M-tree of paged nodes.

Vectors are whole numbers. With one more coordinate, sqrt(M - |x|^2) for a stored vector (M: the
largest squared norm) and 0 for a query, the largest inner products are the smallest Euclidean
distances, so the triangle inequality holds for both.

The tree has three levels. The root holds the routing objects: a bounded sample of the vectors,
with the covering radius of all that lies nearest to each. Below a routing object lie its pages, of
about ``page_rows`` vectors, each with the least and the greatest distance to the routing object.
A page keeps the distance of each vector to that parent, in ascending order.

Search is best first: a query visits the pages below the routing object it is nearest to, which
bounds its k-th distance; then only pages whose least possible distance is within that bound. In a
page, only vectors whose stored parent distance allows a distance within the bound are compared.
Bounds are widened by a rounding allowance and ties are kept, so the answer is exact.

Queries meet a page in blocks of ``query_block``, so a task holds one page and one block.

Scores are summed in float64 where that is exact, else in 64-bit integers; vectors whose inner
products need more raise an error. Vectors that are null, empty or hold null or non-finite
components take no part; of vectors of different lengths, what the shorter one lacks is zero; a row with the query's own id is never its answer; equal scores go to the smaller id;
repeated rows are answers of their own, while queries that repeat an id count once (the least
vector); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import big_enough, fresh, stored

_RESULT = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and ``v``, floor(scale * x) of each component, of the vectors that take part."""
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.where(F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


def _matrix(column, width: int, kind: type = np.float64) -> np.ndarray:
    """Vectors of a column as rows of whole numbers, with zeros behind the shorter ones."""
    out = np.zeros((len(column), width), kind)
    for row, vector in zip(out, column, strict=True):
        row[: len(vector)] = vector
    return out


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, most - (x * x).sum(1)))


class Routing:
    """The root: routing objects and the largest squared norm."""

    def __init__(self, pivots: np.ndarray, most: float):
        self.pivots, self.most = pivots, most
        self.lifted = _lift(pivots, most)

    def from_vectors(self, x: np.ndarray) -> np.ndarray:
        gap = (x * x).sum(1)[:, None] + (self.pivots**2).sum(1)[None] - 2 * x @ self.pivots.T
        gap += (_lift(x, self.most)[:, None] - self.lifted[None]) ** 2
        return np.sqrt(np.maximum(0.0, gap))

    def from_queries(self, q: np.ndarray) -> np.ndarray:
        gap = (q * q).sum(1)[:, None] + self.most - 2 * q @ self.pivots.T
        return np.sqrt(np.maximum(0.0, gap))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _visit(visits: DataFrame, pages: DataFrame, width: int, kind: type, k: int) -> DataFrame:
    """The best k of each page for each query that visits it."""

    def compare(asked: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(page):
            page = page.sort_values("parent_dist", kind="stable")
            x, ids = _matrix(page["v"], width, kind), page["vec_id"].to_numpy()
            far = page["parent_dist"].to_numpy()
            q, own = _matrix(asked["v"], width, kind), asked["query_id"].to_numpy()
            low = np.searchsorted(far, (asked["dist"] - asked["bound"]).to_numpy(), "left")
            high = np.searchsorted(far, (asked["dist"] + asked["bound"]).to_numpy(), "right")
            for i in range(len(q)):
                part = slice(low[i], high[i])
                scores, there = x[part] @ q[i], ids[part]
                other = there != own[i]
                scores, there = scores[other], there[other]
                best = _best(scores, there, k)
                out.append((np.full(len(best), own[i]), there[best], scores[best]))
        columns = zip(*out, strict=True) if out else ([np.zeros(0)],) * 3
        names = ("query_id", "vec_id", "score")
        return pd.DataFrame(
            {n: np.concatenate(c).astype(np.int64) for n, c in zip(names, columns, strict=True)}
        )

    blocks = visits.select(F.col("page").alias("page_asked"), F.col("block").alias("by")).distinct()
    replicated = pages.join(blocks, F.col("page") == F.col("page_asked")).drop("page")
    return (
        visits.groupBy("page", "block")
        .cogroup(replicated.groupBy("page_asked", "by"))
        .applyInPandas(compare, _RESULT)
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    page_rows: int = 2048,
    max_pivots: int = 256,
    query_block: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each of ``queries``.

    Both have vec_id and ``v``, an array of whole numbers (``whole_vectors``).
    """
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not width:
        return empty
    vectors, queries = (x.where(F.size("v") > 0) for x in (vectors, queries))
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows, most, asked, most_asked = (
        vectors.agg(F.count(F.lit(1)), F.max(norm)).first()
        + queries.agg(F.count(F.lit(1)), F.max(norm)).first()
    )
    if not asked:
        return empty
    largest = max(most, most_asked)
    if largest >= 2.0**62:
        raise ValueError(f"inner products up to {largest:.3g} do not fit 64 bits")
    kind = np.float64 if largest < 2.0**53 else np.int64
    sample = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id")
        .limit(min(max_pivots, big_enough(rows, page_rows)))
        .collect()
    )
    pivots = np.unique(_matrix([r.v for r in sample], width), axis=0)
    root = Routing(pivots, float(most))

    def place(frames):
        for frame in frames:
            if len(frame):
                dist = root.from_vectors(_matrix(frame["v"], width))
                nearest = dist.argmin(1)
                frame["pivot"] = nearest.astype(np.int32)
                frame["parent_dist"] = dist[np.arange(len(frame)), nearest]
                yield frame

    nodes = stored(
        vectors.mapInPandas(place, "vec_id long, v array<long>, pivot int, parent_dist double"),
        "mtree-nodes",
    )
    # One row for each routing object, of which there are max_pivots at most.
    sizes = {r.pivot: r for r in nodes.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    split = F.create_map(
        *[F.lit(x) for p, r in sizes.items() for x in (p, big_enough(r.n, page_rows))]
    )
    salt = F.pmod(F.xxhash64("vec_id"), split[F.col("pivot")])
    pages = nodes.withColumn("page", F.concat_ws(":", "pivot", salt))
    nodes_above = pages.groupBy("pivot", "page").agg(
        F.min("parent_dist").alias("nearest"), F.max("parent_dist").alias("farthest")
    )
    block = F.pmod(F.xxhash64("vec_id"), F.lit(big_enough(asked, query_block))).cast("int")
    at_root = queries.withColumn("block", block)

    def descend(frames):
        for frame in frames:
            if len(frame):
                frame["dists"] = list(root.from_queries(_matrix(frame["v"], width)))
                yield frame

    at_root = at_root.mapInPandas(
        descend, "vec_id long, v array<long>, block int, dists array<double>"
    ).withColumnRenamed("vec_id", "query_id")
    home = at_root.select(
        "*", (F.array_position("dists", F.array_min("dists")) - 1).cast("int").alias("pivot")
    )
    first = home.join(nodes_above, "pivot").select(
        "page",
        "block",
        "query_id",
        "v",
        F.element_at("dists", F.col("pivot") + 1).alias("dist"),
        F.lit(float("inf")).alias("bound"),
    )
    seen = stored(_visit(first, pages, width, kind, k), "mtree-first")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        seen.select("query_id", "score", F.row_number().over(ranked).alias("rank"))
        .where(F.col("rank") == k)
        .select("query_id", F.col("score").alias("kth"))
    )
    squared = norm + F.lit(float(most)) - 2 * F.col("kth").cast("double")
    # A home with fewer than k vectors bounds nothing.
    bound = F.when(F.col("kth").isNull(), F.lit(float("inf"))).otherwise(
        F.sqrt(F.greatest(squared.cast("double"), F.lit(0.0)))
    )
    # Squared distances of large numbers are off by some units of their last place.
    off = 0.0 if kind is np.float64 else 64 * width * 2.0**-52 * largest
    slack = 1e-9 * max(largest, 1.0) ** 0.5 + off**0.5 + 1e-6
    pivot, dist = fresh((), "pivot", "dist")
    rest = (
        home.withColumnRenamed("pivot", "own")
        .join(kth, "query_id", "left")
        .withColumn("bound", bound + F.lit(slack))
        .select("*", F.posexplode("dists").alias(pivot, dist))
        .where(F.col(pivot) != F.col("own"))
        .join(nodes_above, "pivot")
        .where(
            (F.col(dist) - F.col("farthest") <= F.col("bound"))
            & (F.col("nearest") - F.col(dist) <= F.col("bound"))
        )
        .select("page", "block", "query_id", "v", dist, "bound")
    )
    found = seen.unionByName(_visit(rest, pages, width, kind, k))
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
