"""Exact Jaccard join of documents on word 5-shingles, by set relations.

Documents with equal shingle sets are one node; links are looked for between nodes only.

*Index.* Shingles are ordered by how many nodes hold them, rare first. Two sets of a Jaccard of
0.8 or more share a shingle among the first ``n - ceil(0.8 n) + 1`` of either, so only these prefixes are
indexed, each entry with its position. Shingles that no other node holds are never indexed: they
only push the others back. Counts are exact, from one shuffle of packed hashes, but for a bounded
number of very frequent shingles, which are counted where they are frequent and come last.

*Skipping.* An index list is cut into blocks by size class, and only equal and neighbouring blocks can
hold partners. Within those an entry is skipped when positions alone bound the overlap too low:
at the first shingle that two sets have in common, only what follows in both can be common too.

*Answers from similar sets.* In each list the set with the fewest shingles of its own leads. Every
member is compared with its leaders first; what is similar to the same leader is already connected,
and is not compared again. Only pairs of a list that are still in different components are compared
after that. So a group of near copies costs as many comparisons as it has members, and still
no link between components is lost.

Links go by exact counts of common shingle hashes (64 bits). Null and empty texts have no shingles
and link with nothing; a text of fewer than five words has its whole sequence as its only shingle.
Rows that repeat a doc_id each get their row; a null doc_id takes part, but is never the smallest
of a component unless all are null. An empty table gives no rows. Other columns are ignored by
``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import Bloom, big_enough, lean, ragged, signed, stored, with_places
from tripwright.llm.components import components
from tripwright.llm.words import UNSPACED, Words, mix, shingles, words

#: Jaccard threshold as a fraction.
OVER, UNDER = 80, 100
#: Shingles kept as frequent at most, and the least count of one.
FREQUENT, FREQUENT_COUNT = 1 << 16, 256
#: A shingle is counted as possibly frequent where it comes this often in a slice.
LOCAL_COUNT = 8
#: Packed shingles that one task of the counting shuffle holds, about.
BUCKET_SHINGLES = 1_000_000
_U = np.uint64


def distinct_shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in ascending order, and the text of each."""
    hashes, starts = shingles(w)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def set_hash(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """A hash of each text's set of shingles."""
    total = np.zeros(n, _U)
    np.add.at(total, owner, mix(hashes ^ _U(0x2545F4914F6CDD1D)))
    return mix(total)


def _prefix(n: np.ndarray) -> np.ndarray:
    return n - -(-OVER * n // UNDER) + 1


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The very frequent shingles, ascending, and the place of each in the order of shingles."""

    def count(batches):
        for batch in lean(batches):
            for w in words(batch["text"], UNSPACED):
                values, n = np.unique(shingles(w)[0], return_counts=True)
                often = n >= LOCAL_COUNT
                if often.any():
                    yield pa.RecordBatch.from_arrays(
                        [signed(values[often]), pa.array(n[often].astype(np.int64))], ["token", "n"]
                    )

    rows = (
        texts.mapInArrow(count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT_COUNT)
        .orderBy(F.desc("n"), "token")
        .limit(FREQUENT)
        .toArrow()
    )
    tokens, n = rows["token"].to_numpy().view(_U), rows["n"].to_numpy()
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, n))] = np.arange(len(tokens))
    order = np.argsort(tokens)
    return tokens[order], rank[order]


def _place(frequent: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[at] == hashes, at, -1)


def _nodes(docs: DataFrame, frequent: np.ndarray, rank: np.ndarray, keys: list[str]) -> DataFrame:
    """doc_id, n, node (null without shingles), rare (shingles that aren't frequent), last, the
    frequent shingles in the prefix, and the keys, columns of longs."""

    def describe(batches):
        for batch in lean(batches):
            for w in words(batch["text"], UNSPACED):
                hashes, owner = distinct_shingles(w)
                n = len(w.counts)
                size = np.bincount(owner, minlength=n)
                at = _place(frequent, hashes)
                rare = size - np.bincount(owner[at >= 0], minlength=n)
                want = np.maximum(0, _prefix(size) - rare) * (size > 0)
                late = np.flatnonzero(at >= 0)
                late = late[np.lexsort((rank[at[late]], owner[late]))]
                of = owner[late]
                nth = np.arange(len(late)) - np.searchsorted(of, of)
                late = late[nth < want[of]]
                edges = np.searchsorted(owner[late], np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(w.first, n),
                        pa.array(size.astype(np.int64)),
                        pa.array(set_hash(hashes, owner, n).view(np.int64), mask=size == 0),
                        pa.array(rare.astype(np.int64)),
                        ragged(hashes[late].view(np.int64), edges),
                        *[batch[key].slice(w.first, n) for key in keys],
                    ],
                    ["doc_id", "n", "node", "rare", "last", *keys],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys)
    schema = "doc_id long, n long, node long, rare long, last array<long>"
    schema += "".join(f", {key} long" for key in keys)
    return stored(source.mapInArrow(describe, schema), "set-nodes")


def _shared(texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """node, token and count (of nodes) of every rare shingle that two nodes hold or more."""

    def pack(batches):
        for batch in lean(batches):
            for w in words(batch["text"], UNSPACED):
                hashes, owner = distinct_shingles(w)
                node = set_hash(hashes, owner, len(w.counts))
                rare = _place(frequent, hashes) < 0
                hashes, owner = hashes[rare], owner[rare]
                bucket = (hashes >> _U(32)) % _U(buckets)
                order = np.lexsort((hashes, bucket))
                hashes, owner, bucket = hashes[order], owner[order], bucket[order]
                if not len(bucket):  # no text of the slice has a rare shingle
                    continue
                edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                rows = []
                for low, high in zip(edges, [*edges[1:], len(bucket)], strict=True):
                    own, code = np.unique(owner[low:high], return_inverse=True)
                    kind = np.uint16 if len(own) <= 1 << 16 else np.uint32
                    rows.append(
                        (
                            int(bucket[low]),
                            hashes[low:high].tobytes(),
                            code.astype(kind).tobytes(),
                            node[own].tobytes(),
                        )
                    )
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                        ["bucket", "tokens", "codes", "nodes"],
                    )

    def count(table: pa.Table) -> pa.Table:
        n = pc.sum(pc.binary_length(table["tokens"])).as_py() // 8
        tokens, nodes, at = np.empty(n, _U), np.empty(n, _U), 0
        for row in zip(*(table[x] for x in ("tokens", "codes", "nodes")), strict=True):
            t, c, d = (np.frombuffer(x.as_buffer(), np.uint8) for x in row)
            codes = c.view(np.uint16 if 4 * len(c) == len(t) else np.uint32)
            end = at + len(codes)
            tokens[at:end], nodes[at:end] = t.view(_U), d.view(_U)[codes]
            at = end
        # Only shingles that come twice matter; copies of one set count once.
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order]
        del order
        same = np.zeros(len(tokens), bool)
        same[1:] = tokens[1:] == tokens[:-1]
        same[:-1] |= same[1:]
        tokens, nodes = tokens[same], nodes[same]
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
        tokens, nodes = tokens[new], nodes[new]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else []
        counts = np.diff(np.append(first, len(tokens))).astype(np.int64)
        times = np.repeat(counts, counts)
        keep = np.flatnonzero(times >= 2)
        keep = keep[np.argsort(nodes[keep], kind="stable")]
        return pa.table(
            {
                "node": signed(nodes[keep]),
                "token": signed(tokens[keep]),
                "count": pa.array(times[keep].astype(np.int32)),
            }
        )

    packed = texts.mapInArrow(pack, "bucket int, tokens binary, codes binary, nodes binary")
    return packed.groupBy("bucket").applyInArrow(count, "node long, token long, count int")


def _index(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """token, node, n, pos, own (shingles no other node holds): the prefix entries of all lists
    of two nodes or more."""
    kinds = nodes.where("node is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("rare").alias("rare"), F.first("last").alias("last")
    )
    kinds = stored(kinds, "set-kinds")
    of_node = Window.partitionBy("node")
    prefix = F.expr(f"n - (n * {OVER} + {UNDER - 1}) div {UNDER} + 1")
    ranked = (
        shared.join(kinds.select("node", "n", "rare", (F.size("last") > 0).alias("late")), "node")
        .withColumns(
            {
                "own": F.col("rare") - F.count(F.lit(1)).over(of_node),
                "nth": F.row_number().over(of_node.orderBy("count", "token")),
            }
        )
        .withColumn("pos", F.col("own") + F.col("nth") - 1)
        .where((F.col("pos") < prefix) | ((F.col("nth") == 1) & F.col("late")))
        .select("token", "node", "n", "pos", "own", "nth", "late")
    )
    ranked = stored(ranked, "set-ranked")
    rare = ranked.where(F.col("pos") < prefix).select("token", "node", "n", "pos", "own")
    # Other nodes hold the frequent shingles; a node without shared rare ones has only its own.
    known = ranked.where((F.col("nth") == 1) & F.col("late")).select("node", "own")
    late = (
        kinds.where(F.size("last") > 0)
        .join(known, "node", "left")
        .select(
            F.posexplode("last").alias("nth", "token"),
            "node",
            "n",
            "rare",
            F.coalesce("own", "rare").alias("own"),
        )
        .select("token", "node", "n", (F.col("rare") + F.col("nth")).alias("pos"), "own")
    )
    entries = stored(rare.unionByName(late), "set-index")
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return stored(entries.join(lists.select("token"), "token", "left_semi"), "set-lists")


def _possible(a: str, b: str) -> Column:
    """Whether two entries of one list can be the first that linked sets have in common.

    Then all before them differ, so positions bound the overlap, and with it sizes.
    """
    n, m, p, q = (F.col(f"{x}.{c}") for c in ("n", "pos") for x in (a, b))
    return (UNDER + OVER) * F.least(n - p, m - q) >= OVER * (n + m)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the exact overlap of their sets."""

    def compare(batches):
        for batch in (b.slice(k, 128) for b in lean(batches) for k in range(0, b.num_rows, 128)):
            keep = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(UNDER * common >= OVER * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    # The side that varies first: the leaders, often met, come to it in the second join.
    joined = pairs.join(right, "b").join(left, "a")
    return stored(joined.mapInArrow(compare, "a long, b long"), "set-links")


def _sets(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """node and tokens (packed) of the nodes in any list."""
    active = entries.select("node").distinct()
    near = Bloom.of(active)

    def pack(batches):
        for batch in lean(batches):
            for w in words(batch["text"], UNSPACED):
                hashes, owner = distinct_shingles(w)
                node = set_hash(hashes, owner, len(w.counts))
                edges = np.searchsorted(owner, np.arange(len(w.counts) + 1))
                some = np.flatnonzero(near.has(node) & (np.diff(edges) > 0))
                _, first = np.unique(node[some], return_index=True)
                some = some[first]
                if len(some):
                    packed = [hashes[edges[i] : edges[i + 1]].tobytes() for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [signed(node[some]), pa.array(packed, pa.binary())], ["node", "tokens"]
                    )

    packed = texts.mapInArrow(pack, "node long, tokens binary")
    return stored(
        packed.join(active, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens")),
        "set-tokens",
    )


def _links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges that connect exactly the nodes that links connect."""
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1.25)))).cast("int")
    entries = entries.withColumn("block", size_class)
    # The leader of each list and block: the set with the fewest shingles of its own.
    lead = entries.groupBy("token", "block").agg(
        F.min(F.struct("own", F.xxhash64("node").alias("tie"), "node", "n", "pos")).alias("of")
    )
    lead = lead.select("token", F.col("block").alias("near"), "of.*").drop("tie")
    around = F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1))
    first = (
        entries.withColumn("near", around)
        .alias("e")
        .join(lead.alias("l"), ["token", "near"])
        .where((F.col("e.node") != F.col("l.node")) & _possible("e", "l"))
        .select(F.col("l.node").alias("a"), F.col("e.node").alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    tried = stored(first, "set-tried")
    linked = _verified(tried, sets)

    roots = components(linked)
    placed = stored(
        entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")),
        "set-placed",
    )
    # Lists inside one component have nothing left to compare.
    open_lists = (
        placed.groupBy("token")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least != most")
        .select("token")
    )
    left = stored(placed.join(open_lists, "token", "left_semi"), "set-open")
    rest = (
        left.alias("x")
        .join(left.withColumn("near", around).alias("y"), "token")
        .where(
            (F.col("x.block") == F.col("y.near"))
            & (F.col("x.node") < F.col("y.node"))
            & (F.col("x.root") != F.col("y.root"))
            & _possible("x", "y")
        )
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    return linked.union(_verified(stored(rest, "set-rest"), sets))


def _rooted(docs: DataFrame, *keys: str) -> DataFrame:
    """doc_id, n, root (of the component; null without shingles) and the keys of each row."""
    texts = docs.select("text")
    frequent, rank = _frequent(texts)
    nodes = _nodes(docs, frequent, rank, list(keys))
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = _shared(texts, frequent, big_enough(total, BUCKET_SHINGLES))
    entries = _index(nodes, shared)
    roots = components(_links(entries, _sets(texts, entries)))
    return stored(
        nodes.select("doc_id", "n", "node", *keys)
        .join(roots, "node", "left")
        .select("doc_id", "n", F.coalesce("root", "node").alias("root"), *keys),
        "set-roots",
    )


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of each row."""
    placed = _rooted(docs)
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, with all their columns.

    The row of the smallest doc_id stays (a null one if all are), of rows that repeat it the one
    with the least hash of its text, and of equal ones the first by its place in the stored files.
    Rows without shingles all stay.
    """
    docs, place = with_places(docs)
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("mark"),
        *[column.alias(name) for column, name in zip(place.values(), ("file", "row"), strict=True)],
    )
    found = _rooted(keyed, "mark", "file", "row").where("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark", "file", "row")
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    file, row = place
    gone = (
        found.join(first.select("root", "first.file", "first.row").toDF("root", "one", "nth"), "root")
        .where((F.col("file") != F.col("one")) | (F.col("row") != F.col("nth")))
        .select(F.col("file").alias(file), F.col("row").alias(row))
    )
    gone = stored(gone, "set-gone")
    placed = docs.withColumns(place)
    return placed.join(gone, [file, row], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
