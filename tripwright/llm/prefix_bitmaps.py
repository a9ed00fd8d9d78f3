"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt by ranges of their id, in groups of 100 that are never parted. A task reads
its range in order and cuts it into shards of ``SHARD`` conversations. In a shard every (position,
turn) has a bitset of the conversations with that turn there. A node is a bitset of conversations;
its children are found depth first: the turn of its first conversation left, the intersection with
that turn's bitset, and on with the rest. Popcounts are the members, and the bits whose conversation
is over are the node's end list.

A node is known by a chained 128-bit hash of its turns, the same in every shard, so the parts of a
node are merged by sums and minima that combine before the shuffle: the node of a first turn that a
third of all conversations share costs one row a shard. End lists stay in blocks of a shard, which
are in ascending order of shards; a hash over a node's list reads block after block and holds one.
Sums over subtrees take rounds that double their reach, each a grouped sum by the ancestor 1, 2, 4
... levels up and a join of single rows. Those ancestors are written beside the node by the shard,
so no join looks up a node that many others are below.

Turns are in order of ``turn``, null first, then of role and a hash of the text. A null role or
text is empty, rows without a conv_id belong to no conversation, repeated rows are repeated turns,
a conversation without turns ends at the root, an empty table has no nodes, and other columns are
ignored. A conversation is read by one task, as 32 bytes a turn. Turns are told apart by 128-bit
hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import big_enough, lean, stored

#: Conversations in a shard, which are the bits of its bitsets, and turns after which it is closed.
SHARD, SHARD_TURNS = 4096, 100_000
GROUP, MOST_SHARED = 100, 6
#: Nodes in an Arrow batch.
BATCH_NODES = 4096

Turn = tuple[bytes, int]  # hash and code points of the text

_PART = (
    "node binary, parent binary, depth long, n_convs long, conv_id long, chars long, "
    "shard long, ends string, jumps array<binary>"
)


def rebuilt(conv_id: int, own: list[Turn], first: list[Turn]) -> list[Turn]:
    """The turns of a conversation, of which some at the front are those of its group's first one."""
    h = zlib.crc32(str(conv_id).encode()) % MOST_SHARED
    return first[:h] + own[h:]


def _conversations(rows: Iterable[tuple]) -> Iterator[tuple[int, list[Turn]]]:
    """Rebuilt conversations from rows in order of group, conversation and turn."""
    group, first, now, own = None, [], None, []
    for base, conv_id, turn, chars in rows:
        if conv_id != now:
            if now is not None:
                first = own[:MOST_SHARED] if now == group else first
                yield now, rebuilt(now, own, first)
            now, own = conv_id, []
        if base != group:
            group, first = base, []
        own.append((turn, chars))
    if now is not None:
        yield now, rebuilt(now, own, own[:MOST_SHARED] if now == group else first)


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def shard_nodes(ids: list[int], turns: list[list[Turn]]) -> Iterator[tuple]:
    """node, parent, depth, members, least member, chars, end list and ancestors 1, 2, 4 ... up."""
    postings: dict[tuple[int, Turn], int] = {}
    over: dict[int, int] = {}
    for i, said in enumerate(turns):
        bit = 1 << i
        over[len(said)] = over.get(len(said), 0) | bit
        for at in enumerate(said):
            postings[at] = postings.get(at, 0) | bit
    path: list[bytes] = []
    stack = [(0, (1 << len(ids)) - 1, b"", 0)]
    while stack:
        depth, members, turn, chars = stack.pop()
        del path[depth:]
        parent = path[-1] if path else None
        node = hashlib.blake2b((parent or b"") + turn, digest_size=16).digest()
        path.append(node)
        ended = members & over.get(depth, 0)
        least = ids[(members & -members).bit_length() - 1]
        ends = ",".join([str(ids[i]) for i in _bits(ended)]) if ended else None
        jumps, up = [], 1
        while up <= depth:
            jumps.append(path[depth - up])
            up *= 2
        yield node, parent, depth, members.bit_count(), least, chars, ends, jumps
        rest = members ^ ended
        while rest:
            said = turns[(rest & -rest).bit_length() - 1][depth]
            child = rest & postings[depth, said]
            stack.append((depth + 1, child, *said))
            rest ^= child


def _shards(rows: Iterable[tuple]) -> Iterator[tuple[list[int], list[list[Turn]]]]:
    ids, turns, size = [], [], 0
    for conv_id, said in _conversations(rows):
        ids.append(conv_id)
        turns.append(said)
        size += len(said)
        if len(ids) == SHARD or size > SHARD_TURNS:
            yield ids, turns
            ids, turns, size = [], [], 0
    if ids:
        yield ids, turns


def _node_parts(batches):
    """Nodes of each shard of a range; shards are numbered in order of their conversations."""

    def rows():
        for batch in lean(batches):
            columns = [batch[n].to_pylist() for n in ("base", "conv_id", "said", "chars")]
            yield from zip(*columns, strict=True)

    names = [column.split()[0] for column in _PART.split(", ")]
    kinds = [pa.binary()] * 2 + [pa.int64()] * 5 + [pa.string(), pa.list_(pa.binary())]

    def batch(found):
        columns = list(zip(*found, strict=True)) if found else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )

    number = TaskContext.get().partitionId() << 32
    found = []
    for ids, turns in _shards(rows()):
        for *head, ends, jumps in shard_nodes(ids, turns):
            found.append((*head, number, ends, jumps))
            if len(found) == BATCH_NODES:
                yield batch(found)
                found = []
        number += 1
    yield batch(found)


def node_parts(conversations: DataFrame, range_turns: int = 100_000) -> DataFrame:
    """The nodes of every shard; about ``range_turns`` turns go to a task."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    read = conversations.where("conv_id IS NOT NULL").select(
        F.expr(f"conv_id - pmod(conv_id, {GROUP})").cast("long").alias("base"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.encode(named, "UTF-8"))).alias("said"),
        F.char_length(text).cast("long").alias("chars"),
    )
    parts = big_enough(conversations.count(), range_turns)
    dealt = read.repartitionByRange(parts, "base").sortWithinPartitions(
        "base", "conv_id", F.asc_nulls_first("turn"), "role", "said"
    )
    return stored(dealt.drop("turn", "role").mapInArrow(_node_parts, _PART), "node-parts")


def _hashes_of_ends(batches):
    """SHA-256 of each node's end list, from its blocks in ascending order."""
    node, state = None, None

    def rows(found):
        nodes, hashes = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"]
        )

    for batch in lean(batches):
        done = []
        for name, ends in zip(
            batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True
        ):
            if name != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield rows(done)
    yield rows([(node, state.hexdigest())] if state is not None else [])


def _subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """node and, for each value, its sum over the node and all nodes below it.

    Before round k a row holds the sum over all nodes less than 2^k levels below.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    now = nodes.select("node", "jumps", *values)
    for k in range(deepest.bit_length()):
        below = (
            now.where(F.size("jumps") > k)
            .groupBy(F.col("jumps")[k].alias("node"))
            .agg(*[F.sum(v).alias(f"{v}_below") for v in values])
        )
        sums = [(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in values]
        now = stored(now.join(below, "node", "left").select("node", "jumps", *sums), "subtrees")
    return now.drop("jumps")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, counts, saved_tokens and ends_sha256."""
    parts = node_parts(conversations)
    nodes = stored(
        parts.groupBy("node").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.min("chars").alias("chars"),
            F.min("jumps").alias("jumps"),
        ),
        "nodes",
    )
    ends = (
        parts.where("ends IS NOT NULL")
        .select("node", "shard", "ends")
        .repartition("node")
        .sortWithinPartitions("node", "shard")
        .select("node", "ends")
        .mapInArrow(_hashes_of_ends, "node binary, ends_sha256 string")
    )
    children = (
        nodes.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = stored(
        nodes.join(children, "node", "left").select(
            *nodes.columns,
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "nodes",
    )
    sums = _subtree_sums(counted, ["n_leaves", "saved_tokens"])
    full = stored(
        counted.drop("n_leaves", "saved_tokens", "jumps", "chars")
        .join(sums, "node")
        .join(ends, "node", "left")
        .withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
        ),
        "nodes",
    )
    above = full.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(above, "parent", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
