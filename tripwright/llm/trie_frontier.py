"""Spelling variants: words one edit apart, found by a frontier that walks tries level by level.

The vocabulary is kept as two tries, of the words and of the words read backwards, so that an edit
before a word's middle lies behind the middle in the other one. A trie is a distributed edge table
(parent, label, child): chains without a branch or a word end are one edge, so a level is a branch
and not a letter. Nodes are hashes of prefixes; a word adds its prefixes from one letter before
its middle on, because no neighbour of it branches off earlier there.

The frontier holds states (word, position, node, edits). A word starts without edits at each node
of its own path from its middle on. Every round joins the states with the edges of their nodes: a
state without edits may read a label with one letter replaced or deleted, a state with one edit
must read it as it is. A state that has read its whole word at a word's end makes the two words
neighbours; inserted letters are deleted ones seen from the other word. Rounds go on until no state
is left: their number is that of branches behind an edit, not of letters. A label has one first
letter, so a node has as many edges as the alphabet has letters, whatever the vocabulary's size.

Null texts have no words, a null doc_id counts as an empty text in the hash of a spelling; repeated
rows count again; ties of forms go to the smallest word in code-point order; an empty table gives
no rows; other columns are ignored. Nodes are told apart by 64-bit hashes, and every pair is
compared letter by letter in the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import lean, signed, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points that a task hashes at a time.
SLICE_LETTERS = 1 << 20
_STEP = 0x9E3779B97F4A7C15


def spellings(docs: DataFrame, min_length: int = 5, deleted_one_in: int = 97) -> DataFrame:
    """One row ``word`` for each run of Latin letters, lower-cased in A-Z only.

    One in ``deleted_one_in`` pairs of document and run, by a hash of both, loses a letter. Runs
    that are too short for a word before that are left out here already.
    """
    run = F.explode(
        F.regexp_extract_all(
            F.translate("text", UPPER, LOWER),
            F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"),
            F.lit(0),
        )
    )
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), run.alias("r")
    )
    at = "cast(h % char_length(r) as int)"
    return runs.withColumn("h", F.expr("crc32(encode(concat(d, ':', r), 'UTF-8'))")).selectExpr(
        f"if(h % {deleted_one_in} = 0, concat(substr(r, 1, {at}), substr(r, {at} + 2)), r) AS word"
    )


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word and n of the distinct words that are long and frequent enough."""
    return (
        words.where(F.char_length("word") >= min_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def _scattered(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slices(words: list[str]) -> list[list[str]]:
    """The words in order, in lists of about ``SLICE_LETTERS`` letters."""
    out, room = [], 0
    for word in words:
        if room <= 0:
            out.append([])
            room = SLICE_LETTERS
        out[-1].append(word)
        room -= len(word)
    return out


def _prefixes(words: list[str]) -> pa.RecordBatch:
    """Every kept prefix of each word, in both directions, with the letter that follows."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.array([len(word) for word in words])
    start = np.cumsum(size) - size
    place = np.arange(len(codes)) - np.repeat(start, size)
    weights = np.full(size.max(), _STEP, np.uint64).cumprod()
    low = np.maximum(size // 2 - 1, 0)  # the least depth that counts
    rows = size - low + 1
    which = np.repeat(np.arange(len(words)), rows)
    depth = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows) + low[which]
    columns, keys = [], None
    for side in (0, 1):
        read = codes if side == 0 else codes[np.repeat(start + size - 1, size) - place]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_scattered(read + np.uint64(_STEP)) * weights[place], out=sums[1:])
        hashes = sums[start[which] + depth] - sums[start[which]]
        node = _scattered(hashes + depth.astype(np.uint64) * np.uint64(_STEP) + np.uint64(side))
        ended = depth == size[which]
        follows = np.append(read, np.uint32(0))[start[which] + depth].astype(np.int32)
        follows[ended] = -1
        if keys is None:
            keys = node[ended]
        columns.append((keys[which], np.full(len(which), side, np.int8), depth, node, follows))
    key, side, depth2, node, follows = (np.concatenate(c) for c in zip(*columns, strict=True))
    middle = depth2 == np.concatenate([size[which] // 2] * 2)
    return pa.RecordBatch.from_arrays(
        [
            signed(key),
            pa.array(side),
            pa.array(depth2.astype(np.int32)),
            signed(node),
            pa.array(follows),
            pa.array(middle),
        ],
        ["key", "side", "depth", "node", "follows", "middle"],
    )


def _prefix_rows(batches):
    for batch in lean(batches):
        for words in _slices(batch["word"].to_pylist()):
            yield _prefixes(words)


def _word_keys(batches):
    for batch in lean(batches):
        for words in _slices(batch["word"].to_pylist()):
            rows = _prefixes(words).to_pandas()
            own = rows[(rows["follows"] == -1) & (rows["side"] == 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own["key"].to_numpy()), pa.array(words)], ["key", "word"]
            )


def routes(words: DataFrame) -> DataFrame:
    """word, n, side, spelled (backwards on side 1) and its ``stops``: the nodes of its path."""
    prefixes = stored(
        words.select("word").mapInArrow(
            _prefix_rows,
            "key long, side byte, depth int, node long, follows int, middle boolean",
        ),
        "prefixes",
    )
    nodes = (
        prefixes.groupBy("node")
        .agg(
            F.min("follows").alias("lo"),
            F.max("follows").alias("hi"),
            F.max("middle").alias("middle"),
        )
        .where("lo = -1 OR lo <> hi OR middle")
        .select("node")
    )
    # A word's path has at most as many stops as the word has letters.
    stops = (
        prefixes.select("key", "side", "depth", "node")
        .join(stored(nodes, "nodes"), "node")
        .groupBy("key", "side")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("stops"))
    )
    keyed = words.select("word").mapInArrow(_word_keys, "key long, word string").join(words, "word")
    return stored(
        stops.join(keyed, "key").selectExpr(
            "word", "n", "if(side = 0, word, reverse(word)) AS spelled", "stops"
        ),
        "routes",
    )


def edges(routes: DataFrame) -> DataFrame:
    """parent, child, label, the letters further on and the word (with its n) ending at the child."""
    hop = F.explode(F.expr("sequence(0, size(stops) - 2)")).alias("i")
    pair = (
        routes.where("size(stops) > 1")
        .select("word", "n", "spelled", "stops", hop)
        .selectExpr("word", "n", "spelled", "stops[i] AS a", "stops[i + 1] AS b")
    )
    ends = "b.depth = char_length(spelled)"
    label = "substr(spelled, a.depth + 1, b.depth - a.depth)"
    plain = stored(
        pair.selectExpr(
            "b.node AS child",
            "a.node AS parent",
            f"{label} AS label",
            f"if({ends}, named_struct('word', word, 'n', n), NULL) AS at",
        )
        .groupBy("child")
        .agg(F.min("parent").alias("parent"), F.min("label").alias("label"), F.max("at").alias("at"))
        .withColumn("first", F.expr("substr(label, 1, 1)")),
        "edges",
    )
    # At most as many letters as the alphabet has.
    further = plain.groupBy(F.col("parent").alias("child")).agg(
        F.array_join(F.collect_set("first"), "").alias("further")
    )
    return stored(
        plain.join(further, "child", "left").withColumn("further", F.coalesce("further", F.lit(""))),
        "edges",
    )


_LEFT = "char_length(spelled) - pos"


#: What can't go on behind a label is not kept: neither a word nor an edge begins there.
_GOES_ON = (
    f"if({_LEFT} = 0, at IS NOT NULL, contains(further, substr(spelled, pos + 1, 1)))"
)
_STATE = ["word", "n", "spelled", "pos", "child AS node", "at"]


def _one_edit(states: DataFrame, trie: DataFrame) -> DataFrame:
    """States that read the label of an edge with one letter replaced or deleted."""
    size = "char_length(label)"
    # A label of one letter is the common case.
    replaced = (
        f"if({size} = 1, {_LEFT} > 0 AND substr(spelled, pos + 1, 1) <> label,"
        f" {_LEFT} >= {size} AND levenshtein(substr(spelled, pos + 1, {size}), label, 1) = 1)"
    )
    deleted = (
        f"if({size} = 1, {_LEFT} > 1 AND contains(substr(spelled, pos + 1, 2), label),"
        f" {_LEFT} > {size} AND levenshtein(substr(spelled, pos + 1, {size} + 1), label, 1) = 1)"
    )
    met = states.join(trie, states["node"] == trie["parent"])
    after = f"array(if({replaced}, pos + {size}, NULL), if({deleted}, pos + {size} + 1, NULL))"
    return (
        met.select(
            "word", "n", "spelled", "child", "at", "further", F.explode(F.expr(after)).alias("pos")
        )
        .where(f"pos IS NOT NULL AND {_GOES_ON}")
        .selectExpr(_STATE)
    )


def _no_edit(states: DataFrame, trie: DataFrame) -> DataFrame:
    """States that read the label of an edge as it is."""
    opens = F.expr("substr(spelled, pos + 1, 1)")
    return (
        states.withColumn("opens", opens)
        .join(trie, (F.col("node") == F.col("parent")) & (F.col("opens") == F.col("first")))
        .where("substr(spelled, pos + 1, char_length(label)) = label")
        .withColumn("pos", F.expr("pos + char_length(label)"))
        .where(_GOES_ON)
        .selectExpr(_STATE)
    )


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, near and near_n of all ordered pairs of words that are exactly one edit apart."""
    paths = routes(words)
    trie = edges(paths)
    stop = F.explode("stops").alias("stop")
    states = (
        paths.select("word", "n", "spelled", stop)
        .where("stop.depth >= char_length(spelled) div 2 AND stop.depth < char_length(spelled)")
        .selectExpr("word", "n", "spelled", "stop.depth AS pos", "stop.node AS node")
    )
    step, found = _one_edit, None
    while True:
        reached = stored(step(states, trie), "frontier")
        met = reached.where(f"{_LEFT} = 0 AND at IS NOT NULL").selectExpr(
            "word", "n", "at.word AS near", "at.n AS near_n"
        )
        found = met if found is None else found.union(met)
        states = reached.where(f"{_LEFT} > 0").drop("at")
        if states.isEmpty():
            break
        step = _no_edit
    both = found.union(found.selectExpr("near", "near_n", "word", "n"))
    return both.distinct().where("levenshtein(word, near, 1) = 1")


def _roots(named: DataFrame) -> DataFrame:
    """word and root of the words that have a form, by following forms twice as far each round.

    n at least doubles from a word to its form, so there are few rounds.
    """
    now = stored(named.where("form IS NOT NULL").selectExpr("word", "form AS root"), "roots")
    while True:
        ahead = now.selectExpr("word AS root", "root AS further")
        farther = stored(
            now.join(ahead, "root", "left").selectExpr(
                "word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"
            ),
            "roots",
        )
        now = farther.drop("moved")
        if farther.where("moved").isEmpty():
            return now


def forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Each word with its form, the root of its forms, its near words' number and the form's n."""
    words = stored(words.select("word", "n"), "vocabulary")
    near = (
        neighbours(words)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"),
        )
    )
    often = f"-best.minus >= {ratio} * n"
    named = stored(
        words.join(near, "word", "left").selectExpr(
            "word",
            "n",
            "coalesce(n_near, 0L) AS n_near",
            f"if({often}, best.near, NULL) AS form",
            f"if({often}, -best.minus, NULL) AS form_n",
        ),
        "forms",
    )
    return named.join(_roots(named), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """The spelling variants among the words of whole texts."""
    return forms(vocabulary(spellings(docs, min_length), min_length, min_count))
