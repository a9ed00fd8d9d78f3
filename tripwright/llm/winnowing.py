"""Benchmark decontamination by winnowed fingerprints.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words is one window.
Of every ``WINDOW - GRAM + 1`` consecutive k-grams (one window's worth) the smallest hash is kept.
The choice depends on nothing but those words, so a window that occurs in a document leaves the same
fingerprint in both, and every shared span of a window or more is found. Short items have no whole
winnow span; the fingerprint of one is its own whole hash, looked up at every document word.

The documents are scanned once, without a shuffle. A fixed-size Bloom filter of the benchmark's
fingerprints drops nearly all of theirs; each that passes is extended to the windows around it,
and these are joined with the benchmark's windows on two independent 64-bit hashes.

A document word inside any occurrence of a window is hit. A document is contaminated when it has a
hit and its hits are at least ``least_share`` of its words.

Null texts have no words: they are never hit, and such an item never occurs. Results follow rows:
rows that repeat a doc_id each get their own, null doc_ids too. Items that repeat an id count once;
those without an id hit like others, but are not among the items named or counted.
An empty benchmark hits nothing; an empty table gives no rows. ``decontaminate`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import Bloom, fresh, lean, ragged, signed, stored
from tripwright.llm.words import ALPHANUMERIC, mix, ngrams, words

WINDOW, GRAM = 13, 8
_SEED = np.uint64(0x5851F42D4C957F2D)


def _pair(hashes: np.ndarray, starts: np.ndarray, n: int):
    """Two independent hashes of the n words from each word on, and whether they are whole."""
    first, whole = ngrams(hashes, starts, n)
    second, _ = ngrams(mix(hashes ^ _SEED), starts, n)
    return first, second, whole


def _selected(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether winnowing keeps the k-gram at each word."""
    grams, whole = ngrams(hashes, starts, GRAM)
    span = WINDOW - GRAM + 1
    keep = np.zeros(len(grams), bool)
    if len(grams) < span:
        return keep
    grams = np.where(whole, grams, np.uint64(0xFFFFFFFFFFFFFFFF))
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    least = view.min(1)
    last = whole[span - 1 :].copy()  # the span lies in one text when its last k-gram does
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    last &= owner[: len(last)] == owner[span - 1 :]
    for j in range(span):  # every place of the least hash, so ties can't matter
        keep[j : j + len(least)] |= last & (view[:, j] == least)
    return keep


def _windows(items: DataFrame) -> DataFrame:
    """size, first, second, fingerprints and item_id of every distinct window of every item."""

    def cut(batches):
        for batch in lean(batches):
            ids = batch["item_id"]
            for w in words(batch["text"], ALPHANUMERIC):
                own = w.first + np.arange(len(w.counts))
                first, second, whole = _pair(w.hashes, w.starts, WINDOW)
                grams, _ = ngrams(w.hashes, w.starts, GRAM)
                at, rows = np.flatnonzero(whole), []
                least = grams[at[:, None] + np.arange(WINDOW - GRAM + 1)].min(1)
                rows.append((own[w.owner[at]], np.full(len(at), WINDOW), first[at], second[at], least))
                for n in np.unique(w.counts[(w.counts > 0) & (w.counts < WINDOW)]):
                    one, two, _ = _pair(w.hashes, w.starts, int(n))
                    short = np.flatnonzero(w.counts == n)
                    at = w.starts[short]
                    rows.append((own[short], np.full(len(at), n), one[at], two[at], one[at]))
                cols = [np.concatenate(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0])), pa.array(cols[1].astype(np.int32))]
                    + [signed(c) for c in cols[2:]],
                    ["item_id", "size", "first", "second", "fingerprint"],
                )

    schema = "item_id long, size int, first long, second long, fingerprint long"
    known = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return known.mapInArrow(cut, schema).distinct()


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n_words, n_hit, n_items and items (ids sorted as strings) of each
    row of ``docs``."""
    windows = stored(_windows(items), "winnow-windows")
    long = Bloom.of(windows.where(F.col("size") == WINDOW).select("fingerprint"))
    short = Bloom.of(windows.where(F.col("size") < WINDOW).select("fingerprint"), 1 << 20)
    sizes = [r.size for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect()]

    def scan(batches):
        for batch in lean(batches):
            for w in words(batch["text"], ALPHANUMERIC):
                grams, _ = ngrams(w.hashes, w.starts, GRAM)
                seeds = np.flatnonzero(_selected(w.hashes, w.starts))
                seeds = seeds[long.has(grams[seeds])]
                # A window holds a k-gram at one of these places.
                at = np.unique((seeds[:, None] - np.arange(WINDOW - GRAM + 1)[None]).ravel())
                at = at[at >= 0]
                found = []
                if len(at):
                    first, second, whole = _pair(w.hashes, w.starts, WINDOW)
                    at = at[whole[at]]
                    found.append((at, np.full(len(at), WINDOW), first[at], second[at]))
                for n in sizes:
                    one, two, whole = _pair(w.hashes, w.starts, n)
                    at = np.flatnonzero(whole)
                    at = at[short.has(one[at])]
                    found.append((at, np.full(len(at), n), one[at], two[at]))
                at, size, first, second = (
                    [np.concatenate(c) for c in zip(*found, strict=True)]
                    if found
                    else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
                )
                order = np.argsort(at, kind="stable")
                at, size, first, second = at[order], size[order], first[order], second[order]
                edges = np.searchsorted(at, w.starts)
                at = at - w.starts[np.searchsorted(w.starts, at, "right") - 1]
                rows = batch.slice(w.first, len(w.counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"],
                        rows["key"],
                        pa.array(w.counts.astype(np.int64)),
                        ragged(at.astype(np.int64), edges),
                        ragged(size.astype(np.int32), edges),
                        ragged(first.view(np.int64), edges),
                        ragged(second.view(np.int64), edges),
                    ],
                    ["doc_id", "key", "n_words", "at", "size", "first", "second"],
                )

    schema = (
        "doc_id long, key string, n_words long, at array<long>, size array<int>, "
        "first array<long>, second array<long>"
    )
    # Rows of the same text have the same hits, so the text stands for them.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("key"),
        "text",
    )
    scanned = stored(keyed.mapInArrow(scan, schema), "winnow-scan")
    spans = (
        scanned.where(F.size("at") > 0)
        .select("key", F.explode(F.arrays_zip("at", "size", "first", "second")).alias("w"))
        .select("key", "w.*")
        .distinct()
    )
    matched = spans.join(windows.drop("fingerprint"), ["size", "first", "second"])
    # Overlapping windows run into one another: count each word once.
    stretched = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", F.col("size").cast("long").alias("size")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, x: F.struct(
            (
                a["n"]
                + F.greatest(F.lit(0).cast("long"), x["at"] + x["size"] - F.greatest(x["at"], a["upto"]))
            ).alias("n"),
            F.greatest(a["upto"], x["at"] + x["size"]).alias("upto"),
        ),
    )["n"]
    found = matched.groupBy("key").agg(
        stretched.alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    # A table of its own: then a text that many rows repeat can be split in the join.
    found = stored(found, "winnow-found")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return scanned.join(found, "key", "left").select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        items_found.alias("items"),
    )


def contaminated(least_share: float = 0.05):
    """The rule over the columns of ``hits``; a share of 1 / whole number is exact."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * round(1 / least_share) >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, least_share: float = 0.05) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with all their columns."""
    (key,) = fresh(docs.columns, "winnow_key")
    dirty = hits(docs, items).where(contaminated(least_share)).select(F.col("key").alias(key))
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    return keyed.join(stored(dirty.distinct(), "winnow-dirty"), key, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
