"""Packing against the library's own ids, and every sequence put together again."""

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripwright.llm import min_slack
from tripwright.llm.queries import word_tokenizer

SF = "/root/testdata/sf0.001"


@cache
def library():
    return Tokenizer.from_file(word_tokenizer())


def whole_ids(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, texts, capacity):
    """Pieces put together are the documents; sequences have no gap and no padding."""
    wanted = Counter(tuple(whole_ids(t)) for t in texts)
    ids_of = Counter()
    by_doc, by_sequence = {}, {}
    for row in pieces:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert len(ids) == row.length > 0
        by_doc.setdefault((row.doc_id, row.doc_tokens), []).append((row.start, ids))
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for (_, n), parts in by_doc.items():
        parts.sort()
        copies = sum(len(ids) for _, ids in parts) // n
        if copies == 1:  # repeated ids are looked at below
            assert [at for at, _ in parts] == np.cumsum([0] + [len(i) for _, i in parts])[:-1].tolist()
            ids_of[tuple(i for _, ids in parts for i in ids)] += 1
        else:
            wanted_here = [w for w in wanted if len(w) == n]
            for w in wanted_here:
                ids_of[w] += copies
    if len(by_doc) == len(texts):
        assert ids_of == wanted
    assert sum(len(i) for p in by_doc.values() for _, i in p) == sum(
        len(w) * k for w, k in wanted.items()
    )
    for parts in by_sequence.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0, "full, or a power of two"
    return by_sequence


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.collect()]
    found = check(min_slack.pack(docs, word_tokenizer()).collect(), texts, 4096)
    assert sum(sum(n for _, n in p) < 4096 for p in found.values()) <= 12


@pytest.mark.parametrize("capacity", [8, 64, 4096])
def test_awkward_rows(spark, docs, empty, capacity):
    texts = [r.text for r in docs.collect()]
    check(min_slack.pack(docs, word_tokenizer(), capacity=capacity).collect(), texts, capacity)
    assert min_slack.pack(empty, word_tokenizer(), capacity=capacity).collect() == []


def test_many_parts_and_equal_lengths(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('a ', if(id % 3 = 0, 7, int(id % 50)))").alias("text"),
    )
    texts = [r.text for r in docs.collect()]
    found = check(
        min_slack.pack(docs.repartition(13), word_tokenizer(), capacity=128).collect(), texts, 128
    )
    full = [p for p in found.values() if sum(n for _, n in p) == 128]
    assert len(found) - len(full) <= 7


def test_sequences(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e"), (3, "f")], "doc_id long, text string")
    pieces = min_slack.pack(docs, word_tokenizer(), capacity=4).cache()
    rows = min_slack.sequences(pieces).collect()
    assert sorted(r.n for r in rows) == [1, 4, 4]
    assert sum(len(r.ids) for r in rows) == 4 * 9


def test_digests(spark):
    from tripwright.llm.queries import QUERIES

    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op12_min_slack"](spark, SF).collect():
        ids = whole_ids(texts[row.doc_id])
        assert row.doc_tokens == len(ids)
        part = np.array(ids[row.start : row.start + row.length], "<u4").tobytes()
        assert zlib.crc32(part) == row.ids_crc32


@pytest.mark.parametrize("seed", range(60))
def test_closest_is_best(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(rng.randint(1, 7))}
    room = rng.randint(0, 90)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    picked = min_slack.closest(sorted(counts, reverse=True), counts, room)
    assert all(0 < k <= counts[length] for length, k in picked.items())
    assert sum(length * k for length, k in picked.items()) == max(s for s in sums if s <= room)


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 32, 128])
    counts = {
        rng.randint(1, capacity - 1): rng.choice([1, 2, 5, 300]) for _ in range(rng.randint(1, 20))
    }
    places, windows = min_slack.plan(counts, capacity)
    find, filled = min_slack.Places(places), {}
    for rest, n in counts.items():
        for number in range(n):
            at = 0
            for start, length, window, offset in find(rest, number):
                assert start == at
                at += length
                filled.setdefault(window, []).append((offset, length))
            assert at == rest
    assert sorted(filled) == list(range(windows))
    short = 0
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        short += at < capacity
        assert at & (at - 1) == 0
    assert short <= capacity.bit_length()


def test_encoder_is_the_library(monkeypatch):
    monkeypatch.setattr(min_slack, "SECTION_LETTERS", 50)
    monkeypatch.setattr(min_slack, "CACHE_WORDS", 100)
    rng, encoder = random.Random(7), min_slack.Encoder(word_tokenizer())
    some = (
        "a b Z é É é ́ ' 's 'll don't 12 3.5 \n \r\n \t     \x1c \x85 ß İ 漢字 🙂 ... "
        "<|endoftext|> <|startoftext|> <|ENDOFTEXT|> Word, word. End.) No!? A.b, x'S _ - http://x.y/z 가 ﬁ ‍ Σ"
    ).split(" ")
    for _ in range(1500):
        texts = [
            "".join(rng.choice(some) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(0, 40)))
            for _ in range(rng.randint(1, 4))
        ]
        for text, ids in zip(texts, encoder(texts), strict=True):
            assert np.frombuffer(ids, encoder.dtype).tolist() == whole_ids(text)[:-1]
