"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from compare import differences

from tripwright.llm import trie_frontier
from tripwright.llm.oracle import ORACLE
from tripwright.llm.queries import QUERIES

FOLD = str.maketrans(trie_frontier.UPPER, trie_frontier.LOWER)


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    """All results from (doc_id, text) rows, by comparing every pair of words."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            name = "" if doc_id is None else doc_id
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    n = {w: k for w, k in counts.items() if k >= 3}
    near = {w: [u for u in n if abs(len(u) - len(w)) < 2 and one_edit(w, u)] for w in n}
    form = {}
    for w in n:
        best = min(((-n[u], u) for u in near[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(docs):
    return {tuple(r) for r in trie_frontier.variants(docs).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, seed):
    rng = random.Random(seed)
    letters = ["abc", "abÀÿé", "xyzw"][seed]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(400)]
    rows = [
        (i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40])))) for i in range(200)
    ]
    rows += [(None, "ABCab abcab, abcab")] * 2
    assert found(frame(spark, rows)) == brute(rows)


def test_nested_and_very_long_words(spark):
    """Words that are prefixes of each other, and some of thousands of letters."""
    words = ["a" * k for k in range(5, 30)] + ["b" + "a" * k for k in range(5, 20)]
    long = "xyz" * 3000
    words += [long, long[:4000] + "q" + long[4001:], long[:8999], "q" + long, long[:70] + long[71:]]
    rows = [(i, " ".join(words)) for i in range(3)] + [(9, "aaaaaaa " * 50)]
    assert found(frame(spark, rows)) == brute(rows)


def test_awkward_rows(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == brute(rows)
    assert found(empty) == set()


def test_ties_go_to_the_first_word(spark):
    rows = [(1, "horse " * 3 + "house " * 8 + "hoese " * 8)]
    assert ("horse", "hoese", "hoese", 3, 2, 8) in found(frame(spark, rows))


def test_reference_sql(spark):
    query, sql = QUERIES["op11_trie_frontier"], ORACLE["op11_trie_frontier"]
    assert differences(spark, "/root/testdata/sf0.001", query, sql) == ""
