"""The prefix trie against one built turn by turn."""

import hashlib
import random
import zlib

import pytest
from compare import differences

from tripwright.llm import prefix_bitmaps
from tripwright.llm.oracle import ORACLE
from tripwright.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, node string, jumps string"


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    nodes = {}
    for c in sorted(said):
        h = zlib.crc32(str(c).encode()) % 6
        whole = said.get(c - c % 100, [])[:h] + said[c][h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"in": [], "ends": []})
            node["in"].append(c)
            node["ends"] += [c] * (d == len(whole))
    out = set()
    for path, node in nodes.items():
        below = [(p, x) for p, x in nodes.items() if p[: len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes) for p, _ in below)
        out.add(
            (
                node["in"][0],
                len(path),
                nodes[path[:-1]]["in"][0] if path else None,
                len(node["in"]),
                sum(len(p) == len(path) + 1 for p, _ in below),
                leaves,
                sum((len(x["in"]) - 1) * len(p[-1][1]) for p, x in below if p),
                hashlib.sha256(",".join(map(str, node["ends"])).encode()).hexdigest(),
            )
        )
    return out


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = [tuple(r) for r in prefix_bitmaps.trie(frame).collect()]
    assert len(out) == len(set(out))
    return set(out)


def some_rows(seed, convs, turns):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), convs):
        for t in range(rng.randint(1, turns)):
            text = rng.choice(["a", "bb", "é🙂", None, ""])
            rows.append((c, t or None, rng.choice(["user", None]), text, "n", None))
    return rows


@pytest.mark.parametrize("seed,shard", [(1, 4096), (2, 7), (3, 1)])
def test_random_conversations(spark, monkeypatch, seed, shard):
    monkeypatch.setattr(prefix_bitmaps, "SHARD", shard)
    rows = some_rows(seed, 90, 6)
    parts, several = prefix_bitmaps.node_parts, lambda frame: parts(frame, range_turns=60)
    monkeypatch.setattr(prefix_bitmaps, "node_parts", several)
    assert found(spark, rows) == brute(rows)


def test_nulls_repeats_and_ties(spark):
    rows = [
        (None, 1, "user", "lost", "n", None),
        (7, None, None, None, "n", None),
        (7, None, "user", "x", "n", None),
        (7, 3, "user", "same", "n", None),
        (7, 3, "user", "same", "n", None),
        (100, 0, "user", "first", "n", None),
        (101, 0, "user", "gone", "n", None),
        (2**62, 5, "a", "far", "n", None),
    ]
    assert found(spark, rows) == brute(rows)


def test_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}", "n", None) for c in (100, 101, 102) for t in range(70 - c % 100)]
    assert found(spark, rows) == brute(rows)


def test_a_common_first_turn(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 9}", "n", None) for c in range(300) for t in (0, 1)]
    assert found(spark, rows) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, 1, "user", "x", "n", None)]) == set()


def test_reference_sql(spark):
    query, sql = QUERIES["op13_prefix_bitmaps"], ORACLE["op13_prefix_bitmaps"]
    assert differences(spark, "/root/testdata/sf0.01", query, sql) == ""
