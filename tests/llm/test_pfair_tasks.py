"""The schedule that tasks lay out: against the heap, and by what every schedule must keep."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripwright.llm import pfair_mix


def test_a_frame_is_what_the_heap_lays_out(spark):
    parts = [[5, 3, 2], [1], [7, 7, 1, 0, 1], [40, 1, 1, 1, 20, 1], [90, 37, 3, 1, 70]]
    rows = [(k, 0, 0, p, p, sum(p)) for k, p in enumerate(parts)]
    schema = "phase long, frame long, start long, base array<long>, q array<long>, whole long"
    got = defaultdict(dict)
    for r in pfair_mix._picked(spark.createDataFrame(rows, schema)).collect():
        got[r.phase][r.code, r.i] = r.pos
    for k, p in enumerate(parts):
        used = [s for s, n in enumerate(p) if n]
        laid = pfair_mix.period([p[s] for s in used])
        assert got[k] == {(s, i): slot for s, x in zip(used, laid, strict=True) for i, slot in enumerate(x)}


@pytest.mark.parametrize(
    ("blocks", "weights", "most"),
    [
        ([900, 500, 40, 1], [0.6, 0.3, 0.09, 0.01], 50),
        ([700, 700, 0, 700], [1, 1, 5, 1], 0),
        ([1000] + [30] * 20, [1.0] + [0.02] * 20, 100),
        ([64], [2.0], 0),
    ],
)
def test_every_block_has_one_slot_near_its_target(spark, blocks, weights, most):
    early, done = pfair_mix.spans(blocks, weights, most)
    assert sum(blocks) - sum(done) <= most
    late = pfair_mix.plan(blocks, weights, 1000, done, len(early))
    laid = pfair_mix.laid_by_tasks(spark, early, frame_slots=16)
    rows = laid.union(spark.createDataFrame(pfair_mix.laid_out(late), laid.schema)).collect()
    assert sorted(r.slot for r in rows) == list(range(sum(blocks)))
    assert sorted((r.code, r.nth) for r in rows) == [(s, i) for s, n in enumerate(blocks) for i in range(n)]
    assert all(r.release <= r.slot < r.deadline for r in rows)
    for code in {r.code for r in rows}:
        own = sorted((r for r in rows if r.code == code), key=lambda r: r.nth)
        assert [r.slot for r in own] == sorted(r.slot for r in own)
    for span in early:
        alive = [w if n > d else 0 for w, n, d in zip(weights, blocks, span.first_blocks, strict=True)]
        for r in rows:
            if r.phase == span.phase:
                due = (r.slot - span.first_slot) * alive[r.code] / sum(alive)
                # Less than one for the frame, for each level beyond it and for the whole quota.
                assert abs(r.nth - span.first_blocks[r.code] - due) < 4


def test_mixing_by_tasks_keeps_rows_and_weights(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'a', 'b') AS source", "repeat('x', 10) AS text"
    )
    mixed, _ = pfair_mix.mix(docs, weights={"a": 1, "b": 1}, block_chars=10, driver_blocks=100, frame_slots=64)
    got = mixed.collect()
    assert sorted(r.slot for r in got) == list(range(3000))
    assert sorted(r.doc_id for r in got) == list(range(3000))
    assert abs(sum(r.source == "a" and r.slot < 1000 for r in got) - 500) <= 2
    ordered = pfair_mix.in_order(docs, block_chars=10, driver_blocks=100, frame_slots=64)
    assert ordered.count() == 3000


def test_rows_without_an_id_are_spread_by_their_texts(spark):
    docs = spark.range(5000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.lit("a").alias("source"),
        F.format_string("text %06d", F.col("id")).alias("text"),
    )
    mixed, _ = pfair_mix.mix(docs, block_chars=11)
    assert mixed.select("slot").distinct().count() == 5000


def sized(spark, n):
    return spark.range(n).selectExpr(
        "id AS doc_id", "concat('s', floor(sqrt(id % 100))) AS source", "10L + id % 7 AS size"
    )


def test_the_schedule_is_laid_out_one_way_whatever_the_size(spark):
    """A table far below a frame and one of many frames: what tasks lay out, from the first block on."""
    for n, frame_slots in ((60, 4096), (2000, 4096), (2000, 64)):
        docs = sized(spark, n)
        weights = {f"s{k}": 1.0 / (k + 2) for k in range(10)}
        mixed, _ = pfair_mix.mix(docs, weights=weights, block_chars=20, size="size", frame_slots=frame_slots)
        got = {(r.source, r.block): (r.phase, r.release, r.deadline, r.slot) for r in mixed.collect()}
        chars = {r.source: r.chars for r in docs.groupBy("source").agg(F.sum("size").alias("chars")).collect()}
        top = sorted(chars, key=lambda k: (-chars[k], k))
        blocks = [-(-chars[k] // 20) for k in top] + [0]
        early, done = pfair_mix.spans(blocks, [weights[k] for k in top] + [1e-9], 0)
        assert done == blocks
        laid = pfair_mix.laid_by_tasks(spark, early, frame_slots).collect()
        want = {(top[r.code], r.nth): (r.phase, r.release, r.deadline, r.slot) for r in laid}
        assert got.items() <= want.items() and len(got) > 0.9 * len(want)


def test_the_order_does_not_depend_on_the_number_of_chunks(spark, monkeypatch):
    laid = []
    for chunk_rows in (1000, 100, 7):
        monkeypatch.setattr(pfair_mix, "CHUNK_ROWS", chunk_rows)
        mixed, names = pfair_mix.mix(sized(spark, 900), block_chars=50, size="size")
        laid.append(sorted(map(tuple, mixed.select("doc_id", *names.values()).collect())))
    assert laid[0] == laid[1] == laid[2] and len(laid[0]) == 900
