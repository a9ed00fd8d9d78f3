"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are packed, in a hashed order, into blocks of ``block_chars`` characters.
Block ``i`` (from 0) of a source of weight ``w`` has release time floor(i / w) and deadline
ceil((i + 1) / w); of the released blocks the one with the earliest deadline takes the next slot.
While all sources last is a phase; when one runs out, the next begins with the weights of those left
scaled up. No document is dropped or repeated.

Tasks lay out every phase, whatever the size of the input, in frames of about ``frame_slots`` slots.
The driver holds a row of totals for each phase. A phase gives each source a whole number of blocks,
its target to less than one; the equal whole parts of these go to every frame, and the remainders
are themselves a smaller schedule, spread evenly over the frames. Each frame is scheduled by its own
releases and deadlines, so a source is less than one block from its quota's pace within a frame, and
less than one more for each level of remainders: one level up to ``frame_slots`` blocks, two up to
``frame_slots`` squared by the number of sources, then three. The order of a source's documents is
that of their hashes, however many chunks these are summed in.

Only a caller who asks for it by ``driver_blocks`` has the last so many blocks laid out by the driver,
with whole shares of ``resolution`` or, if that is more, of a hundred times the blocks: there no source
is ever more than one and a hundredth of a block from its target within a phase.

Every source that ``weights`` names has its own schedule. Without weights the largest ``max_sources``
have one; all other sources form one further source.

A null source is a source; a null or empty text counts one character; null and repeated doc_ids are
rows like any other; sources without documents take no slots and documents of sources without
weights belong to the further source, which has the least weight if none is given; an empty
table gives no rows. All columns are kept, whatever their names.
"""

from __future__ import annotations

import heapq
from array import array
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.llm.common import big_enough, fresh, stored

#: Documents that one running sum covers, about.
CHUNK_ROWS = 1000


def shares(weights: list[float], resolution: int) -> list[int]:
    """Whole numbers of that sum, at least one each, nearest to the weights."""
    resolution = max(resolution, len(weights))
    exact = [Fraction(w) for w in weights]
    total = sum(exact)
    exact = [w / total * resolution for w in exact]
    out = [max(1, int(x)) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda s: (out[s] - exact[s], s))
    for s in by_rest[: max(0, resolution - sum(out))]:
        out[s] += 1
    # What the least shares were raised by, the others give, the most exceeding first.
    over = [(exact[s] - out[s], s) for s in range(len(out)) if out[s] > 1]
    heapq.heapify(over)
    for _ in range(sum(out) - resolution):
        _, s = heapq.heappop(over)
        out[s] -= 1
        if out[s] > 1:
            heapq.heappush(over, (exact[s] - out[s], s))
    return out


def period(parts: list[int], left: list[int] | None = None) -> list[list[int]]:
    """For each source the slots of its blocks in one period, earliest deadline first.

    With ``left``, the blocks that each has, only up to the slot in which the first one runs out.
    """
    whole = sum(parts)
    slots: list[list[int]] = [[] for _ in parts]
    waiting = [(0, s) for s in range(len(parts))]
    ready: list[tuple[int, int]] = []
    for slot in range(whole):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            deadline = -(-(len(slots[s]) + 1) * whole // parts[s])
            heapq.heappush(ready, (deadline, s))
        _, s = heapq.heappop(ready)
        slots[s].append(slot)
        if left is not None and len(slots[s]) == left[s]:
            break
        if len(slots[s]) < parts[s]:
            heapq.heappush(waiting, (len(slots[s]) * whole // parts[s], s))
    return slots


@dataclass
class Phase:
    """What one source does while the same sources last: the slot of each of its blocks."""

    source: int
    phase: int
    first_block: int
    first_slot: int
    part: int
    whole: int
    slots: list[int]


@dataclass
class Span:
    """A phase that tasks lay out: the blocks that each source has in it."""

    phase: int
    first_slot: int
    first_blocks: list[int]
    quotas: list[int]


def quotas(weights: list[float], left: list[int]) -> list[int]:
    """How many blocks each source has until the first one runs out, at most those left."""
    exact = [Fraction(w) for w in weights]
    length = min(n / w for n, w in zip(left, exact, strict=True) if n)
    due = [w * length if n else Fraction(0) for n, w in zip(left, exact, strict=True)]
    out = [int(x) for x in due]
    rest = round(sum(due) - sum(out))
    for s in sorted(range(len(out)), key=lambda s: (out[s] - due[s], s))[:rest]:
        out[s] += out[s] < left[s]
    return out


def spans(blocks: list[int], weights: list[float], most: int) -> tuple[list[Span], list[int]]:
    """The phases until at most ``most`` blocks are left, and the blocks of each source in them."""
    out, done, at = [], [0] * len(blocks), 0
    while sum(blocks) - sum(done) > most:
        own = quotas(weights, [n - d for n, d in zip(blocks, done, strict=True)])
        out.append(Span(len(out), at, list(done), own))
        done = [d + n for d, n in zip(done, own, strict=True)]
        at += sum(own)
    return out, done


def plan(
    blocks: list[int],
    weights: list[float],
    resolution: int,
    done: list[int] | None = None,
    number: int = 0,
) -> list[Phase]:
    """The phases of every source, from how many blocks it has and how many are done."""
    out, done = [], list(done or [0] * len(blocks))
    at = sum(done)
    alive = [s for s, n in enumerate(blocks) if n > done[s]]
    while alive:
        # So fine that in all slots of the phase together no share is off by a hundredth of a block.
        left = [blocks[s] - done[s] for s in alive]
        parts = shares([weights[s] for s in alive], max(resolution, 100 * sum(left)))
        laid = period(parts, left)
        for s, part, slots in zip(alive, parts, laid, strict=True):
            if slots:
                out.append(Phase(s, number, done[s], at, part, sum(parts), slots))
            done[s] += len(slots)
        at += sum(map(len, laid))
        alive = [s for s in alive if done[s] < blocks[s]]
        number += 1
    return out


def laid_out(phases: list[Phase]) -> pa.Table:
    """code, nth (block), phase, release, deadline and slot of every block."""
    columns: dict[str, array] = {c: array("q") for c in ("code", "nth", "phase", "release", "deadline", "slot")}
    for p in phases:
        n = len(p.slots)
        columns["code"].extend([p.source] * n)
        columns["nth"].extend(range(p.first_block, p.first_block + n))
        columns["phase"].extend([p.phase] * n)
        columns["release"].extend(p.first_slot + i * p.whole // p.part for i in range(n))
        columns["deadline"].extend(p.first_slot - (-(i + 1) * p.whole // p.part) for i in range(n))
        columns["slot"].extend(p.first_slot + x for x in p.slots)
    return pa.table({c: pa.array(np.frombuffer(x, np.int64) if x else [], pa.int64()) for c, x in columns.items()})


#: The sources of each slot of a frame, from their blocks ``q`` in its ``whole`` slots: of the
#: released blocks the one with the earliest deadline, then the first source. Slots are gathered
#: 64 at a time, for an array is copied with each one that it gains.
_NOTHING = "cast(array() AS array<struct<code: int, i: bigint>>)"
_STEP = """
element_at(transform(
  array(array_min(filter(a.next, x -> x.release <= t))),
  b -> named_struct(
    'next', transform(a.next, x -> if(x.code = b.code, named_struct(
      'deadline', ((x.i + 2) * whole + x.n - 1) div x.n,
      'code', x.code, 'i', x.i + 1, 'release', (x.i + 1) * whole div x.n, 'n', x.n), x)),
    'out', concat(a.out, array(named_struct('code', b.code, 'i', b.i))))), 1)
"""
_FRAME = f"""
aggregate(
  sequence(0L, (whole - 1) div 64),
  named_struct(
    'next', filter(
      transform(q, (n, s) -> named_struct(
        'deadline', (whole + n - 1) div greatest(n, 1L), 'code', s, 'i', 0L, 'release', 0L, 'n', n)),
      x -> x.n > 0),
    'out', array({_NOTHING})),
  (o, c) -> element_at(transform(
    array(aggregate(
      sequence(c * 64, least(c * 64 + 63, whole - 1)),
      named_struct('next', o.next, 'out', {_NOTHING}),
      (a, t) -> {_STEP})),
    r -> named_struct('next', r.next, 'out', concat(o.out, array(r.out)))), 1),
  o -> flatten(o.out))
"""


def _level(frames: DataFrame, extras: DataFrame | None) -> DataFrame:
    """phase, frame, start, base, q and whole of each frame.

    ``frames`` has phase, n (frames of the phase), base (blocks of each source in every frame) and
    more (the blocks beyond these); ``extras`` says in phase and slot whose these are.
    """
    each = frames.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("frame"))
    each = each.withColumn(
        "start", F.expr("frame * aggregate(base, 0L, (a, x) -> a + x) + frame * more div n")
    )
    if extras is not None:
        # Block x of those beyond lies in the frame f with f * more div n <= x < (f + 1) * more div n.
        owner = extras.join(F.broadcast(frames.select("phase", "n", "more")), "phase").selectExpr(
            "phase", "((slot + 1) * n + more - 1) div more - 1 AS frame", "code"
        )
        counted = (
            owner.groupBy("phase", "frame", "code")
            .agg(F.count(F.lit(1)).alias("times"))
            .groupBy("phase", "frame")
            .agg(F.map_from_entries(F.collect_list(F.struct("code", "times"))).alias("times"))
        )
        each = each.join(counted, ["phase", "frame"], "left").withColumn(
            "q", F.expr("transform(base, (x, s) -> x + coalesce(times[s], 0L))")
        )
    else:
        each = each.withColumn("q", F.col("base"))
    return each.select(
        "phase", "frame", "start", "base", "q", F.expr("aggregate(q, 0L, (a, x) -> a + x)").alias("whole")
    )


def _picked(frames: DataFrame) -> DataFrame:
    """The frames' columns with pos, code and i (the source's block within the frame) of each slot."""
    spread = frames.where("whole > 0").repartition("phase", "frame")
    return spread.select("*", F.posexplode(F.expr(_FRAME)).alias("pos", "pick")).select(
        "phase", "frame", "start", "q", "whole", "pos", "pick.code", "pick.i"
    )


def laid_by_tasks(spark: SparkSession, phases: list[Span], frame_slots: int) -> DataFrame:
    """The columns of ``laid_out`` for the phases: the driver sends a row for each level of each."""
    width = max(len(p.quotas) for p in phases)
    frame_slots = max(frame_slots, 4 * width)
    levels: list[list[tuple]] = []
    now = [(p.phase, p.quotas) for p in phases]
    while now:
        rows, rest = [], []
        for phase, own in now:
            n = big_enough(sum(own), frame_slots)
            more = [x % n for x in own]
            rows.append((phase, n, [x // n for x in own], sum(more)))
            if sum(more):
                rest.append((phase, more))
        levels.append(rows)
        now = rest
    schema = "phase long, n long, base array<long>, more long"
    frames = extras = None
    for rows in reversed(levels):
        if frames is not None:
            extras = _picked(frames).selectExpr("phase", "start + pos AS slot", "code")
        frames = stored(_level(spark.createDataFrame(rows, schema), extras), "pfair-frames")
    # A source's blocks before a frame: a sum over one row a frame.
    before = Window.partitionBy("phase", "code").orderBy("frame")
    ahead = frames.select("phase", "frame", F.posexplode("q").alias("code", "own")).select(
        "phase",
        "frame",
        "code",
        F.coalesce(F.sum("own").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "ahead"
        ),
    )
    firsts = spark.createDataFrame(
        [(p.phase, p.first_slot, p.first_blocks) for p in phases],
        "phase long, first_slot long, first_blocks array<long>",
    )
    return (
        _picked(frames)
        .join(ahead, ["phase", "frame", "code"])
        .join(F.broadcast(firsts), "phase")
        .withColumn("at", F.col("first_slot") + F.col("start"))
        .selectExpr(
            "CAST(code AS long) AS code",
            "first_blocks[code] + ahead + i AS nth",
            "phase",
            "at + i * whole div q[code] AS release",
            "at + ((i + 1) * whole + q[code] - 1) div q[code] AS deadline",
            "at + pos AS slot",
        )
    )


def _chars(text: Column) -> Column:
    return F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)).cast("long")


def mix(
    docs: DataFrame,
    key: str = "source",
    weights: dict[str | None, float] | None = None,
    alpha: float = 0.5,
    block_chars: int = 100_000,
    resolution: int = 1000,
    max_sources: int = 256,
    size: str | None = None,
    driver_blocks: int = 0,
    frame_slots: int = 4096,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the schedule's columns, and the names these have.

    ``weights`` are the targets by value of ``key``; without any, a source's target is its number
    of characters to the power ``alpha``. ``size`` names a column to take for the length of text.
    The names are of: part, block, phase, release, deadline, slot, place (within the slot).
    """
    spark = docs.sparkSession
    labels = ("part", "block", "phase", "release", "deadline", "slot", "place")
    inner = ("code", "chunk", "chars", "ahead", "hash", "nth", "of_code", "of_part", "at", "at_code")
    names = dict(zip(labels + inner, fresh(docs.columns, *labels, *inner), strict=True))
    n = {k: F.col(v) for k, v in names.items()}

    chars = F.col(f"`{size}`") if size else _chars(F.col("text"))
    rows = docs.count()
    # Rows without an id are told apart by their texts.
    spread = F.xxhash64("doc_id", chars)
    if "text" in docs.columns:
        spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text", chars)).otherwise(spread)
    keyed = docs.withColumns(
        {
            names["part"]: F.col(f"`{key}`").cast("string"),
            names["chars"]: chars,
            names["hash"]: spread,
        }
    )
    # Chunks are ranges of the hash, so their number does not change the order.
    range_of = (F.shiftright(n["hash"], 33) + F.lit(1 << 30)) * F.lit(big_enough(rows, CHUNK_ROWS))
    keyed = keyed.withColumn(names["chunk"], F.shiftright(range_of.cast("long"), 31))

    # Sources by size, the named ones or max_sources rows at most, and all the others as one.
    by_source = keyed.groupBy(n["part"].alias("part")).agg(
        F.sum(n["chars"]).alias("chars"), F.count(F.lit(1)).alias("n")
    )
    known = by_source
    if weights is not None:
        named = spark.createDataFrame([(k,) for k in weights], "name string")
        known = by_source.join(F.broadcast(named), F.col("part").eqNullSafe(F.col("name")), "semi")
    most = max_sources if weights is None else max(len(weights), 1)
    top = known.orderBy(F.desc("chars"), "part").limit(most).collect()
    every = by_source.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    rest = every - sum(r.chars for r in top)
    totals = [r.chars for r in top] + [rest]
    if weights is None:
        targets = [r.chars**alpha for r in top] + [max(rest, 1) ** alpha]
    else:
        targets = [weights[r.part] for r in top] + [1e-9]
    blocks = [-(-x // block_chars) for x in totals]
    early, done = spans(blocks, targets, driver_blocks)
    late = plan(blocks, targets, resolution, done, len(early))

    codes = spark.createDataFrame(
        [(r.part, s) for s, r in enumerate(top)],
        f"{names['of_part']} string, {names['code']} int",
    )
    slots = spark.createDataFrame(laid_out(late))
    if early:
        slots = slots.union(stored(laid_by_tasks(spark, early, frame_slots), "pfair-slots"))
    slots = slots.toDF(
        *[names[x] for x in ("at_code", "nth", "phase", "release", "deadline", "slot")]
    )
    coded = (
        keyed.join(F.broadcast(codes), n["part"].eqNullSafe(n["of_part"]), "left")
        .drop(names["of_part"])
        .withColumn(names["code"], F.coalesce(n["code"], F.lit(len(top))))
    )

    # Characters ahead of each document: of earlier chunks, then of its own. A source of any
    # size is a window of one row a chunk and many windows of one chunk.
    cells = coded.groupBy(
        n["code"].alias(names["of_code"]), n["chunk"].alias(names["at"])
    ).agg(F.sum(n["chars"]).alias("cell"))
    earlier = (
        Window.partitionBy(n["of_code"])
        .orderBy(n["at"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = cells.select(
        n["of_code"],
        n["at"],
        F.coalesce(F.sum("cell").over(earlier), F.lit(0)).alias(names["ahead"]),
    )
    inside = (
        Window.partitionBy(n["code"], n["chunk"])
        .orderBy(n["hash"], F.col("doc_id"), n["chars"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        coded.join(cells, (n["code"] == n["of_code"]) & (n["chunk"] == n["at"]))
        .drop(names["of_code"], names["at"])
        .withColumn(
            names["ahead"], n["ahead"] + F.coalesce(F.sum(n["chars"]).over(inside), F.lit(0))
        )
        .withColumn(names["block"], F.expr(f"`{names['ahead']}` div {block_chars}L"))
        .join(slots, (n["code"] == n["at_code"]) & (n["block"] == n["nth"]))
        .withColumns(
            {
                names["phase"]: n["phase"].cast("int"),
                names["place"]: n["ahead"] - n["block"] * block_chars,
            }
        )
        .drop(*[names[x] for x in inner])
    ), {x: names[x] for x in labels}


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their own columns, laid out in the order of the schedule."""
    mixed, names = mix(docs, **options)
    keys = [names["slot"], names["place"]]
    # Rows of one slot and place (repeats of an empty document) are told apart by their doc_id.
    return (
        mixed.repartitionByRange(*keys, "doc_id")
        .sortWithinPartitions(*keys, "doc_id")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
