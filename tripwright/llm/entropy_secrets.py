"""Secrets in texts: three fixed patterns, and sliding-window Shannon entropy over candidates.

Everything is a Spark expression over the row; nothing is shuffled.

A candidate is a run of ``[A-Za-z0-9+/_=-]`` of ``LEAST`` characters or more, of the class hex or
mixed; hex in any case, folded. Over each class's own alphabet, a window of ``WINDOW`` characters slides along it; entering
and leaving characters change one count each, and with them the sum of c * log2(c) that the
window's entropy follows from. A candidate is a secret when some window reaches its class's
threshold, unless an allow-list pattern finds it, a base span overlaps it, or it lacks a digit or
a letter.

Spans are ``kind:start:end`` in code points, end exclusive. Null texts are empty and have no
secrets; rows that repeat are each scanned; time grows about in proportion to a text's matches; other columns are kept by ``scan``; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns: kind, expression, what must be long enough (0: all of it), least length.
BASE = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs are maximal, so the least length may stand in the expression.
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
KINDS = [kind for kind, *_ in BASE] + ["entropy"]
LEAST, WINDOW = 20, 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Alphabet and least entropy in bits of each class.
CLASSES = {
    "hex": ("0123456789abcdef", 3.0),
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
}
#: Candidates that look random but are no secrets.
ALLOW = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",  # UUIDs
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
    r"(?i)abcdefgh|0123456789|qwertz|qwerty",
    r"^[a-z]+([-_/][a-z0-9]+)+$",  # paths and slugs
    r"^sha(1|256|384|512)-",  # integrity hashes
)
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_MARKED = "array<struct<start:int,new:int,end:int,kind:int,meets:boolean>>"
#: Matches that one inner array holds while their places are added up.
CHUNK = 256


def _let(value: Column, use) -> Column:
    """``use`` of the value, which is computed once."""
    return F.transform(F.array(value), use)[0]


def _scan(items: Column, zero: Column, outs: str, step) -> Column:
    """``out`` of every item, from ``step(state, item)``, a struct of the next state and ``out``.

    Appending copies an array; items go by ``CHUNK``, so what is copied for each stays small.
    """

    def of_chunk(state: Column, chunk: Column) -> Column:
        def one(a: Column, item: Column) -> Column:
            return _let(
                step(a["state"], item),
                lambda r: F.struct(
                    r["state"].alias("state"),
                    F.concat(a["outs"], F.array(r["out"])).alias("outs"),
                ),
            )

        start = F.struct(state.alias("state"), F.array().cast(outs).alias("outs"))
        return F.aggregate(chunk, start, one)

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")),
        lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)),
    )

    def more(a: Column, chunk: Column) -> Column:
        return _let(
            of_chunk(a["state"], chunk),
            lambda r: F.struct(
                r["state"].alias("state"), F.concat(a["outs"], F.array(r["outs"])).alias("outs")
            ),
        )

    start = F.struct(zero.alias("state"), F.array().cast(f"array<{outs}>").alias("outs"))
    every = F.flatten(F.aggregate(chunks, start, more)["outs"])
    return F.when(F.size(items) > 0, every).otherwise(F.array().cast(outs))


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Spans of the leftmost non-overlapping matches that ``keep`` (of match and number) holds for."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Of the gaps between matches, the last has no match after it.
    lengths = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")),
    )

    def place(pieces: Column) -> Column:
        def one(at: Column, x: Column) -> Column:
            start, end = at + x["gap"], at + x["gap"] + x["hit"]
            out = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            return F.struct(end.alias("state"), out.alias("out"))

        return _scan(pieces, F.lit(0), _SPAN, one)

    kept = F.filter(
        F.arrays_zip(_let(lengths, place).alias("span"), keep(hits).alias("ok")), lambda x: x["ok"]
    )
    found = F.transform(kept, lambda x: x["span"]).cast(_SPAN)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _apart(added: Column, base: Column) -> Column:
    """The added spans that no base span overlaps, in two sweeps over both kinds by start."""

    def marked(spans: Column, new: int) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(
                x["start"].alias("start"),
                F.lit(new).alias("new"),
                x["end"].alias("end"),
                x["kind"].alias("kind"),
                F.lit(False).alias("meets"),
            ),
        )

    def sweep(items: Column, zero: int, reach, meets) -> Column:
        def one(state: Column, x: Column) -> Column:
            is_base = x["new"] == 0
            out = x.withField("meets", x["meets"] | (~is_base & meets(state, x)))
            return F.struct(
                F.when(is_base, reach(state, x)).otherwise(state).alias("state"), out.alias("out")
            )

        return _scan(items, F.lit(zero), _MARKED, one)

    def swept(items: Column) -> Column:
        from_left = sweep(
            items, 0, lambda s, x: F.greatest(s, x["end"]), lambda s, x: s > x["start"]
        )
        return _let(
            F.reverse(from_left),
            lambda back: sweep(
                back, 2**31 - 1, lambda s, x: F.least(s, x["start"]), lambda s, x: s < x["end"]
            ),
        )

    both = F.array_sort(F.concat(marked(base, 0), marked(added, 1))).cast(_MARKED)
    free = F.filter(_let(both, swept), lambda x: (x["new"] == 1) & ~x["meets"])
    spans = F.transform(
        F.reverse(free),
        lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")),
    ).cast(_SPAN)
    return F.when((F.size(added) > 0) & (F.size(base) > 0), spans).otherwise(added)


def _base(text: Column, number: int) -> Column:
    _, pattern, group, least = BASE[number]

    def long_enough(hits: Column) -> Column:
        of = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        return F.transform(of, lambda x: F.length(x) >= least)

    return _spans(text, pattern, number, long_enough)


def window_entropy(candidate: Column, alphabet: str) -> Column:
    """The greatest Shannon entropy, in bits, of any ``WINDOW`` neighbouring characters."""

    def weight(count: Column) -> Column:
        return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))

    def count_at(counts: Column, place: Column) -> Column:
        return F.get(counts, place)

    def changed(counts: Column, place: Column, by: int) -> Column:
        return F.transform(counts, lambda c, i: F.when(i == place, c + by).otherwise(c))

    def slide(codes: Column) -> Column:
        def enter(state: Column, i: Column) -> Column:
            code = F.get(codes, i)
            before = count_at(state["counts"], code)
            return F.struct(
                changed(state["counts"], code, 1).alias("counts"),
                (state["total"] + weight(before + 1) - weight(before)).alias("total"),
                state["best"].alias("best"),
            )

        def leave(state: Column, i: Column) -> Column:
            code = F.get(codes, i - WINDOW)
            before = count_at(state["counts"], code)
            return F.when(
                i >= WINDOW,
                F.struct(
                    changed(state["counts"], code, -1).alias("counts"),
                    (state["total"] + weight(before - 1) - weight(before)).alias("total"),
                    state["best"].alias("best"),
                ),
            ).otherwise(state)

        def note(state: Column, i: Column) -> Column:
            bits = F.lit(math.log2(WINDOW)) - state["total"] / WINDOW
            return F.struct(
                state["counts"].alias("counts"),
                state["total"].alias("total"),
                F.when(i >= WINDOW - 1, F.greatest(state["best"], bits))
                .otherwise(state["best"])
                .alias("best"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
            F.lit(0.0).alias("total"),
            F.lit(0.0).alias("best"),
        )
        steps = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(
            steps,
            start,
            lambda s, i: _let(
                enter(s, i), lambda s1: _let(leave(s1, i), lambda s2: note(s2, i))
            ),
        )["best"]

    codes = F.transform(
        F.split(candidate, "(?!$)", -1), lambda ch: F.instr(F.lit(alphabet), ch) - 1
    )
    return _let(codes, slide)


def _random(candidate: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | candidate.rlike(pattern)
    enough = F.lit(False)
    for name, (alphabet, least) in CLASSES.items():
        of_class = candidate.rlike("^[0-9a-fA-F]+$")
        of_class = of_class if name == "hex" else ~of_class
        folded = F.translate(candidate, "ABCDEF", "abcdef") if name == "hex" else candidate
        enough = F.when(of_class, window_entropy(folded, alphabet) >= least).otherwise(enough)
    varied = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    return F.when(varied & ~allowed, enough).otherwise(F.lit(False))


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scan(docs: DataFrame, assign: str, access: str, hexes: str, added: str) -> DataFrame:
    """``docs`` with four more columns, the spans of each kind; their names are the caller's."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(
        "*",
        *[_base(text, n).alias(name) for n, name in enumerate((assign, access, hexes))],
        _spans(text, CANDIDATE, len(BASE), lambda hits: F.transform(hits, _random)).alias(added),
    )

    return out.withColumn(added, _apart(F.col(added), F.concat(assign, access, hexes)))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row of ``docs``."""
    found = scan(docs.select("doc_id", "text"), "assign", "access", "hexes", "added")
    base = F.concat("assign", "access", "hexes")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hexes").cast("long").alias("n_hex"),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat(base, "added")).alias("spans"),
    )
