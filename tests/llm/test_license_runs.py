"""Licences of several lines inside longer texts, against every run of lines."""

import random
import re
import textwrap

import pytest

from tripwright.llm import dice_licenses
from tripwright.llm.dice_licenses import TEMPLATES, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def pairs(found):
    return set(zip(found, found[1:], strict=False))


def dice(own, template):
    return 2.0 * len(own & template) / (len(own) + len(template))


def brute(text: str) -> dict[str, tuple]:
    """license to dice, kind, unit and n_units, from all lines, paragraphs, the text and all runs."""
    lines, out = text.split("\n"), {}
    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    units = [(0, i, x) for i, x in enumerate(lines)]
    units += [(1, i, x) for i, x in enumerate(paragraphs) if len(paragraphs) > 1]
    units += [(2, 0, text)] * (len(lines) > 1)
    for name, body in TEMPLATES.items():
        template, most = pairs(words(body)), len(words(body)) * 1.2 / 0.8 + 1e-9
        found = []
        for kind, i, x in units:
            if pairs(words(x)) and (d := dice(pairs(words(x)), template)) >= 0.8:
                found.append((d, -kind, -i))
        n = len(found)
        of_line = [words(x) for x in lines]
        for i in range(len(lines)):
            run = list(of_line[i])
            for j in range(i + 1, len(lines)):
                run += of_line[j]
                if len(run) > most:
                    break
                if of_line[i] and of_line[j] and (d := dice(pairs(run), template)) >= 0.8:
                    found.append((d, -3, i))
        if found:
            d, kind, unit = max(found)
            out[name] = (d, dice_licenses.KINDS[-kind], abs(unit), n + (kind == -3))
    return out


def paragraphed(name: str, width: int, mark: str) -> str:
    body = TEMPLATES[name]
    for cut in ("The above", "THE SOFTWARE IS", "You may obtain", "Unless required", "This program is dist", "You should"):
        body = body.replace(cut, "\n\n" + cut)
    parts = ["\n".join(mark + x for x in textwrap.wrap(p, width)) for p in body.split("\n\n")]
    return ("\n" + mark.rstrip() + "\n").join(parts)


def filler(draw: random.Random, n: int) -> str:
    common = words(TEMPLATES["mit"])[:40] + [f"w{i}" for i in range(400)]
    return "\n".join(" ".join(draw.choices(common, k=draw.randint(0, 12))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    draw, out = random.Random(4), []
    for name in ("mit", "isc", "apache-2.0-header", "gpl-3.0-header", "bsd-notice", "cc-by-sa-4.0"):
        for width, mark in ((60, ""), (72, "# "), (40, " * "), (70, "// ")):
            out.append(filler(draw, 30) + "\n" + paragraphed(name, width, mark) + "\n" + filler(draw, 40))
    out.append(filler(draw, 3) + "\n" + paragraphed("mit", 50, "") + "\n\n" + paragraphed("isc", 50, ""))
    out.append("All rights\nreserved.\n\nAll rights reserved.\nx\nAll\nrights\nreserved")
    out += [filler(draw, 60) for _ in range(5)] + ["", "\n\n\n", "\nAll rights reserved.\n", "all\nrights"]
    # A third of the words replaced, and a licence cut in half.
    out += [re.sub("software|copies|without", "thing", paragraphed("mit", 60, ""), flags=re.I)]
    out += [paragraphed("mit", 60, "")[:400] + "\n" + filler(draw, 5)]
    return out


def test_licences_inside_texts_are_found(texts):
    for text, name in zip(texts[:24:4], ("mit", "isc", "apache-2.0-header", "gpl-3.0-header"), strict=False):
        assert brute(text)[name][0] > 0.9


def test_runs_are_brute_force(spark, texts):
    rows = [*enumerate(texts), (10_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for r in scan(frame).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.dice, r.kind, r.unit, r.n_units)
    assert got == {i: found for i, text in enumerate(texts) if (found := brute(text))}


def test_a_long_text_of_a_template_s_words(spark):
    draw = random.Random(2)
    text = filler(draw, 3000) + "\n" + paragraphed("gpl-3.0-header", 60, "# ") + "\n" + filler(draw, 3000)
    got = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.license, r.kind, r.unit) for r in got if r.dice > 0.9] == [("gpl-3.0-header", "run", 3000)]


def test_reference_sql_finds_the_same_runs(spark, texts, tmp_path):
    import duckdb

    from tripwright.llm.oracle import ORACLE

    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents"))
    own = scan(frame)
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
        want = db.sql(ORACLE["op9_dice_licenses"])
        assert want.columns == own.columns
        assert sorted(want.fetchall()) == sorted(map(tuple, own.collect()))


def test_no_templates(spark):
    assert scan(spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string"), {}).count() == 0
