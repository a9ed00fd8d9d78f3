"""Licence scans: normalised text against licence templates by the Dice coefficient.

Units are the lines, the paragraphs (between blank lines), the whole of a text, and runs: two or
more neighbouring lines, the first and last with words, of at most (2 - t) / t times a template's
words for the threshold t. So a licence of any lines is found anywhere inside a text. Normalising
folds A-Z, turns every run of other characters than letters and digits into one space, which takes
marks of comments away too, and trims.
A unit's set is its distinct word bigrams; Dice = 2 * |common| / (|unit| + |template|). To reach the
threshold t, a unit's set must have between t / (2 - t) and (2 - t) / t times the template's size: the
templates whose bounds hold a unit's size are found by an equality join on the size, and only
they are compared. Units without a bigram match nothing.

Runs are looked at only where a text holds enough of a template: first as many of its words as any
run that matches must have, then as many of its bigrams. A run begins in a line where a bigram of the
template begins and ends in one where such a one ends, for the best run does.

Everything is Spark expressions; only the few matched units are shuffled. Templates are a
parameter, at most ``MAX_TEMPLATES``, so their table is small enough to be sent to every task.

``scan`` returns a row for each doc_id and template found: the best Dice of any unit, that unit's
kind and number (ties: lines, paragraphs, texts, runs, then the smaller number; a run's number is
that of its first line, and of runs the one that begins last counts) and how many lines, paragraphs
and whole texts match, with one more if a run is better than all of them. Null and
empty texts match nothing; rows that repeat a doc_id, or have none, count as one document; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TEMPLATES = 200
THRESHOLD = 0.8
KINDS = ("line", "paragraph", "text", "run")
RUN = 3

# Public licence notices and texts.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        'notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see https://www.gnu.org/licenses/."
    ),
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License."
    ),
    "cc-by-nc-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License."
    ),
    "bsd-notice": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE "
        "file."
    ),
    "all-rights-reserved": "All rights reserved.",
}


def normalised(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.size(words)
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(pairs)


def _let(value: Column, use) -> Column:
    """``use`` of the value, which is computed once."""
    return F.transform(F.array(value), use)[0]


def template_sets(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, template (its set) and n_template of each template with a bigram."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = spark.createDataFrame(list(templates.items()), "license string, body string")
    sets = rows.select("license", bigrams(F.split(normalised(F.col("body")), " ")).alias("template"))
    return sets.where(F.size("template") > 0).withColumn("n_template", F.size("template"))


def units(docs: DataFrame) -> DataFrame:
    """doc_id, kind, unit (number) and ``words`` of every unit.

    Words are cut inside the generator: a filter on them is then not computed from the text again.
    """
    text = F.col("text")
    whole = F.array(text)
    paragraphs = F.split(text, r"\n[ \t\r]*\n", -1)
    paragraphs = F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast("array<string>"))
    lines = F.split(text, "\n", -1)
    whole = F.when(F.size(lines) > 1, whole).otherwise(F.array().cast("array<string>"))

    def numbered_as(kind: int, parts: Column) -> Column:
        def one(body: Column, i: Column) -> Column:
            words = F.split(normalised(body), " ").alias("words")
            return F.struct(F.lit(kind).alias("kind"), i.alias("unit"), words)

        return F.transform(parts, one)

    numbered = [numbered_as(kind, x) for kind, x in enumerate((lines, paragraphs, whole))]
    return docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.inline(F.concat(*numbered))
    )


def fewest_words(pairs: list[str], needed: int) -> int:
    """So many different words at least hold any ``needed`` of the bigrams.

    Words that are in d bigrams, one by one, hold half the sum of their d at most.
    """
    uses = Counter(word for pair in pairs for word in pair.split(" "))
    held, n = 0, 0
    for _, d in uses.most_common():
        held, n = held + d, n + 1
        if held >= 2 * needed:
            break
    return n


def run_templates(sets: DataFrame, templates: dict[str, str], threshold: float) -> list[tuple]:
    """license, its words, how many a text needs, its bigrams, how many it needs, a run's most words."""
    out = []
    for r in sets.collect():
        needed = math.ceil(r.n_template * threshold / (2 - threshold) - 1e-9)
        words = sorted({word for pair in r.template for word in pair.split(" ")})
        # As normalising cuts them; repeated words count.
        n_words = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", templates[r.license].lower()))
        most = math.floor(n_words * (2 - threshold) / threshold + 1e-9)
        out.append((r.license, words, fewest_words(r.template, needed), r.template, needed, most))
    return out


def runs(docs: DataFrame, sets: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """doc_id, license, dice, kind and unit of the best run from each line where one may begin."""
    spark = docs.sparkSession
    rows = run_templates(sets, templates, threshold)
    if not rows:
        schema = "doc_id long, license string, dice double, kind int, unit int"
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame(
        [(name, template, needed, most) for name, _, _, template, needed, most in rows],
        "name string, template array<string>, needed int, most int",
    )

    def listed(words: list[str]) -> Column:
        return F.split(F.lit(" ".join(words)), " ")

    text = F.col("text")
    many = docs.where(F.contains(text, F.lit("\n"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("body")
    )
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("license"), listed(words).alias("words"), F.lit(n).alias("n"))
            for name, words, n, *_ in rows
        ]
    )

    def may_hold(known: Column) -> Column:
        held = F.filter(wanted, lambda t: F.size(F.array_intersect(t["words"], known)) >= t["n"])
        return F.transform(held, lambda t: F.struct(t["license"].alias("license")))

    vocabulary = listed(sorted({word for _, words, *_ in rows for word in words}))
    known = F.array_intersect(F.split(normalised(F.col("body")), " "), vocabulary)
    pairs = (
        many.select("doc_id", "body", F.inline(_let(known, may_hold)))
        .join(F.broadcast(parts), F.col("license") == F.col("name"))
        .drop("name")
    )

    def of_line(line: Column, i: Column) -> Column:
        own = F.filter(F.split(normalised(line), " "), lambda w: w != "")
        return F.transform(own, lambda w: F.struct(w.alias("word"), i.alias("line")))

    tokens = F.flatten(F.transform(F.split("body", "\n", -1), of_line))

    def from_lines(t: Column) -> Column:
        """The words from each line on in which a bigram of the template begins, if enough are held."""
        following = F.zip_with(
            F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))),
            F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))),
            lambda a, b: F.struct(
                a["line"].alias("line"), F.concat(a["word"], F.lit(" "), b["word"]).alias("pair")
            ),
        )
        firsts = F.filter(
            F.transform(t, lambda x, i: F.struct(x["line"].alias("line"), i.alias("at"))),
            lambda x: (x["at"] == 0) | (F.get(t, x["at"] - 1)["line"] != x["line"]),
        )

        def begins(lines: Column) -> Column:
            return F.filter(firsts, lambda x: F.array_contains(lines, x["line"]))

        def windows(hits: Column) -> Column:
            held = F.size(F.array_distinct(F.transform(hits, lambda x: x["pair"])))
            lines = F.array_distinct(F.transform(hits, lambda x: x["line"]))
            # One word more shows whether the last line ends there.
            following = F.transform(
                _let(lines, begins),
                lambda x: F.struct(
                    x["line"].alias("unit"),
                    F.slice(t, x["at"] + 1, F.col("most") + 1).alias("window"),
                ),
            )
            return F.when(held >= F.col("needed"), following)

        return _let(F.filter(following, lambda x: F.array_contains("template", x["pair"])), windows)

    starts = pairs.select(
        "doc_id", "license", "template", "most", F.inline(_let(tokens, from_lines))
    )

    def ends(window: Column) -> Column:
        places = F.sequence(F.lit(1), F.least(F.size(window), F.col("most")))
        return F.filter(
            places,
            lambda n: (F.get(window, n - 1)["line"] != F.get(window, F.lit(0))["line"])
            & ~F.get(window, n)["line"].eqNullSafe(F.get(window, n - 1)["line"]),
        )

    def dice_of(n: Column) -> Column:
        own = bigrams(F.transform(F.slice("window", 1, n), lambda x: x["word"]))
        return _let(
            own,
            lambda o: F.lit(2.0)
            * F.size(F.array_intersect(o, "template"))
            / (F.size(o) + F.size("template")),
        )

    best = F.array_max(F.transform(ends(F.col("window")), dice_of))
    return (
        starts.select("doc_id", "license", best.alias("dice"), F.lit(RUN).alias("kind"), "unit")
        .where(F.col("dice") >= threshold)
    )


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, license, dice, kind, unit and n_units of each template found in each document."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    sets = template_sets(spark, templates)
    bounds = [
        (r.license, size)
        for r in sets.select("license", "n_template").collect()
        for size in range(
            math.ceil(r.n_template * threshold / (2 - threshold) - 1e-9),
            math.floor(r.n_template * (2 - threshold) / threshold + 1e-9) + 1,
        )
    ]
    least = min((size for _, size in bounds), default=1)
    allowed = spark.createDataFrame(bounds, "license string, n_unit int")
    split = (
        units(docs)
        .where(F.size("words") > least)
        .select("doc_id", "kind", "unit", bigrams(F.col("words")).alias("own"))
        # Never null, so that the join doesn't filter by it, computing the sets twice.
        .withColumn("n_unit", F.coalesce(F.size("own"), F.lit(0)))
    )
    common = F.size(F.array_intersect("own", "template"))
    dice = (F.lit(2.0) * common) / (F.col("n_unit") + F.col("n_template"))
    found = (
        split.join(F.broadcast(allowed), "n_unit")
        .join(F.broadcast(sets), "license")
        .select("doc_id", "license", dice.alias("dice"), "kind", "unit")
        .where(F.col("dice") >= threshold)
        .unionByName(runs(docs, sets, templates, threshold))
    )
    # Of equal runs the one that begins last has no line to spare before it.
    place = F.when(F.col("kind") == RUN, F.col("unit")).otherwise(-F.col("unit"))
    best = F.max_by(F.struct("dice", "kind", "unit"), F.struct("dice", -F.col("kind"), place))
    kinds = F.array(*map(F.lit, KINDS))
    return (
        found.groupBy("doc_id", "license")
        .agg(best.alias("best"), F.count_if(F.col("kind") != RUN).alias("others"))
        .select(
            "doc_id",
            "license",
            F.col("best.dice").alias("dice"),
            F.get(kinds, F.col("best.kind")).alias("kind"),
            F.col("best.unit").alias("unit"),
            (F.col("others") + (F.col("best.kind") == RUN).cast("long")).alias("n_units"),
        )
    )
