"""A quality classifier with hierarchical empirical Bayes over sites and paths.

1. Document evidence. A bounded sample of the labelled documents (``sample_rows``, by hash of the
   id) trains it: first a lexicon, the words whose share of bad documents is far above the others'
   (on one half of the sample), then a logistic regression over a few shape features and lexicon
   features (on the other half). The final lexicon uses both halves. A label is bad when quality is
   0 or toxic is 1; without labels there is no evidence.
2. Grouped aggregation over *all* documents: the expected number of bad ones per path and site.
3. Empirical Bayes: how far sites differ from the corpus, and paths from their site, beyond chance
   (method of moments) gives the strength of each prior; a path's rate is shrunk to its site's, and
   a site's to the corpus', so sparse ones follow their parent.
4. Posterior: a document's evidence with its path's rate as the prior. It is rejected when
   the posterior of being bad is above ``cut``.

The site is ``source`` and the path ``lang`` by default, or the host and first path segment of a URL
column (``site_of_url``, ``path_of_url``).

Null and empty texts count as texts without words; null sites and paths are sites and paths; rows
that repeat a doc_id are judged by their own text; labels of unknown documents, with null ids, or
with neither label are unused, and of several labels for one document the worst counts; an empty
table gives no rows. All columns of the documents are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import fresh, give_back, lean, signed, stored, with_places
from tripwright.llm.words import ALPHANUMERIC, UNSPACED, text_bytes, words

#: Bounds of the training sample and of the lexicon.
SAMPLE_ROWS, LEXICON_WORDS = 20_000, 20_000
#: A lexicon word is in this many bad documents at least, and this much likelier there (log).
LEAST_DOCS, LEAST_LIFT = 4, 2.5
FEATURES = 12

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_PIPE = np.zeros(256, bool)
_PIPE[[124, 35, 36, 37, 38, 42]] = True  # | # $ % & *


def site_of_url(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def path_of_url(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def shape(texts: pa.Array) -> np.ndarray:
    """The features of each text that no lexicon is needed for, one row a text."""
    rows = []
    raw, offsets = text_bytes(texts)
    for w in words(texts, UNSPACED):
        n = len(w.counts)
        own = offsets[w.first : w.first + n + 1]
        size = np.maximum(1, np.diff(own)).astype(float)
        part = raw[own[0] : own[-1]]
        shares = []
        for table in (_UPPER, _DIGIT, _MARK, _PIPE):
            seen = np.concatenate([[0], np.cumsum(table[part], dtype=np.int64)])
            shares.append(np.diff(seen[own - own[0]]) / size)
        count = np.maximum(1, w.counts).astype(float)
        owner = w.owner
        again = np.zeros(len(owner), bool)
        again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
        repeats = np.bincount(owner, again, n) / count
        order = np.lexsort((w.hashes, owner))
        h, o = w.hashes[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        distinct = np.bincount(o, new, n)
        runs = np.diff(np.append(np.flatnonzero(new), len(h)))
        most = np.zeros(n)
        np.maximum.at(most, o[new], runs)
        richness = np.log1p(distinct) / np.log1p(count)
        rows.append(
            np.column_stack(
                [
                    *shares,
                    repeats,
                    distinct / count,
                    richness,
                    most / count,
                    size / count / 10,
                    np.log1p(w.counts) / 10,
                ]
            )
        )
    return np.concatenate(rows) if rows else np.zeros((0, FEATURES - 2))


@dataclass
class Lexicon:
    """Word hashes in ascending order and how much likelier each is in a bad document (log)."""

    hashes: np.ndarray
    lifts: np.ndarray

    def features(self, texts: pa.Array) -> np.ndarray:
        """The greatest lift of a text's words, and the root of the sum of its distinct ones'."""
        rows = []
        for w in words(texts, ALPHANUMERIC):
            out = np.zeros((len(w.counts), 2))
            if len(self.hashes) and len(w.hashes):
                at = np.minimum(np.searchsorted(self.hashes, w.hashes), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == w.hashes)
                pairs = np.unique(np.column_stack([w.owner[hit], at[hit]]), axis=0)
                lifts = self.lifts[pairs[:, 1]]
                np.maximum.at(out[:, 0], pairs[:, 0], lifts)
                np.add.at(out[:, 1], pairs[:, 0], lifts)
                out[:, 1] = np.sqrt(out[:, 1])
            rows.append(out)
        return np.concatenate(rows) if rows else np.zeros((0, 2))


@dataclass
class Evidence:
    """Log odds that a text is bad, without the sample's own prior."""

    lexicon: Lexicon
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    intercept: float

    def __call__(self, texts: pa.Array) -> np.ndarray:
        x = np.hstack([shape(texts), self.lexicon.features(texts)])
        return ((x - self.mean) / self.spread) @ self.weights + self.intercept

    @classmethod
    def none(cls) -> Evidence:
        empty = Lexicon(np.zeros(0, np.uint64), np.zeros(0))
        return cls(empty, np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)


def _expanded(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.hstack([(x - mean) / spread, np.ones((len(x), 1))])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30):
    """Mean, spread, weights and intercept of a ridge logistic regression, by Newton's method."""
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = _expanded(x, mean, spread)
    beta = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = (z.T * (p * (1 - p))) @ z + np.diag(penalty)
        step = np.linalg.solve(curve, z.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, beta[:-1], float(beta[-1])


def _lexicon(counts: DataFrame, bad: int, good: int) -> Lexicon:
    """From rows of hash, bad and good (documents with the word)."""
    lift = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    rows = (
        counts.where(F.col("bad") >= LEAST_DOCS)
        .select("hash", lift.alias("lift"))
        .where(F.col("lift") >= LEAST_LIFT)
        .orderBy(F.desc("lift"), "hash")
        .limit(LEXICON_WORDS)
        .toArrow()
    )
    hashes = rows["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], rows["lift"].to_numpy()[order])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Evidence:
    """Evidence from a sample of labelled documents of bounded size."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    usable = F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    marked = (
        labels.where(usable)
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(bad.cast("int")).alias("bad"))
    )
    # At most sample_rows rows of two numbers: small enough to send to every task.
    sample = stored(
        marked.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "site-bayes-labels"
    )
    half = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(2)).cast("int")
    known = (
        docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        .join(F.broadcast(sample), "id")
        .select("text", "bad", half.alias("half"))
    )

    def present(batches):
        for batch in lean(batches):
            flags = batch["bad"].to_numpy(), batch["half"].to_numpy()
            for w in words(batch["text"], ALPHANUMERIC):
                order = np.lexsort((w.hashes, w.owner))
                h, o = w.hashes[order], w.owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                h, o = h[new], o[new] + w.first
                group = flags[0][o] * 2 + flags[1][o]
                order = np.lexsort((group, h))
                h, group = h[order], group[order]
                edge = np.ones(len(h), bool)
                edge[1:] = (h[1:] != h[:-1]) | (group[1:] != group[:-1])
                at = np.flatnonzero(edge)
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(h[at]),
                        pa.array((group[at] // 2).astype(np.int32)),
                        pa.array((group[at] % 2).astype(np.int32)),
                        pa.array(np.diff(np.append(at, len(h))).astype(np.int64)),
                    ],
                    ["hash", "bad", "half", "n"],
                )

    counts = stored(
        known.mapInArrow(present, "hash long, bad int, half int, n long")
        .groupBy("hash", "half")
        .agg(
            F.sum(F.col("n") * F.col("bad")).alias("bad"),
            F.sum(F.col("n") * (1 - F.col("bad"))).alias("good"),
        )
        .where(F.col("bad") > 0),
        "site-bayes-words",
    )
    sizes = {(r.half, r.bad): r.n for r in known.groupBy("half", "bad").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = _lexicon(counts.where("half = 0"), sizes.get((0, 1), 0), sizes.get((0, 0), 0))

    def featured(batches):
        for batch in lean(batches):
            x = np.hstack([shape(batch["text"]), first.features(batch["text"])])
            rows = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([rows, batch["bad"]], ["x", "bad"])

    rows = known.where("half = 1").mapInArrow(featured, "x array<double>, bad int").toArrow()
    y = rows["bad"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return Evidence.none()
    x = np.concatenate([c.values.to_numpy() for c in rows["x"].chunks if len(c)])
    mean, spread, weights, intercept = fit_logistic(x.reshape(len(y), FEATURES), y)
    prior = np.log(y.mean() / (1 - y.mean()))
    both = counts.groupBy("hash").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    total = [sum(n for (_, b), n in sizes.items() if b == bad) for bad in (1, 0)]
    return Evidence(_lexicon(both, *total), mean, spread, weights, intercept - prior)


def _strength(groups: DataFrame, rate: Column, parent: Column) -> float:
    """How many documents a parent's rate counts as: method of moments over all groups.

    Groups differ from their parent by chance, parent * (1 - parent) / n each, and by a
    variance of their own, which is what is left.
    """
    chance = parent * (1 - parent)
    row = groups.agg(
        F.sum(F.col("n") * (rate - parent) * (rate - parent)),
        F.sum(chance),
        F.sum(F.col("n")),
        F.sum(F.col("n") * chance),
    ).first()
    if not row[2]:
        return 1.0
    own = (row[0] - row[1]) / row[2]
    spread = row[3] / row[2]
    return float(np.clip(spread / own - 1, 1.0, 1e6)) if own > 0 and spread > 0 else 1e6


def group_rates(judged: DataFrame, prior: float) -> DataFrame:
    """site, path, n, site_rate and path_rate from rows of site, path and evidence.

    ``prior`` is the corpus' rate that turns evidence into expected bad documents.
    """
    odds = F.col("evidence") + F.lit(float(np.log(prior / (1 - prior))))
    expected = 1 / (1 + F.exp(-odds))
    paths = stored(
        judged.groupBy("site", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(expected).alias("bad")
        ),
        "site-bayes-paths",
    )
    total = paths.agg(F.sum("bad"), F.sum("n")).first()
    if not total[1]:
        return paths.select("site", "path", "n", F.lit(0.0).alias("site_rate"), F.lit(0.0).alias("path_rate"))
    overall = F.lit(float(np.clip(total[0] / total[1], 1e-4, 1 - 1e-4)))
    sites = paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    strong = _strength(sites, F.col("bad") / F.col("n"), overall)
    sites = sites.select(
        F.col("site").alias("of"),
        ((F.col("bad") + strong * overall) / (F.col("n") + strong)).alias("site_rate"),
    )
    known = paths.join(sites, F.col("site").eqNullSafe(F.col("of"))).drop("of")
    strong = _strength(known, F.col("bad") / F.col("n"), F.col("site_rate"))
    return known.select(
        "site",
        "path",
        "n",
        "site_rate",
        ((F.col("bad") + strong * F.col("site_rate")) / (F.col("n") + strong)).alias("path_rate"),
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    site: Column | None = None,
    path: Column | None = None,
    cut: float = 0.5,
    prior: float = 0.2,
    sample_rows: int = SAMPLE_ROWS,
    keep: list[str] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the judgement's columns, and the names these have.

    The names are of: site, path, evidence (log odds), site_rate, path_rate, bad (posterior) and
    rejected. With ``keep``, only those columns of ``docs`` come along; they are stored with the
    evidence, so that it is computed once.
    """
    labels_of = ("site", "path", "evidence", "site_rate", "path_rate", "bad", "rejected")
    names = dict(zip(labels_of, fresh(docs.columns, *labels_of), strict=True))
    of_site, of_path = fresh([*docs.columns, *names.values()], "of_site", "of_path")
    model = train(docs, labels, sample_rows)

    @F.arrow_udf("double")
    def evidence(texts: pa.Array) -> pa.Array:
        found = pa.array(model(texts))
        give_back()
        return found

    judged = docs.withColumns(
        {
            names["site"]: (F.col("source") if site is None else site).cast("string"),
            names["path"]: (F.col("lang") if path is None else path).cast("string"),
            names["evidence"]: evidence(F.col("text")),
        }
    )
    if keep is not None:
        own = [names[x] for x in ("site", "path", "evidence")]
        judged = stored(judged.select(*keep, *own), "site-bayes-evidence")
    slim = judged.select(*[F.col(names[x]).alias(x) for x in ("site", "path", "evidence")])
    # Spark sends the rates to every task only while they are small enough, else it shuffles.
    rates = stored(group_rates(slim, prior), "site-bayes-rates").select(
        F.col("site").alias(of_site),
        F.col("path").alias(of_path),
        F.col("site_rate").alias(names["site_rate"]),
        F.col("path_rate").alias(names["path_rate"]),
    )
    rate = F.col(names["path_rate"])
    odds = F.col(names["evidence"]) + F.log(rate / (1 - rate))
    out = (
        judged.join(
            rates,
            F.col(names["site"]).eqNullSafe(F.col(of_site))
            & F.col(names["path"]).eqNullSafe(F.col(of_path)),
            "left",
        )
        .drop(of_site, of_path)
        .withColumn(names["bad"], 1 / (1 + F.exp(-odds)))
        .withColumn(names["rejected"], F.col(names["bad"]) > cut)
    )
    return out, names


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    docs, place = with_places(docs)
    judged, names = judge(docs.withColumns(place), labels, keep=list(place), **options)
    gone = stored(judged.where(F.col(names["rejected"])).select(*place), "site-bayes-gone")
    placed = docs.withColumns(place)
    return placed.join(gone, list(place), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
