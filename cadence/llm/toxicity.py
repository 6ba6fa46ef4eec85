"""Toxicity scores by a logistic model with a counterfactual penalty.

Features of a text: its distinct words (letters only, lower case) and their
prefixes of 4 to 7 letters, the ones most associated with the label on the fit
sample, present or not; words of ``IDENTITY`` that the sample holds are always
features.

Fit, on at most ``fit_rows`` rows of each class, first by ids in the order of a
hash, then by a hash of id and text, equal texts of an id once (a documented
bound; scoring covers every row):

* counts of features by label are made by the executors, and the ``features``
  best by a chi-square score with a lift limit are kept;
* for every labelled text that holds an identity term, counterfactual texts are
  made by swapping it for each other term of its group;
* the weights minimise the class-balanced log loss + ``l2`` |w|^2 +
  ``cf`` * mean((score of text - score of its counterfactual)^2), where scores
  are logits.  The third term takes the weight off group mentions as such.

Edge cases: null and empty texts get the score of a text without features; a
missing class gives the share of the other class as score (0.0 without any
label); repeated rows are scored one by one; rows with a null label are not
used; equal texts of an id count once in the fit, an id with both labels with both.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms that name groups neutrally; terms of one line stand for one another in counterfactual texts.
IDENTITY = (
    "women men girls boys woman man",
    "muslims christians jews hindus buddhists atheists muslim christian jewish hindu buddhist",
    "gay lesbian straight bisexual transgender queer heterosexual",
    "black white asian latino african european arab american",
    "immigrants refugees foreigners natives citizens",
    "femmes hommes filles immigrés musulmans chrétiens juifs",
    "frauen männer mädchen ausländer muslime christen juden",
    "mujeres hombres niñas inmigrantes musulmanes cristianos judíos",
)
GROUP = {t: line.split() for line in IDENTITY for t in line.split()}
_WORDS = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> list[str]:
    """A word (marked by a closing =) and its prefixes."""
    return [word + "=", *(word[:n] for n in range(4, 8) if len(word) > n)]


def text_features(text: str | None) -> set[str]:
    return {f for w in set(_WORDS((text or "").lower())) for f in word_features(w)}


@dataclass
class Model:
    """weights by feature, and the bias; ``score`` is the logistic of their sum."""

    weights: dict[str, float]
    bias: float
    memo: dict[str, tuple] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        found: set[str] = set()
        memo = self.memo
        for w in set(_WORDS((text or "").lower())):
            got = memo.get(w)
            if got is None:
                if len(memo) > 300_000:
                    memo.clear()
                got = memo[w] = tuple(f for f in word_features(w) if f in self.weights)
            if got:
                found.update(got)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return 1 / (1 + float(np.exp(-np.clip(z, -500, 500))))


def counterfactuals(text: str) -> list[tuple[set[str], set[str]]]:
    """(features lost, features gained) for each replacement of each identity term of a text by another of its group."""
    words = set(_WORDS(text.lower()))
    out = []
    for term in sorted(words & GROUP.keys()):
        rest = {f for w in words - {term} for f in word_features(w)}
        for other in GROUP[term]:
            if other != term:
                out.append((set(word_features(term)) - rest, set(word_features(other)) - rest))
    return out


def solve(x: np.ndarray, y: np.ndarray, delta: np.ndarray, times: np.ndarray | None = None, *, l2: float, cf: float, steps: int = 25) -> np.ndarray:
    """Weights (the last one is the bias) by Newton steps; ``delta``: rows of feature changes under swaps, ``times``: how often each occurs."""
    n, k = x.shape
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / n
    ridge = np.diag(np.r_[np.full(k, 2 * l2), 1e-9])
    if len(delta):
        times = np.ones(len(delta)) if times is None else times
        ridge[:k, :k] += 2 * cf * (delta * times[:, None]).T @ delta / times.sum()
    w = np.zeros(k + 1)
    for _ in range(steps):
        grad, hess = ridge @ w, ridge + 1e-10 * np.eye(k + 1)
        for i in range(0, n, 1024):  # texts by blocks, so only a block is held as floating-point numbers
            b = np.hstack([x[i: i + 1024], np.ones((len(x[i: i + 1024]), 1))]).astype(float)
            p = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
            own = weight[i: i + 1024]
            grad += b.T @ (own * (p - y[i: i + 1024]))
            hess += (b * (own * p * (1 - p))[:, None]).T @ b
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 4_000, features: int = 1_500, min_count: int = 3, l2: float = 2e-4, cf: float = 1.0) -> Model:
    """Fit on labelled rows of ``docs`` (doc_id, text) that are not held out; ``labels`` holds doc_id and toxic."""
    lab = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")).filter(~held_out(F.col("__id")) & F.col("toxic").isNotNull() & F.col("__id").isNotNull())
    order = F.xxhash64(F.col("__id"))
    known = lab.join(docs.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
    chosen = [known.filter(F.col("toxic") == c).orderBy(order, "__id").limit(fit_rows) for c in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])  # at most 2 * fit_rows rows of an id and a label
    # An id may have any number of rows: the bound holds for the rows as well.
    found = docs.select(F.col("doc_id").alias("__id"), "text").join(F.broadcast(ids), "__id").withColumn("__h", F.xxhash64("text")).dropDuplicates(["__id", "toxic", "__h"])
    rows = [found.filter(F.col("toxic") == c).orderBy(F.xxhash64("__id", "__h"), "__id", "__h").limit(fit_rows) for c in (0, 1)]
    sample = rows[0].unionByName(rows[1]).select("__id", "text", "toxic").repartition(16, "__id")  # a limit leaves one partition
    identity = {f for t in GROUP for f in word_features(t)[:1]}

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for t, y in zip(pdf["text"], pdf["toxic"], strict=True):
                c[int(y == 1)].update(text_features(t))
        names = sorted(c[0].keys() | c[1].keys())
        for i in range(0, len(names), 50_000):
            part = names[i: i + 50_000]
            yield pd.DataFrame({"f": part, "neg": [c[0][x] for x in part], "pos": [c[1][x] for x in part]})

    from cadence.llm.store import written

    sample = written(sample, "toxicity-sample")
    totals = {int(r["toxic"] == 1): r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return Model({}, 30.0 if n1 else -30.0)
    by_f = sample.mapInPandas(counts, "f string, neg long, pos long").groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    p0, p1 = F.col("neg") / n0, F.col("pos") / n1
    m = (F.col("neg") + F.col("pos")) / (n0 + n1)
    chi = (p1 - p0) * (p1 - p0) / (m * (1 - m) + 1e-9) * (n0 * n1 / (n0 + n1))
    lift = (F.greatest(p0, p1) + 1e-4) / (F.least(p0, p1) + 1e-4)
    best = by_f.filter((F.col("neg") + F.col("pos") >= min_count) & (lift > 3) & (chi > 8)).orderBy(F.round(chi, 9).desc(), "f").limit(features)
    named = by_f.filter(F.col("f").isin(*sorted(identity)))  # at most one row an identity term
    vocab = sorted({r["f"] for r in best.select("f").collect()} | {r["f"] for r in named.select("f").collect()})
    index = {f: i for i, f in enumerate(vocab)}

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t, y in zip(pdf["__id"], pdf["text"], pdf["toxic"], strict=True):
                t = t or ""
                rows.append((i, 0, int(y == 1), sorted(index[f] for f in text_features(t) if f in index), []))
                rows += [(i, 1, 0, sorted(index[f] for f in a if f in index), sorted(index[f] for f in b if f in index)) for a, b in counterfactuals(t)]
            yield pd.DataFrame(rows, columns=["id", "kind", "y", "on", "off"])

    # One row a sampled text, and one a distinct change of features: their number is bounded by the sample and by IDENTITY.
    rows = sample.mapInPandas(vectors, "id long, kind int, y int, on array<int>, off array<int>")
    own = rows.filter("kind = 0").select("id", "y", "on").toPandas().sort_values(["id", "y"], kind="stable")
    swap = rows.filter("kind = 1 and on <> off").groupBy("on", "off").agg(F.count("*").alias("n")).orderBy("on", "off").toPandas()
    x = np.zeros((len(own), len(vocab)), bool)
    for r, on in enumerate(own["on"]):
        x[r, list(on)] = 1
    delta = np.zeros((len(swap), len(vocab)))
    for r, (a, b) in enumerate(zip(swap["on"], swap["off"], strict=True)):
        delta[r, list(a)] += 1
        delta[r, list(b)] -= 1
    w = solve(x, own["y"].to_numpy(float), delta, swap["n"].to_numpy(float), l2=l2, cf=cf)
    return Model({f: float(w[i]) for f, i in index.items()}, float(w[-1]))


def score_column(model: Model) -> Column:
    """The score of column ``text``."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Model(model.weights, model.bias)
        for s in batches:
            yield pd.Series([m.score(t) for t in s], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")("text")


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **fitting) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= threshold) of every row of ``docs``."""
    model = fit(docs, labels, **fitting)
    scored = docs.select("doc_id", "text").withColumn("score", score_column(model))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def non_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **fitting) -> DataFrame:
    """The rows of ``docs`` with a score under ``threshold``, with the columns they came with."""
    model = fit(docs, labels, **fitting)
    return docs.withColumn("__score", score_column(model)).filter(F.col("__score") < threshold).select(*docs.columns)
