"""Quality scores by a generalised additive model with pairwise interactions.

A text is described by ``FEATURES``, numbers taken from its bytes, words and
lines.  The model adds one looked-up number per feature and one per chosen pair
of features to a constant; the logistic of the sum is the score.

Fit, on the driver, from a bounded sample (``fit_rows`` rows of each class, in
the order of a hash of id and features; scoring covers every row):

* features are cut into at most ``bins`` bins at quantiles of the sample;
* cyclic boosting: each round visits the features in turn, fits a tree of at most
  ``leaves`` leaves to the gradient per bin (Newton steps), and adds ``rate``
  times its leaf values to the feature's table;
* pairs of features are ranked by the gain of the best cross-shaped split of the
  gradient left over, and the best ``pairs`` get tables of their own by the same
  cycle over trees of one cut on each side;
* rows are weighted so that both classes have their share of all labelled ids.

Scoring finds the bin of each feature and adds table entries, a batch at a time.

Edge cases: null and empty texts have zero for every feature and get a score like
any other; rows of one id, label and equal features count once in the fit; an id
with both labels counts with both; labels that are null, or whose id is null, are
not used; with one class only, the score is its label, with none 0.5; repeated
rows are scored one by one; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.store import written

FEATURES = ("log_words", "mean_word", "longest_word", "distinct_words", "top_word", "distinct_pairs", "repeated_neighbours", "short_words", "capital_words",
            "bare_words", "marked_words", "lower", "upper", "digit", "space", "marks", "symbols", "other_ascii", "beyond_ascii", "entropy",
            "log_lines", "words_per_line", "repeated_lines", "ended_lines", "words_per_sentence")
_KINDS = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r\x0b\x0c",
          "marks": b".,;:!?'\"()-", "symbols": b"#*$%&|<>"}
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def text_features(text: bytes | None) -> list[float]:
    """FEATURES of a text in UTF-8."""
    text = text or b""
    by = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n, size = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    neighbours = Counter(zip(words, words[1:], strict=False))
    kinds = [by[list(k)].sum() for k in _KINDS.values()]
    beyond = by[128:].sum()
    share = by[by > 0] / size
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    ends = by[[33, 46, 63]].sum()

    def of_words(test) -> float:
        return sum(k for w, k in counts.items() if test(w)) / n

    return [np.log1p(n), lengths.mean(), lengths.max(), len(counts) / n, max(counts.values()) / n, len(neighbours) / max(1, n - 1),
            sum(k for (a, b), k in neighbours.items() if a == b) / max(1, n - 1), (lengths <= 3).mean(), of_words(lambda w: w[:1].isupper()),
            of_words(lambda w: not _LETTER.search(w)), of_words(lambda w: w[-1] in b"#*$%&|<>!@^~=+"),
            *(k / size for k in kinds), (size - sum(kinds) - beyond) / size, beyond / size, float(-(share * np.log2(share)).sum()),
            np.log1p(len(lines)), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
            sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / max(1, len(lines)), n / max(1, ends)]


def _features(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [text_features(t) for t in b.column("__text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])


@dataclass
class Gam:
    """``cuts`` of each feature; ``tables`` by feature; ``pair_tables`` by (feature, feature); all added to ``constant``."""

    cuts: list[np.ndarray]
    constant: float
    tables: dict[int, np.ndarray] = field(default_factory=dict)
    pair_tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], 1) if len(self.cuts) else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        z = np.full(len(x), self.constant)
        for f, t in self.tables.items():
            z += t[b[:, f]]
        for (f, g), t in self.pair_tables.items():
            z += t[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _value(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g / (h + l2)


def _gain(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / (h + l2)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float, least: float) -> np.ndarray:
    """Leaf value of each bin: the bins are cut, best gain first, into at most ``leaves`` runs of ``least`` curvature or more."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for s, (lo, hi) in enumerate(spans):
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gr, hr = g[lo:hi].sum() - gl, h[lo:hi].sum() - hl
            gain = np.where((hl >= least) & (hr >= least), _gain(gl, hl, l2) + _gain(gr, hr, l2) - _gain(gl + gr, hl + hr, l2), -1)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], s, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = spans.pop(best[1])
        spans += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in spans:
        out[lo:hi] = _value(g[lo:hi].sum(), h[lo:hi].sum(), l2)
    return out


def cross_split(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, np.ndarray]:
    """(gain, leaf value of each cell) of the best split of a grid by one cut on each side."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        a, b, d, w = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
        return [a, b - a, d - a, w - b - d + a]

    gq, hq = quarters(cg), quarters(ch)
    gain = sum(_gain(a, np.maximum(b, 0), l2) for a, b in zip(gq, hq, strict=True)) - _gain(cg[-1, -1], ch[-1, -1], l2)
    gain = np.where(np.minimum.reduce(hq) >= least, gain, 0.0)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[at] <= 0:
        return 0.0, np.zeros(g.shape)
    values, (r, c) = [_value(a[at], b[at], l2) for a, b in zip(gq, hq, strict=True)], (at[0] + 1, at[1] + 1)
    out = np.zeros(g.shape)
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = values
    return float(gain[at]), out


def fit_gam(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, bins: int = 32, leaves: int = 3, rounds: int = 60, pairs: int = 8, pair_rounds: int = 30,
            rate: float = 0.15, l2: float = 1.0, least: float = 0.5) -> Gam:
    """The model of labels ``y`` (0, 1) of the rows ``x``; deterministic."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) for col in x.T]
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    model = Gam(cuts, float(np.log(share / (1 - share))))
    b = model.binned(x)
    sizes = [len(c) + 1 for c in cuts]
    z = np.full(len(y), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)

    model.tables = {f: np.zeros(k) for f, k in enumerate(sizes) if k > 1}
    for _ in range(rounds):
        for f, table in model.tables.items():
            g, h = slopes()
            step = rate * shallow_tree(np.bincount(b[:, f], g, sizes[f]), np.bincount(b[:, f], h, sizes[f]), leaves, l2, least)
            table += step
            z += step[b[:, f]]

    def grid(f: int, k: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = b[:, f] * sizes[k] + b[:, k]
        return tuple(np.bincount(cell, v, sizes[f] * sizes[k]).reshape(sizes[f], sizes[k]) for v in (g, h))

    g, h = slopes()
    some = sorted(model.tables)
    ranked = sorted(((-cross_split(*grid(f, k, g, h), l2, least)[0], f, k) for i, f in enumerate(some) for k in some[i + 1:]))
    model.pair_tables = {(f, k): np.zeros((sizes[f], sizes[k])) for gain, f, k in ranked[:pairs] if gain < 0}
    for _ in range(pair_rounds):
        for (f, k), table in model.pair_tables.items():
            g, h = slopes()
            step = rate * cross_split(*grid(f, k, g, h), l2, least)[1]
            table += step
            z += step[b[:, f], b[:, k]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 6_000, **boosting) -> Gam:
    """Fit on labelled rows of ``docs`` (doc_id, text) that are not held out; ``labels`` holds doc_id and quality (0 or 1)."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y")).filter(
        ~held_out(F.col("__id")) & F.col("__y").isNotNull() & F.col("__id").isNotNull()).distinct()
    known = known.join(docs.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
    counts = {int(r["__y"] == 1): r["n"] for r in known.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Gam([], 40.0 if 1 in counts else -40.0 if counts else 0.0)
    order = F.xxhash64("__id")
    chosen = [known.filter(F.col("__y") == c).orderBy(order, "__id").limit(fit_rows) for c in (0, 1)]
    some = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "__id")  # at most 2 * fit_rows ids
    schema = f"__id {known.schema['__id'].dataType.simpleString()}, __y int, x array<double>"
    sample = written(some.select("__id", "__y", "__text").mapInArrow(lambda it: _features(it, ["__id", "__y"]), schema).dropDuplicates(["__id", "__y", "x"]), "gam-sample")
    rows = pd.concat([sample.filter(F.col("__y") == c).orderBy(F.xxhash64("__id", "x"), "__id").limit(fit_rows).toPandas() for c in (0, 1)])
    y = (rows["__y"] == 1).to_numpy(float)
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts[0] / max(1, (1 - y).sum()))
    weight *= len(y) / weight.sum()
    return fit_gam(np.array(rows["x"].to_list()), y, weight, **boosting)


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **fitting) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= threshold) of every row of ``docs``."""
    model = fit(docs, labels, **fitting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([text_features(t) for t in b.column("__text").cast(pa.binary()).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = docs.select("doc_id", F.col("text").alias("__text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
