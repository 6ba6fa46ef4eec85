"""Exact quantiles of several columns in two passes, with bounded memory.

First pass: one aggregate makes, per column (and key), the count, the ends and a
mergeable rank sketch (``percentile_approx``: a value asked for by rank is off by
at most n / ``ACCURACY`` ranks). Two sketch values around a wanted rank bracket
the value at that rank.

Second pass: each task counts the values below each bracket and those inside by
value, a batch of a column at a time, and these counts are summed. Only values
inside brackets are shuffled, about 4 n / ACCURACY for a rank. The value at a rank
is where the running count reaches it.

A rank that lies outside its bracket (the bound of the sketch not kept) is looked
for in the whole column, so the result is exact in any case. Nulls and NaN are left
out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 20_000
SMALL = 50_000   # a column of at most so many values is its own bracket
COARSE = 64      # further ranks of the sketch, for ranks that are known only after the first pass


@dataclass
class Sketch:
    """Count, ends and approximate values at ``probs`` of one column for one key."""

    n: int
    low: float
    high: float
    probs: list[float]
    values: list[float]

    def bracket(self, rank: int) -> tuple[float, float]:
        """Two values that hold the value at 0-based ``rank`` between them."""
        if self.n <= SMALL:
            return self.low, self.high
        a, b = rank / self.n - 1.5 / ACCURACY, (rank + 1) / self.n + 1.5 / ACCURACY
        low = max((v for p, v in zip(self.probs, self.values, strict=True) if p <= a), default=self.low)
        high = min((v for p, v in zip(self.probs, self.values, strict=True) if p >= b), default=self.high)
        return low, high


def number(c: str):
    """Column ``c`` as double, NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def sketch(df: DataFrame, cols: list[str], probs, by: str | None = None) -> dict[tuple, Sketch]:
    """{(key, column): Sketch} by one aggregate; the key is None without ``by``."""
    wanted = {min(1.0, max(0.0, p + d / ACCURACY)) for p in probs for d in (-2, 2)}
    at = sorted(wanted | {i / COARSE for i in range(1, COARSE)})
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.percentile_approx(x, at, ACCURACY).alias(f"q{i}")]
    rows = df.groupBy(F.col(by).cast("string").alias("_by")).agg(*aggs).collect() if by else df.agg(*aggs).collect()
    return {(r["_by"] if by else None, c): Sketch(r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"], at, list(r[f"q{i}"]))
            for r in rows for i, c in enumerate(cols) if r[f"n{i}"]}


def values_at(df: DataFrame, sketches: dict[tuple, Sketch], ranks: dict[tuple, set[int]], by: str | None = None, whole: bool = False) -> dict[tuple, float]:
    """{(key, column, rank): value} of the wanted 0-based ranks, by one pass over ``df``."""
    groups = [(k, c, *((s.low, s.high) if whole else s.bracket(r)), r) for (k, c), rs in ranks.items() for s in [sketches[k, c]] for r in rs]
    brackets = sorted({g[:4] for g in groups}, key=repr)
    if not brackets:
        return {}
    number_of = {b: i for i, b in enumerate(brackets)}
    cols = sorted({c for _, c, _, _ in brackets})
    place = {c: i + 1 for i, c in enumerate(cols)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros(len(brackets), np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            x = {c: batch.column(i).to_numpy(zero_copy_only=False).astype(float) for c, i in place.items()}  # null: NaN, never inside
            out = []
            for i, (k, c, lo, hi) in enumerate(brackets):
                v = x[c] if by is None else x[c][np.array([y == k for y in keys], bool)]
                below[i] += int((v < lo).sum())
                inside, times = np.unique(v[(v >= lo) & (v <= hi)], return_counts=True)
                out.append((np.full(len(inside), i), inside, times))
            yield rows(*(np.concatenate(a) for a in zip(*out, strict=True)))
        yield rows(np.arange(len(brackets)), None, below)

    def rows(i, value, n) -> pa.RecordBatch:
        value = pa.nulls(len(i), pa.float64()) if value is None else pa.array(value, pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), value, pa.array(n, pa.int64())], names=["i", "value", "n"])

    key = F.col(by).cast("string") if by else F.lit(None).cast("string")
    counts = df.select(key.alias("_by"), *[number(c).alias(c) for c in cols]).mapInArrow(count, "i int, value double, n long")
    counts = counts.groupBy("i", "value").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    order = Window.partitionBy("i").orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("upto", F.sum("n").over(order)).where(F.col("value").isNotNull())
    want = df.sparkSession.createDataFrame([(number_of[g[:4]], g[4]) for g in groups], "i int, rank long")
    hit = running.join(F.broadcast(want), "i").where((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
    found = {}
    for r in hit.select("i", "rank", "value").collect():  # one row a wanted rank
        found[(*brackets[r["i"]][:2], r["rank"])] = r["value"]
    missing = {(k, c): {r for r in rs if (k, c, r) not in found} for (k, c), rs in ranks.items()}
    missing = {kc: rs for kc, rs in missing.items() if rs}
    if missing and not whole:
        found |= values_at(df, sketches, missing, by, whole=True)
    return found


def interpolated(n: int, p: float, value) -> float:
    """The quantile ``p`` of ``n`` values by linear interpolation; ``value(rank)`` gives a value by rank."""
    at = p * (n - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return value(lo) if lo == hi else (hi - at) * value(lo) + (at - lo) * value(hi)


def exact_quantiles(df: DataFrame, cols: list[str], probs, by: str | None = None, sketches: dict | None = None) -> dict[tuple, list[float]]:
    """{(key, column): the quantiles ``probs``}; the key is None without ``by`` (a column of few labels).

    Columns without values are left out."""
    s = sketch(df, cols, probs, by) if sketches is None else sketches
    ranks = {kc: {f(p * (x.n - 1)) for p in probs for f in (math.floor, math.ceil)} for kc, x in s.items()}
    found = values_at(df, s, ranks, by)
    return {kc: [interpolated(x.n, p, lambda r, kc=kc: found[(*kc, r)]) for p in probs] for kc, x in s.items()}
