"""Profiling aggregates: totals, histograms, top-N, trimmed statistics,
correlations, coverage. Scalars that parameterise a second pass (quantile
edges, min/max) are fitted by one aggregate and applied as literals."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.quantiles import exact_quantiles, number, sketch, values_at


def distribution(df: DataFrame, col: str, unknown: str | None = None, digits: int = 9) -> DataFrame:
    """(col, n, pct) per value, plus 'labeled' (all but ``unknown``) and 'total' rows."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    tot = c.agg(F.sum("n").alias("total"),
                F.sum(F.when(F.col(col) != F.lit(unknown), F.col("n")).otherwise(0)).alias("lab")).first()
    total, lab = int(tot["total"] or 0), int(tot["lab"] or 0)
    pct = lambda x: F.round(F.lit(100.0) * x / F.lit(float(total)), digits)
    rows = c.select(F.col(col), "n", pct(F.col("n")).alias("pct"))
    spark = df.sparkSession
    extra = spark.createDataFrame([("labeled", lab), ("total", total)], f"{col} string, n long") \
        .select(col, "n", pct(F.col("n")).alias("pct"))
    return rows.unionByName(extra)


def fit_scalars(df: DataFrame, *aggs) -> dict:
    """Run one global aggregate (a fixed number of scalars) and return it as a
    dict. Used to fit edges and bounds that a second pass applies as literals
    (the fit/transform pattern; no join with a one-row table)."""
    row = df.agg(*aggs).first()
    return row.asDict() if row is not None else {}


BROADCAST_BYTES = 16 << 20  # of rows in memory, at most, that are broadcast


def measured(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` as the right side of a join: broadcast if its rows, ``row_bytes`` each, take at most ``most``, else merged.

    Spark goes by the size of files, which rows that repeat hardly fill, and a
    broadcast table is built in the driver. The rows are counted for it, so ``df``
    should start from a written table."""
    n = fit_scalars(df, F.count(F.lit(1)).alias("n"))["n"] or 0
    return F.broadcast(df) if few_rows(n, row_bytes, most) else df.hint("merge")


def few_rows(n: int, row_bytes: int, most: int) -> bool:
    return n * row_bytes <= most


SLICE_ROWS = 4_000_000  # of a table whose groups are worked on a slice at a time
MOST_SLICES = 16


def slices_for(df: DataFrame, most: int | None = None) -> int:
    """Number of slices of about ``most`` rows (``SLICE_ROWS``) each, ``MOST_SLICES`` at most."""
    rows = fit_scalars(df, F.count(F.lit(1)).alias("n"))["n"] or 0
    return min(MOST_SLICES, max(1, math.ceil(rows / (most or SLICE_ROWS))))


def in_slices(df: DataFrame, key: str, make, stage, name: str, most: int | None = None) -> DataFrame:
    """``make(df)``, written by ``stage``, for an operator that looks at each group ``key`` by itself.

    A table of more than ``most`` rows (``SLICE_ROWS``) is worked on in slices of whole groups, one after
    the other, so that the files of its shuffles take the disk of a slice at a time. There are at
    most ``MOST_SLICES``: each reads ``df``, and what ``make`` joins to it, once."""
    n = slices_for(df, most)
    parts = [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [df]
    together = getattr(stage, "together", None)  # one table: a union repeats all that is planned on it
    if together:
        return together((make(part) for part in parts), name)
    return functools.reduce(DataFrame.unionByName, [stage(make(part), name) for part in parts])


def totals_long(playlists: DataFrame, tracks: DataFrame, title_norm, approx: bool = False) -> DataFrame:
    """(metric, value): dataset totals as rows (global aggregates, unioned).
    ``approx=True`` uses HyperLogLog++ sketches instead of exact distinct counts."""
    cd = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.countDistinct
    p = playlists.agg(
        F.count(F.lit(1)).cast("double").alias("n_playlists"),
        cd("name").cast("double").alias("n_titles"),
        cd(title_norm).cast("double").alias("n_titles_norm"),
        F.sum(F.col("has_desc").cast("long")).cast("double").alias("n_with_desc"),
        F.round(F.avg("num_followers"), 9).alias("mean_followers"))
    if approx:
        t = tracks.agg(
            F.count(F.lit(1)).cast("double").alias("n_entries"),
            cd("track_uri").cast("double").alias("n_tracks"), cd("album_uri").cast("double").alias("n_albums"),
            cd("artist_uri").cast("double").alias("n_artists"), cd("pid").cast("double").alias("n_groups"),
            F.round(F.avg("track_dur_ms"), 9).alias("mean_track_dur_ms"),
            F.round(F.count(F.lit(1)) / cd("pid"), 9).alias("mean_len"))
        return unpivot(p).unionByName(unpivot(t))
    # Entries collapse to the distinct (track, album, artist) first, combined before the shuffle; only those are expanded
    # for the distinct counts. Groups are counted by a pass of their own.
    items = tracks.groupBy("track_uri", "album_uri", "artist_uri").agg(
        F.count(F.lit(1)).alias("_n"), F.count("track_dur_ms").alias("_nd"), F.sum("track_dur_ms").alias("_d"))
    t = items.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("n_entries"), F.round(F.sum("_d") / F.sum("_nd"), 9).alias("mean_track_dur_ms"),
                  *[F.countDistinct(c).cast("double").alias(n) for c, n in (("track_uri", "n_tracks"), ("album_uri", "n_albums"), ("artist_uri", "n_artists"))])
    groups = tracks.groupBy("pid").agg(F.count(F.lit(1)).alias("_n"))
    g = groups.agg(F.count("pid").cast("double").alias("n_groups"), F.round(F.sum("_n") / F.count("pid"), 9).alias("mean_len"))
    return unpivot(p).unionByName(unpivot(t)).unionByName(unpivot(g))


def unpivot(df: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    cols = df.columns
    expr = "stack({}, {}) as ({}, {})".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols), name, value)
    return df.selectExpr(expr)


def top_values(tagged: DataFrame, tag: str, value: str, n: int = 20) -> DataFrame:
    """(tag, value, n, rank): top-n values per tag by (count desc, value asc).
    The per-tag window is limited to n rows per partition before its shuffle."""
    from cadence.operators.recommend import top_k_per_group
    c = tagged.groupBy(tag, value).agg(F.count(F.lit(1)).cast("long").alias("n"))
    r = top_k_per_group(c, tag, [F.col("n").desc(), F.col(value)], n)
    return r.withColumn("rank", F.col("rank").cast("long"))


def top_by_count(df: DataFrame, keys: list[str], n: int, count_col: str = "n",
                 extra_aggs=()) -> DataFrame:
    """Group count top-n by (count desc, keys asc): partial aggregate + take-ordered."""
    c = df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(count_col), *extra_aggs)
    return c.orderBy(F.col(count_col).desc(), *[F.col(k) for k in keys]).limit(n)


def quantiles(c, probs, approx: bool = False, accuracy: int = 10000):
    """Exact linear-interpolated quantiles (one counter per distinct value), or
    bounded-memory ``percentile_approx`` sketches for high-cardinality columns."""
    col = F.col(c).cast("double") if isinstance(c, str) else c
    if approx:
        return F.percentile_approx(col, F.lit(list(probs)) if isinstance(probs, (list, tuple)) else probs, accuracy)
    return F.percentile(col, F.lit(list(probs)) if isinstance(probs, (list, tuple)) else F.lit(probs))


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, x): the numeric columns ``cols`` as rows."""
    return df.selectExpr("stack({}, {}) as (variable, x)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)))


def _attach(df: DataFrame, key: str, scalars: dict[str, list], names: list[str]) -> DataFrame:
    """Add fitted scalars as columns; one row per key."""
    rows = [(k, *v) for k, v in scalars.items()]
    s = df.sparkSession.createDataFrame(rows, f"_k string, {', '.join(f'{c} double' for c in names)}")
    return df.join(F.broadcast(s), F.col(key).cast("string").eqNullSafe(F.col("_k")), "left").drop("_k")


def trimmed_stats(df: DataFrame, cols: list[str], lo: float = 0.1, hi: float = 0.9,
                  digits: int = 2, approx: bool = False) -> DataFrame:
    """(variable, trimmed_median, trimmed_mean, trimmed_std, p_lo, p_hi) with
    the trim lo <= x <= hi on each column's own quantiles. Columns without
    values are left out.

    The quantiles take two passes, the moments one; the trimmed median is a rank
    of the column, known from the counts, and is read off with the first sketch
    (exact) or is that of a sketch of the trimmed values (``approx``)."""
    if approx:
        s = fit_scalars(df, *[quantiles(c, [lo, hi], approx).alias(c) for c in cols])
        q = {c: [float(v) for v in s[c]] for c in cols if s[c] is not None}
    else:
        sketches = sketch(df, cols, [lo, hi])
        q = {c: v for (_, c), v in exact_quantiles(df, cols, [lo, hi], sketches=sketches).items()}
    aggs = []
    for i, (c, (a, b)) in enumerate(q.items()):
        x = number(c)
        x_in = F.when((x >= a) & (x <= b), x)
        aggs += [F.avg(x_in).alias(f"m{i}"), F.stddev_samp(x_in).alias(f"s{i}"), F.count(x_in).alias(f"n{i}"), F.count(F.when(x < a, x)).alias(f"b{i}")]
        aggs += [quantiles(x_in, 0.5, True).alias(f"q{i}")] if approx else []
    got = fit_scalars(df, *aggs) if aggs else {}
    if approx:
        medians = {c: got[f"q{i}"] for i, c in enumerate(q)}
    else:
        ranks = {c: [got[f"b{i}"] + f(0.5 * (got[f"n{i}"] - 1)) for f in (math.floor, math.ceil)] for i, c in enumerate(q) if got[f"n{i}"]}
        at = values_at(df, sketches, {(None, c): set(r) for c, r in ranks.items()})
        medians = {c: (at[None, c, r[0]] + at[None, c, r[1]]) / 2 for c, r in ranks.items()}
    names = ("trimmed_median", "trimmed_mean", "trimmed_std", "p_lo", "p_hi")
    rows = [(c, medians.get(c), got[f"m{i}"], got[f"s{i}"], *q[c]) for i, c in enumerate(q)]
    out = df.sparkSession.createDataFrame(rows, "variable string, " + ", ".join(f"{n} double" for n in names))
    return out.select("variable", *[F.round(n, digits).alias(n) for n in names])


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """(a, b, r): Pearson correlation for every ordered pair, one aggregate."""
    aggs = [F.corr(a, b).alias(f"{a}__{b}") for a in cols for b in cols]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a in cols for b in cols)
    return wide.selectExpr(f"stack({len(cols) ** 2}, {pairs}) as (a, b, r)").withColumn(
        "r", F.round("r", digits))


def gram_corr(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """(a, b, r): Pearson correlation for every ordered pair of many columns, over the rows that hold both.

    One scan: each task adds up matrix products of its batches, X'X, (X^2)'M, X'M
    and M'M with M the mask of present values, and yields one row per pair (a <= b);
    these are summed per pair. Values are taken relative to the means of the first
    rows, so large offsets cost no digits. r is null with fewer than two rows or
    without variance. NaN counts as absent."""
    d = len(cols)
    x = df.select(*[number(c).alias(c) for c in cols])
    near = x.limit(256).agg(*[F.avg(c).alias(c) for c in cols]).first()
    shift = np.array([near[c] or 0.0 for c in cols])
    ai, bi = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xx, sq, s, n = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            v = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - shift
            m = ~np.isnan(v)
            v, m = np.where(m, v, 0.0), m.astype(float)
            xx += v.T @ v
            sq += (v * v).T @ m  # of the first of a pair, where the second is present
            s += v.T @ m
            n += m.T @ m
        values = (n[ai, bi], s[ai, bi], s[bi, ai], sq[ai, bi], sq[bi, ai], xx[ai, bi])
        yield pa.RecordBatch.from_arrays([pa.array(ai, pa.int32()), pa.array(bi, pa.int32()), *map(pa.array, values)], names=["i", "j", "n", "sa", "sb", "qa", "qb", "ab"])

    sums = x.mapInArrow(products, "i int, j int, n double, sa double, sb double, qa double, qb double, ab double").groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "ab")])
    var = (F.col("n") * F.col("qa") - F.col("sa") * F.col("sa")) * (F.col("n") * F.col("qb") - F.col("sb") * F.col("sb"))
    r = F.when((F.col("n") > 1) & (var > 0), (F.col("n") * F.col("ab") - F.col("sa") * F.col("sb")) / F.sqrt(var))
    name = F.array(*[F.lit(c) for c in cols])
    pair = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    out = sums.select(F.round(r, digits).alias("r"), F.explode(F.when(F.col("i") == F.col("j"), F.slice(pair, 1, 1)).otherwise(pair)).alias("p"))
    return out.select(F.get(name, F.col("p.a")).alias("a"), F.get(name, F.col("p.b")).alias("b"), "r")


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None,
              by: str | None = None) -> DataFrame:
    """Equal-width histogram: (bin, bin_lo, bin_hi, n) (+ ``by``); the last bin is
    closed on the right. lo/hi default to the column's min/max (fitted once)."""
    if lo is None or hi is None:
        s = fit_scalars(df, F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
        lo = s["lo"] if lo is None else lo
        hi = s["hi"] if hi is None else hi
    lo, hi = float(lo), float(hi)
    w = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    d = df.where((x >= lo) & (x <= hi)).withColumn("bin", b)
    keys = ([by] if by else []) + ["bin"]
    out = d.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n"))
    return out.withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(w)).withColumn(
        "bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(w))


def histograms(df: DataFrame, cols: list[str], bins: int) -> DataFrame:
    """(variable, bin, n, bin_lo, bin_hi): equal-width histograms of several columns between their own ends, in two passes for all."""
    s = fit_scalars(df, *[f(c).cast("double").alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    ends = {c: [s[f"lo_{c}"], s[f"hi_{c}"]] for c in cols if s[f"lo_{c}"] is not None}
    wide = {c: [lo, (hi - lo) / bins if hi > lo else 1.0] for c, (lo, hi) in ends.items()}
    x = _attach(long_form(df, cols).where(F.col("x").isNotNull()), "variable", wide, ["_lo", "_w"])
    b = F.least(F.floor((F.col("x") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).cast("int")
    h = x.groupBy("variable", b.alias("bin"), "_lo", "_w").agg(F.count(F.lit(1)).cast("long").alias("n"))
    return h.select("variable", "bin", "n", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"), (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"))


def describe_exact(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """(variable, count, mean, std, min, p25, p50, p75, max) per column; columns without values are left out."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    some = [c for c in cols if (None, c) in q]
    aggs = [a for i, c in enumerate(some) for a in (F.count(number(c)).alias(f"n{i}"), F.avg(number(c)).alias(f"m{i}"), F.stddev_samp(number(c)).alias(f"s{i}"),
                                                    F.min(number(c)).alias(f"a{i}"), F.max(number(c)).alias(f"b{i}"))]
    got = fit_scalars(df, *aggs) if aggs else {}
    rows = [(c, got[f"n{i}"], got[f"m{i}"], got[f"s{i}"], got[f"a{i}"], *q[None, c], got[f"b{i}"]) for i, c in enumerate(some)]
    out = df.sparkSession.createDataFrame(rows, "variable string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")
    return out.select("variable", "count", *[F.round(c, digits).alias(c) for c in ("mean", "std")], "min", *[F.round(c, digits).alias(c) for c in ("p25", "p50", "p75")], "max")


def coverage_top_pct(vocab: DataFrame, pcts=(0.1, 1, 5, 10, 25, 50), freq: str = "corpus_freq",
                     idx: str = "corpus_idx", digits: int = 9) -> DataFrame:
    """(pct, n_items, coverage_pct): share of entries held by the top
    n = max(1, int(V * pct / 100)) items."""
    s = fit_scalars(vocab, F.count(F.lit(1)).alias("V"))
    V = int(s["V"])
    ns = [max(1, int(V * p / 100)) for p in pcts]
    aggs = [F.sum(F.col(freq)).alias("_T")] + [
        F.sum(F.when(F.col(idx) < n, F.col(freq)).otherwise(0)).alias(f"_c{i}") for i, n in enumerate(ns)]
    wide = vocab.agg(*aggs)
    rows = ", ".join(f"CAST({float(p)} AS DOUBLE), CAST({n} AS BIGINT), _c{i}" for i, (p, n) in enumerate(zip(pcts, ns)))
    return wide.selectExpr(f"stack({len(ns)}, {rows}) as (pct, n_items, _c)", "_T").select(
        "pct", "n_items", F.round(F.col("_c") * 100.0 / F.col("_T"), digits).alias("coverage_pct"))


def vocab_limit_coverage(vocab: DataFrame, limits=(100, 1000), freq: str = "corpus_freq",
                         idx: str = "corpus_idx", digits: int = 9) -> DataFrame:
    """(vocab_limit, coverage_pct, unk_pct) for each limit V: sum(freq, idx < V) / sum(freq)."""
    aggs = [F.sum(F.col(freq)).alias("_T")] + [
        F.sum(F.when(F.col(idx) < v, F.col(freq)).otherwise(0)).alias(f"_c{i}") for i, v in enumerate(limits)]
    wide = vocab.agg(*aggs)
    rows = ", ".join(f"CAST({v} AS BIGINT), _c{i}" for i, v in enumerate(limits))
    cov = F.round(F.col("_c") * 100.0 / F.col("_T"), digits)
    return wide.selectExpr(f"stack({len(limits)}, {rows}) as (vocab_limit, _c)", "_T").select(
        "vocab_limit", cov.alias("coverage_pct"),
        F.round(F.lit(100.0) - F.col("_c") * 100.0 / F.col("_T"), digits).alias("unk_pct"))


def coverage_curve(vocab: DataFrame, freq: str = "corpus_freq", idx: str = "corpus_idx",
                   digits: int = 9) -> DataFrame:
    """(corpus_idx, corpus_freq, cum_freq, coverage_pct): cumulative share of
    entries held by ranks 0..idx. The running sum is bucketed by blocks of
    ranks (see ranking.ordered_index), never one global window."""
    from cadence.operators.ranking import ordered_index
    total = fit_scalars(vocab, F.sum(freq).alias("T"))["T"]
    d = vocab.withColumn("_blk", F.floor(F.col(idx) / F.lit(4096)))
    r = ordered_index(d, bucket=["_blk"], bucket_order=[F.col("_blk")], row_order=[F.col(idx)],
                      index_col="_i", weight=freq, cum_col="cum_freq")
    return r.select(idx, freq, F.col("cum_freq").cast("long"),
                    F.round(F.col("cum_freq") * 100.0 / F.lit(float(total)), digits).alias("coverage_pct"))


def artists_per_group(playlists: DataFrame, tracks: DataFrame) -> DataFrame:
    """(pid, num_tracks, n_art, ratio): distinct artists, and their ratio to num_tracks clipped to [0, 1]."""
    d = tracks.select("pid", "artist_uri").distinct().groupBy("pid").agg(F.count("artist_uri").alias("n_art"))
    return d.join(playlists.select("pid", "num_tracks"), "pid", "inner").withColumn(
        "ratio", F.least(F.greatest(F.col("n_art") / F.nullif(F.col("num_tracks"), F.lit(0)), F.lit(0.0)),
                         F.lit(1.0)))


def artist_diversity(playlists: DataFrame, tracks: DataFrame, digits: int = 9) -> DataFrame:
    """One row: distinct artists per group (median, mean, p10, p90, max) and
    their ratio to the group's entries (median, mean)."""
    j = artists_per_group(playlists, tracks)
    q = exact_quantiles(j, ["n_art", "ratio"], [0.1, 0.5, 0.9])
    none = [None] * 3
    a, r = q.get((None, "n_art"), none), q.get((None, "ratio"), none)
    fixed = lambda v: F.round(F.lit(v).cast("double"), digits)
    return j.agg(
        fixed(a[1]).alias("artists_median"), F.round(F.avg("n_art"), digits).alias("artists_mean"),
        fixed(a[0]).alias("artists_p10"), fixed(a[2]).alias("artists_p90"), F.max("n_art").cast("long").alias("artists_max"),
        fixed(r[1]).alias("ratio_median"), F.round(F.avg("ratio"), digits).alias("ratio_mean"))


def split_profile(groups: DataFrame, by: str = "split", col: str = "seq_len", digits: int = 9) -> DataFrame:
    """Per split: n, min, p10, median, mean, p90, max, quartiles and the box-plot
    whiskers (extreme values inside 1.5 IQR of the quartiles)."""
    x = F.col(col).cast("double")
    s = groups.groupBy(by).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.min(x).alias("min"),
        F.round(F.avg(x), digits).alias("mean"), F.max(x).alias("max"))
    fitted = {k: v for (k, _), v in exact_quantiles(groups, [col], [0.1, 0.25, 0.5, 0.75, 0.9], by).items()}
    s = _attach(s, by, fitted, ["p10", "q1", "median", "q3", "p90"])
    s = s.select(by, "n", "min", "p10", "median", "mean", "p90", "max", "q1", "q3")
    # one row per split: a bounded side, broadcast for the fence pass
    fences = s.select(by, (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_flo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_fhi"))
    w = groups.join(F.broadcast(fences), by).groupBy(by).agg(
        F.min(F.when(x >= F.col("_flo"), x)).alias("whisker_lo"),
        F.max(F.when(x <= F.col("_fhi"), x)).alias("whisker_hi"))
    return s.join(w, by)
