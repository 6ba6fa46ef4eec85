"""Corpus, vocabulary, encoding, stratified split and seed/holdout frames.

Sequences stay in long form ``(pid, pos, item)``: a group is never gathered
into one array, so a group holding a large share of the data is still spread
over many tasks. Where the reference uses per-group lists, the operators use
positions (``pos < sp`` for the seed, ``pos >= sp`` for the holdout).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators.ranking import key_prefix, magnitude, ordered_index


def group_sizes(seqs: DataFrame, group: str = "pid", out: str = "seq_len") -> DataFrame:
    """(group, out): rows per group; a partial aggregate, safe for hot groups."""
    return seqs.groupBy(group).agg(F.count(F.lit(1)).cast("long").alias(out))


def build_corpus(entries: DataFrame, min_len: int = 5, group: str = "pid") -> DataFrame:
    """Entries of groups with at least ``min_len`` rows, plus ``seq_len``."""
    sizes = group_sizes(entries, group).where(F.col("seq_len") >= min_len)
    return entries.join(sizes, group, "inner")


def corpus_report(entries: DataFrame, min_len: int = 5, group: str = "pid") -> DataFrame:
    """One row: sequences before / after the support filter and dropped."""
    s = group_sizes(entries, group)
    return s.agg(F.count(F.lit(1)).alias("n_before"),
                 F.sum((F.col("seq_len") >= min_len).cast("long")).alias("n_after")).select(
        F.col("n_before").cast("long"), F.coalesce("n_after", F.lit(0)).cast("long").alias("n_after"),
        (F.col("n_before") - F.coalesce("n_after", F.lit(0))).cast("long").alias("n_dropped"))


def vocabulary(corpus: DataFrame, item: str = "track_uri", skip_prefix: int = 0,
               prefix_len: int = 2, stage=lambda df: df) -> DataFrame:
    """(item, corpus_idx, corpus_freq): dense 0-based index by (freq desc, item asc).

    The global order is split into buckets (magnitude of freq, freq, leading
    characters of the item after ``skip_prefix`` constant characters), so no
    single task sorts all items. ``stage`` may keep the counts, which the
    numbering reads twice, as a written table. A null item is numbered too.
    """
    freq = corpus.groupBy(item).agg(F.count(F.lit(1)).cast("long").alias("corpus_freq"))
    freq = freq.withColumn("_pfx", key_prefix(item, skip_prefix, prefix_len))
    freq = freq.withColumn("_mag", magnitude("corpus_freq"))
    r = ordered_index(stage(freq), bucket=["_mag", "corpus_freq", "_pfx"],
                      bucket_order=[F.col("_mag").desc(), F.col("corpus_freq").desc(), F.col("_pfx")],
                      row_order=[F.col(item)], index_col="corpus_idx")
    return r.select(item, "corpus_idx", "corpus_freq")


def encode(corpus: DataFrame, vocab: DataFrame, item: str = "track_uri",
           out: str = "track_idx") -> DataFrame:
    """Replace ``item`` by its vocabulary index (inner equi-join on the key)."""
    v = vocab.select(F.col(item), F.col("corpus_idx").cast("int").alias(out))
    return corpus.join(v, item, "inner").drop(item)


def length_bin_edges(groups: DataFrame, col: str = "seq_len", q: int = 10) -> list[float]:
    """Distinct quantile edges (linear interpolation) -- q+1 numbers, fitted once."""
    probs = [i / q for i in range(q + 1)]
    from cadence.operators.quantiles import exact_quantiles
    edges = []
    for e in exact_quantiles(groups, [col], probs).get((None, col), []):
        if not edges or e != edges[-1]:
            edges.append(float(e))
    return edges


def length_bins(groups: DataFrame, col: str = "seq_len", q: int = 10, out: str = "length_bin",
                edges: list[float] | None = None) -> DataFrame:
    """Quantile bins with duplicate edges dropped, right-closed, lowest included.

    The edges are q+1 scalars, fitted by one aggregate and applied as a
    literal array (no join).
    """
    edges = edges if edges is not None else length_bin_edges(groups, col, q)
    arr = F.array(*[F.lit(float(e)) for e in edges])
    x = F.col(col).cast("double")
    below = F.size(F.filter(arr, lambda e: e < x))
    return groups.withColumn(out, F.greatest(below - 1, F.lit(0)).cast("int"))


def hash_order(seed: int, key: str = "pid") -> Column:
    """Reproducible pseudo-random order: md5 of 'seed|key' (same text in SQL)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def stratified_split(groups: DataFrame, stratum: str, val: float = 0.1, test: float = 0.1,
                     seed: int = 42, key: str = "pid", out: str = "split") -> DataFrame:
    """Per stratum of n groups: n_test = max(1, round_half_even(n*test)) first
    groups in hash order are 'test', the next n_val 'val', the rest 'train'.

    Ranks inside a stratum come from (stratum, 2 hex digits of the hash)
    buckets, so a large stratum is ranked by up to 256 tasks.
    """
    g = groups.withColumn("_h", hash_order(seed, key)).withColumn("_hb", F.substring("_h", 1, 2))
    r = ordered_index(g, partition_by=[stratum], bucket=["_hb"], bucket_order=[F.col("_hb")],
                      row_order=[F.col("_h"), F.col(key)], index_col="_rank")
    n = groups.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    n = n.select(stratum,
                 F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(float(test)), 0)).cast("long").alias("_nt"),
                 F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(float(val)), 0)).cast("long").alias("_nv"))
    j = r.join(n.withColumnRenamed(stratum, "_stratum"), F.col(stratum).eqNullSafe(F.col("_stratum")), "inner").drop("_stratum")
    lab = (F.when(F.col("_rank") < F.col("_nt"), "test")
           .when(F.col("_rank") < F.col("_nt") + F.col("_nv"), "val").otherwise("train"))
    return j.withColumn(out, lab).drop("_h", "_hb", "_rank", "_nt", "_nv")


def eval_sample(groups: DataFrame, max_eval: int = 5000, seed: int = 42, key: str = "pid") -> DataFrame:
    """At most ``max_eval`` groups, the first in hash order (a sampling operator:
    the limit is the feature). Planned as a per-partition top-k + merge."""
    return groups.withColumn("_h", hash_order(seed, key)).orderBy("_h", key).limit(max_eval).drop("_h")


def split_point(n, ratio: float = 0.8) -> Column:
    """sp = max(1, floor(n * ratio))."""
    c = F.col(n) if isinstance(n, str) else n
    return F.greatest(F.lit(1), F.floor(c * F.lit(float(ratio)))).cast("long")


def map_unknown(c, vocab_limit: int | None) -> Column:
    """idx < V ? idx : UNK (= V + 1); PAD is V."""
    col = F.col(c) if isinstance(c, str) else c
    if vocab_limit is None:
        return col
    return F.when(col < vocab_limit, col).otherwise(F.lit(vocab_limit + 1)).cast("int")


def eligibility(groups: DataFrame, rule: str = "sequence", ratio: float = 0.8,
                n: str = "seq_len") -> DataFrame:
    """Add sp and the skip reason: 'sequence' skips when sp >= n-1; 'min5'
    skips when n < 5. NULL reason = evaluated."""
    sp = split_point(n, ratio)
    if rule == "sequence":
        reason = F.when(sp >= F.col(n) - 1, F.lit("short"))
    else:
        reason = F.when(F.col(n) < 5, F.lit("short"))
    return groups.withColumn("sp", sp).withColumn("skip_reason", reason)


def seed_holdout(seqs: DataFrame, groups: DataFrame, item: str = "track_idx",
                 max_seed: int | None = None, vocab_limit: int | None = None,
                 rule: str = "sequence", ratio: float = 0.8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split each evaluated group at sp.

    Returns (seeds, holdout, evaluated):
      seeds    (pid, pos, item): pos < sp, only the last ``max_seed`` kept
      holdout  (pid, item): distinct items at pos >= sp, UNK removed
      evaluated (pid, seq_len, sp, n_holdout, next_item): groups with a
               non-empty holdout that pass the eligibility rule
    """
    g = eligibility(groups.select("pid", "seq_len"), rule, ratio).where(F.col("skip_reason").isNull())
    s = seqs.select("pid", "pos", F.col(item)).join(g.select("pid", "sp"), "pid", "inner")
    s = s.withColumn(item, map_unknown(item, vocab_limit))
    seeds = s.where(F.col("pos") < F.col("sp"))
    if max_seed is not None:
        seeds = seeds.where(F.col("pos") >= F.col("sp") - max_seed)
    tail = s.where(F.col("pos") >= F.col("sp"))
    nxt = tail.where(F.col("pos") == F.col("sp")).select("pid", F.col(item).alias("next_item"))
    hold = tail
    if vocab_limit is not None:
        hold = hold.where(F.col(item) != F.lit(vocab_limit + 1))
    hold = hold.select("pid", item).distinct()
    nh = hold.groupBy("pid").agg(F.count(F.lit(1)).cast("long").alias("n_holdout"))
    evaluated = g.join(nh, "pid", "inner").join(nxt, "pid", "left").select(
        "pid", "seq_len", "sp", "n_holdout", "next_item")
    seeds = seeds.join(evaluated.select("pid"), "pid", "left_semi").select("pid", "pos", item)
    return seeds, hold, evaluated


def next_item_frames(seqs: DataFrame, vocab_limit: int, max_len: int = 50,
                     item: str = "track_idx") -> DataFrame:
    """Training frames for next-item learning, in long form.

    Items are UNK-mapped, each sequence is cut to its first ``max_len + 1``
    items, sequences shorter than 2 are dropped, and position t gets the
    input s[t] and the target s[t+1]. Positions t in [len-1, max_len) are
    padding rows (input = target = PAD, mask true), i.e. every frame has
    exactly ``max_len`` rows.
    """
    pad = vocab_limit
    s = seqs.where(F.col("pos") <= max_len).select("pid", "pos", map_unknown(item, vocab_limit).alias("x"))
    # at most max_len + 1 rows per group remain, so a per-group window is bounded
    w = Window.partitionBy("pid").orderBy("pos")
    s = s.withColumn("target", F.lead("x").over(w)).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy("pid")))
    s = s.where(F.col("_n") >= 2)
    cur = s.where(F.col("target").isNotNull()).select(
        "pid", F.col("pos").alias("t"), F.col("x").alias("input"), "target",
        F.lit(False).alias("pad_mask"))
    n = s.where(F.col("pos") == 0).select("pid", "_n")
    pads = n.where(F.col("_n") - 1 < max_len).select(
        "pid", F.explode(F.sequence(F.col("_n") - 1, F.lit(max_len - 1).cast("long"))).alias("t")).select(
        "pid", F.col("t").cast("long"), F.lit(pad).cast("int").alias("input"),
        F.lit(pad).cast("int").alias("target"), F.lit(True).alias("pad_mask"))
    return cur.unionByName(pads)


def sequence_arrays(seqs: DataFrame, item: str = "track_idx", chunk: int | None = None) -> DataFrame:
    """Typed sequence sink form: ``pid int, track_idxs array<int>, seq_len int``.

    With ``chunk`` every output row holds at most ``chunk`` consecutive items
    (column ``chunk`` added), so no row grows with the group; without it the
    whole sequence is one array, as in the reference's file format.
    """
    d = seqs.withColumn("_c", F.floor(F.col("pos") / chunk) if chunk else F.lit(0))
    n = group_sizes(seqs)
    arr = d.groupBy("pid", "_c").agg(F.array_sort(F.collect_list(F.struct("pos", F.col(item).cast("int").alias("x")))).alias("_a"))
    out = arr.join(n, "pid").select(
        F.col("pid").cast("int").alias("pid"), *([F.col("_c").cast("int").alias("chunk")] if chunk else []),
        F.transform("_a", lambda s: s["x"]).alias("track_idxs"), F.col("seq_len").cast("int").alias("seq_len"))
    return out
