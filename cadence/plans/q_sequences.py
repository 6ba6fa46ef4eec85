"""Queries of the corpus / vocabulary / split / frames stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import sequences as S
from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.registry import register
from cadence.session import scratch_path, session_key
from cadence.sources import layout as LY
from cadence.sources.fixtures import tables
from cadence.sources.slices import write_table


@register("build_corpus", sql(C.CORPUS_CTE + "SELECT pid, pos, track_uri, seq_len FROM corpus"))
def q_build_corpus(spark, sf_dir):
    return C.corpus(spark, sf_dir).select("pid", "pos", "track_uri", "seq_len")


@register("corpus_report", sql("""
, _sz AS (SELECT pid, count(*) AS n FROM tracks GROUP BY pid)
SELECT CAST(count(*) AS BIGINT) AS n_before, CAST(sum(CASE WHEN n >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_after,
       CAST(count(*) - sum(CASE WHEN n >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped FROM _sz"""))
def q_corpus_report(spark, sf_dir):
    return S.corpus_report(tables(spark, sf_dir).tracks(), C.MIN_LEN)


@register("vocabulary", sql(C.VOCAB_CTE + "SELECT track_uri, corpus_idx, corpus_freq FROM vocab"))
def q_vocabulary(spark, sf_dir):
    return C.vocab(spark, sf_dir)


@register("encode_sequences", sql(C.ENC_CTE + "SELECT pid, pos, track_idx, seq_len FROM enc"))
def q_encode(spark, sf_dir):
    return C.encoded(spark, sf_dir).select("pid", "pos", "track_idx", "seq_len")


@register("length_bins", sql(C.SPLIT_CTE + "SELECT pid, seq_len, length_bin FROM bins"))
def q_length_bins(spark, sf_dir):
    g = S.group_sizes(C.corpus(spark, sf_dir))
    return S.length_bins(g, "seq_len", 10).select("pid", "seq_len", "length_bin")


@register("stratified_split", sql(C.SPLIT_CTE + "SELECT pid, seq_len, length_bin, split FROM gsplit"))
def q_split(spark, sf_dir):
    return C.groups_split(spark, sf_dir).select("pid", "seq_len", "length_bin", "split")


@register("eval_sample", sql(C.SPLIT_CTE + """
SELECT pid, seq_len FROM test_groups ORDER BY md5('42|' || CAST(pid AS VARCHAR)), pid LIMIT 5000"""))
def q_eval_sample(spark, sf_dir):
    return S.eval_sample(C.split_groups(spark, sf_dir, "test"), 5000, C.SEED)


@register("seed_holdout", sql(C.SPLIT_CTE + C.seed_holdout_cte(
    max_seed=50) + """
SELECT pid, 'seed' AS role, pos, track_idx FROM seeds
UNION ALL
SELECT h.pid, 'holdout' AS role, CAST(min(s.pos) AS BIGINT) AS pos, h.track_idx
FROM holdout h JOIN _s s ON s.pid = h.pid AND s.track_idx = h.track_idx AND s.pos >= s.sp
GROUP BY h.pid, h.track_idx"""))
def q_seed_holdout(spark, sf_dir):
    seqs = C.split_seqs(spark, sf_dir, "test")
    groups = C.split_groups(spark, sf_dir, "test")
    seeds, hold, ev = S.seed_holdout(seqs, groups, max_seed=50)
    # first holdout position of each distinct holdout item
    tail = seqs.join(ev.select("pid", "sp"), "pid").where(F.col("pos") >= F.col("sp"))
    hpos = tail.join(hold, ["pid", "track_idx"], "left_semi").groupBy("pid", "track_idx") \
        .agg(F.min("pos").alias("pos"))
    return seeds.select("pid", F.lit("seed").alias("role"), "pos", "track_idx").unionByName(
        hpos.select("pid", F.lit("holdout").alias("role"), F.col("pos").cast("long"), "track_idx"))


def stored(spark, sf_dir):
    """The encoded sequences in their bucketed layout, written once per session and data folder."""
    key = (session_key(spark), sf_dir, "bucketed_sequences")
    if key not in C._MEMO:
        path = scratch_path(spark, "sequences")
        C._MEMO[key] = LY.write_bucketed(C.encoded(spark, sf_dir), C.groups_split(spark, sf_dir), path.rsplit("/", 1)[1].replace("-", "_"), path,
                                         int(spark.conf.get("spark.sql.shuffle.partitions")))
    return C._MEMO[key]


@register("stored_seed_holdout", sql(C.SPLIT_CTE + """
SELECT t.pid, t.pos, t.track_idx, CASE WHEN t.pos < greatest(1, CAST(floor(g.seq_len * 0.8::DOUBLE) AS BIGINT)) THEN 'seed' ELSE 'holdout' END AS role
FROM test t JOIN test_groups g USING (pid)"""))
def q_stored_seed_holdout(spark, sf_dir):
    """Every entry of the test groups with its role, from the bucketed layout."""
    s = LY.with_split_point(stored(spark, sf_dir).where("split = 'test'"), C.split_groups(spark, sf_dir, "test"))
    return s.select("pid", "pos", "track_idx", F.when(F.col("pos") < F.col("sp"), "seed").otherwise("holdout").alias("role"))


@register("stored_lag_pairs", sql(C.SPLIT_CTE + """
SELECT CAST(l.lag AS INTEGER) AS lag, a.track_idx AS input, b.track_idx AS target, CAST(count(*) AS BIGINT) AS cnt
FROM train a CROSS JOIN (VALUES (1), (2), (3)) l(lag) JOIN train b ON a.pid = b.pid AND b.pos = a.pos + l.lag GROUP BY 1, 2, 3"""))
def q_stored_lag_pairs(spark, sf_dir):
    """Counts of the pairs 1 to 3 positions apart, from the bucketed layout."""
    p = LY.stored_pairs(stored(spark, sf_dir).where("split = 'train'"), 3)
    return p.groupBy("lag", "input", "target").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


def _elig_sql(rule):
    sp = "greatest(1, CAST(floor(seq_len * 0.8::DOUBLE) AS BIGINT))"
    skip = f"{sp} >= seq_len - 1" if rule == "sequence" else "seq_len < 5"
    return f"""
SELECT '{rule}' AS rule, reason, CAST(count(*) AS BIGINT) AS n_groups FROM (
  SELECT g.pid, CASE WHEN {skip} THEN 'short'
                     WHEN NOT EXISTS (SELECT 1 FROM test t WHERE t.pid = g.pid AND t.pos >= {sp}) THEN 'empty_holdout'
                     ELSE 'evaluated' END AS reason
  FROM test_groups g) GROUP BY reason"""


@register("eval_eligibility", sql(C.SPLIT_CTE + _elig_sql("sequence") + " UNION ALL " + _elig_sql("min5")))
def q_eligibility(spark, sf_dir):
    seqs = C.split_seqs(spark, sf_dir, "test")
    groups = C.split_groups(spark, sf_dir, "test")
    out = None
    for rule in ("sequence", "min5"):
        g = S.eligibility(groups, rule)
        known = seqs.join(g.select("pid", "sp"), "pid").where(
            F.col("pos") >= F.col("sp")).select("pid").distinct()
        r = g.join(known.withColumn("_k", F.lit(True)), "pid", "left").select(
            F.lit(rule).alias("rule"),
            F.when(F.col("skip_reason").isNotNull(), F.col("skip_reason"))
            .when(F.col("_k").isNull(), F.lit("empty_holdout")).otherwise(F.lit("evaluated")).alias("reason"))
        r = r.groupBy("rule", "reason").agg(F.count(F.lit(1)).cast("long").alias("n_groups"))
        out = r if out is None else out.unionByName(r)
    return out


@register("next_item_frames", sql(C.SPLIT_CTE + f"""
, _x AS (SELECT pid, pos, CAST(CASE WHEN track_idx < {C.VOCAB_LIMIT} THEN track_idx ELSE {C.VOCAB_LIMIT + 1} END AS INTEGER) AS x
         FROM train WHERE pos <= 50)
, _n AS (SELECT pid, count(*) AS n FROM _x GROUP BY pid HAVING count(*) >= 2)
SELECT a.pid, a.pos AS t, a.x AS input, b.x AS target, false AS pad_mask
FROM _x a JOIN _x b ON a.pid = b.pid AND b.pos = a.pos + 1 JOIN _n ON _n.pid = a.pid
UNION ALL
SELECT n.pid, CAST(t.t AS BIGINT) AS t, {C.VOCAB_LIMIT} AS input, {C.VOCAB_LIMIT} AS target, true AS pad_mask
FROM _n n, range(0, 50) t(t) WHERE t.t >= n.n - 1"""))
def q_frames(spark, sf_dir):
    return S.next_item_frames(C.split_seqs(spark, sf_dir, "train"), C.VOCAB_LIMIT, 50)


@register("sequence_sink", sql(C.ENC_CTE + """
SELECT CAST(pid AS INTEGER) AS pid, CAST(pos // 50 AS INTEGER) AS chunk, string_agg(CAST(track_idx AS VARCHAR), ' ' ORDER BY pos) AS items,
       CAST(count(*) AS BIGINT) AS n_items, CAST(max(seq_len) AS INTEGER) AS seq_len FROM enc GROUP BY pid, pos // 50"""))
def q_sequence_sink(spark, sf_dir):
    """Typed sequence arrays, at most 50 items a row, through the Parquet sink and back."""
    arrays = S.sequence_arrays(C.encoded(spark, sf_dir), chunk=50)
    path = scratch_path(spark, "sequences")
    write_table(arrays, path)
    back = spark.read.schema("pid int, chunk int, track_idxs array<int>, seq_len int").parquet(path)
    return back.select("pid", "chunk", F.array_join(F.transform("track_idxs", lambda x: x.cast("string")), " ").alias("items"),
                       F.size("track_idxs").cast("long").alias("n_items"), "seq_len")
