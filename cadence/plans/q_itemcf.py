"""Popularity, co-occurrence and item-item CF queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import evaluate as EV
from cadence.operators import recommend as R
from cadence.operators import sequences as S
from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.registry import register
from cadence.sources.fixtures import stage, tables

META_CTE = """
, meta AS (SELECT track_uri, track_name, artist_uri, artist_name, album_uri, album_name, track_dur_ms
           FROM (SELECT *, row_number() OVER (PARTITION BY track_uri ORDER BY pid, pos) AS _rn FROM tracks)
           WHERE _rn = 1)
"""
COOC_CTE = """
, _u AS (SELECT DISTINCT pid, track_idx FROM train WHERE pos < 50)
, _half AS (SELECT a.track_idx AS item, b.track_idx AS neighbour, CAST(count(*) AS BIGINT) AS cnt
            FROM _u a JOIN _u b ON a.pid = b.pid AND a.track_idx < b.track_idx
            GROUP BY 1, 2 HAVING count(*) >= 3)
, cooc AS (SELECT item, neighbour, cnt FROM _half UNION ALL SELECT neighbour, item, cnt FROM _half)
, nbrs AS (SELECT item, neighbour, cnt, rnk FROM (
             SELECT *, row_number() OVER (PARTITION BY item ORDER BY cnt DESC, neighbour) AS rnk FROM cooc)
           WHERE rnk <= 100)
"""
WHOLE_COOC_CTE = COOC_CTE.replace(" WHERE pos < 50", "")
CF_CTE = C.SPLIT_CTE + COOC_CTE + C.seed_holdout_cte() + """
, _sc AS (SELECT s.pid, n.neighbour AS item, CAST(count(*) AS BIGINT) AS score
          FROM seeds s JOIN nbrs n ON s.track_idx = n.item GROUP BY 1, 2)
, _cand AS (SELECT * FROM _sc c WHERE NOT EXISTS (
              SELECT 1 FROM seeds s WHERE s.pid = c.pid AND s.track_idx = c.item))
, recs AS (SELECT pid, item, score, rank FROM (
             SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, item) AS rank FROM _cand)
           WHERE rank <= 20)
"""
WHOLE_CF_CTE = CF_CTE.replace(COOC_CTE, WHOLE_COOC_CTE)


def track_meta(spark, sf_dir):
    return R.track_meta(tables(spark, sf_dir).tracks())


def neighbours(spark, sf_dir):
    return C.memo(spark, sf_dir, "neighbours", lambda: R.neighbours(
        R.cooccurrence(C.split_seqs(spark, sf_dir, "train"), 50, 3), 100))


def neighbours_whole(spark, sf_dir):
    """Neighbours by the pairs of whole groups."""
    return C.memo(spark, sf_dir, "neighbours_whole", lambda: R.neighbours(q_cooc_whole(spark, sf_dir), 100))


def itemcf_parts(spark, sf_dir, k=20, nbrs=None):
    def build():
        seqs = C.split_seqs(spark, sf_dir, "test")
        groups = C.split_groups(spark, sf_dir, "test")
        return S.seed_holdout(seqs, groups)
    seeds, hold, ev = C.staged_split(spark, sf_dir, "cf_seed_holdout", build)
    recs = R.rec_itemcf(seeds, neighbours(spark, sf_dir) if nbrs is None else nbrs, k)
    return recs, hold, ev


@register("track_catalog", sql(META_CTE + "SELECT * FROM meta"))
def q_track_catalog(spark, sf_dir):
    return track_meta(spark, sf_dir)


@register("top_popular", sql(C.VOCAB_CTE + META_CTE + """
SELECT v.corpus_idx + 1 AS vocab_rank, v.track_uri, m.track_name, m.artist_name, v.corpus_idx, v.corpus_freq
FROM vocab v JOIN meta m USING (track_uri) ORDER BY v.corpus_freq DESC, v.corpus_idx LIMIT 10"""))
def q_top_popular(spark, sf_dir):
    return R.top_popular(C.vocab(spark, sf_dir), track_meta(spark, sf_dir), 10)


@register("cooccurrence", sql(C.SPLIT_CTE + COOC_CTE + "SELECT item, neighbour, cnt FROM cooc"))
def q_cooc(spark, sf_dir):
    return R.cooccurrence(C.split_seqs(spark, sf_dir, "train"), 50, 3)


@register("cooc_neighbours", sql(C.SPLIT_CTE + WHOLE_COOC_CTE + "SELECT item, neighbour, cnt, rnk FROM nbrs"))
def q_nbrs(spark, sf_dir):
    """The neighbours of an item among the pairs of whole groups."""
    return neighbours_whole(spark, sf_dir).select("item", "neighbour", "cnt", F.col("rnk").cast("long"))


@register("cooccurrence_whole", sql(C.SPLIT_CTE + WHOLE_COOC_CTE + "SELECT item, neighbour, cnt FROM cooc"))
def q_cooc_whole(spark, sf_dir):
    """Pairs of whole groups, not of their first 50 positions."""
    return R.cooccurrence(C.split_seqs(spark, sf_dir, "train"), None, 3, stage=stage)


@register("metrics_itemcf_whole", sql(WHOLE_CF_CTE + EV.metrics_sql()))
def q_metrics_itemcf_whole(spark, sf_dir):
    """The item-CF model on neighbours from whole groups."""
    return EV.ranking_metrics(*itemcf_parts(spark, sf_dir, nbrs=neighbours_whole(spark, sf_dir)))


@register("rec_itemcf", sql(WHOLE_CF_CTE + "SELECT pid, CAST(rank AS BIGINT) AS rank, item, score FROM recs"))
def q_rec_itemcf(spark, sf_dir):
    """Recommendations on neighbours from whole groups."""
    recs, _, _ = itemcf_parts(spark, sf_dir, nbrs=neighbours_whole(spark, sf_dir))
    return recs.select("pid", F.col("rank").cast("long"), "item", "score")


@register("metrics_itemcf", sql(CF_CTE + EV.metrics_sql()))
def q_metrics_itemcf(spark, sf_dir):
    return EV.ranking_metrics(*itemcf_parts(spark, sf_dir))


@register("metrics_per_group", sql(WHOLE_CF_CTE + EV.metrics_sql().split("SELECT CAST(count(*)")[0] + """
SELECT pid, n_holdout, hits_1, hits_5, hits_10, hits_20, next_hit_1, any_hit_1,
       round(hits_10 / 10.0, 9) AS p_at_10, round(hits_10 / n_holdout, 9) AS r_at_10 FROM _per"""))
def q_metrics_per_group(spark, sf_dir):
    """Per-group metric table of the item-CF model (the per-playlist CSV of the
    reference; write it with ``sources.slices.write_table(df, path, "csv")``), on neighbours from whole groups."""
    per = EV.per_group_hits(*itemcf_parts(spark, sf_dir, nbrs=neighbours_whole(spark, sf_dir)))
    return per.withColumn("p_at_10", F.round(F.col("hits_10") / 10.0, 9)).withColumn(
        "r_at_10", F.round(F.col("hits_10") / F.col("n_holdout"), 9))
