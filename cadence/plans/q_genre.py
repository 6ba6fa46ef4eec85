"""Keyword labels and the label (genre) popularity recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.text import keyword_label, keyword_label_words, normalize_title
from cadence.operators import evaluate as EV
from cadence.operators import recommend as R
from cadence.operators import sequences as S
from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.registry import register
from cadence.sources.fixtures import tables
from cadence.functions.text import GENRE_KEYWORDS, TITLE_PUNCTUATION

K = 20


def _sql_norm(c: str) -> str:
    cls = "".join("\\" + ch if ch in "^[]\\-" else ch for ch in TITLE_PUNCTUATION)
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[{cls}]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _sql_label(c: str) -> str:
    whens = []
    for label, kws in GENRE_KEYWORDS.items():
        cond = " OR ".join(f"contains({c}, '{kw}')" for kw in kws)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + " ELSE 'unknown' END"


LABEL_CTE = f"""
, _norm AS (SELECT pid, name, {_sql_norm('name')} AS name_norm FROM playlists)
, glabel AS (SELECT pid, name, name_norm, {_sql_label('name_norm')} AS genre FROM _norm)
"""
GENRE_CTE = """
, labelled AS (SELECT p.pid, g.genre FROM playlists p JOIN playlist_genres g USING (pid) WHERE p.num_tracks >= 50)
, _gr AS (SELECT pid, genre, row_number() OVER (PARTITION BY genre
             ORDER BY md5('42|' || CAST(pid AS VARCHAR)), pid) - 1 AS _rk,
             count(*) OVER (PARTITION BY genre) AS _n FROM labelled)
, lsplit AS (SELECT pid, genre,
               CASE WHEN _rk < greatest(1, round_even(_n * 0.1::DOUBLE, 0)) THEN 'test'
                    WHEN _rk < greatest(1, round_even(_n * 0.1::DOUBLE, 0))
                             + greatest(1, round_even(_n * 0.1::DOUBLE, 0)) THEN 'val'
                    ELSE 'train' END AS split FROM _gr)
, gcounts AS (SELECT t.track_uri, s.genre, CAST(count(*) AS BIGINT) AS cnt
              FROM tracks t JOIN lsplit s USING (pid) WHERE s.split = 'train' GROUP BY 1, 2)
, tvote AS (SELECT track_uri, genre, cnt AS genre_count FROM (
              SELECT *, row_number() OVER (PARTITION BY track_uri ORDER BY cnt DESC, genre) AS _r FROM gcounts)
            WHERE _r = 1)
, gpop AS (SELECT genre, CAST(row_number() OVER (PARTITION BY genre ORDER BY cnt DESC, track_uri) AS BIGINT) AS rank,
                  track_uri, cnt FROM gcounts)
, gtest AS (SELECT t.pid, t.pos, t.track_uri FROM tracks t JOIN lsplit s USING (pid) WHERE s.split = 'test')
, gtest_groups AS (SELECT pid, CAST(count(*) AS BIGINT) AS seq_len FROM gtest GROUP BY pid)
""" + C.seed_holdout_cte("gtest", "gtest_groups", rule="min5", item="track_uri") + f"""
, _votes AS (SELECT s.pid, v.genre, count(*) AS _c FROM seeds s JOIN tvote v USING (track_uri) GROUP BY 1, 2)
, inferred AS (SELECT e.pid, coalesce(x.genre, 'unknown') AS inferred FROM evaluated e LEFT JOIN (
                 SELECT pid, genre FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY _c DESC, genre) AS _r
                                         FROM _votes) WHERE _r = 1) x USING (pid))
, _seen AS (SELECT DISTINCT pid, track_uri FROM seeds)
, _ns AS (SELECT pid, count(*) AS _ns FROM _seen GROUP BY pid)
, _gc AS (SELECT i.pid, p.rank AS _gr, p.track_uri AS item, p.cnt AS score
          FROM inferred i JOIN _ns n USING (pid) JOIN gpop p ON p.genre = i.inferred AND p.rank <= n._ns + {K}
          WHERE i.inferred <> 'unknown' AND NOT EXISTS (
            SELECT 1 FROM _seen s WHERE s.pid = i.pid AND s.track_uri = p.track_uri))
, recs AS (SELECT pid, item, score, rank FROM (
             SELECT pid, item, score, row_number() OVER (PARTITION BY pid ORDER BY _gr) AS rank FROM _gc)
           WHERE rank <= {K})
, evaluated_l AS (SELECT e.*, l.genre, CASE WHEN i.inferred = l.genre THEN 1 ELSE 0 END AS genre_hit
                  FROM evaluated e JOIN lsplit l USING (pid) JOIN inferred i USING (pid))
"""


def labelled(spark, sf_dir):
    t = tables(spark, sf_dir)
    return R.filter_labelled(t.playlists(), t.playlist_genres(), 50)


def label_split(spark, sf_dir):
    return C.memo(spark, sf_dir, "label_split", lambda: S.stratified_split(
        labelled(spark, sf_dir), "genre", 0.1, 0.1, C.SEED))


def genre_counts(spark, sf_dir):
    def build():
        sp = label_split(spark, sf_dir).where(F.col("split") == "train").select("pid", "genre")
        return R.track_label_counts(tables(spark, sf_dir).tracks(), sp)
    return C.memo(spark, sf_dir, "genre_counts", build)


def genre_parts(spark, sf_dir):
    t = tables(spark, sf_dir)
    test = label_split(spark, sf_dir).where(F.col("split") == "test").select("pid", "genre")

    def build():
        seqs = t.tracks().select("pid", "pos", "track_uri").join(test.select("pid"), "pid", "left_semi")
        return S.seed_holdout(seqs, S.group_sizes(seqs), item="track_uri", rule="min5")
    seeds, hold, ev = C.staged_split(spark, sf_dir, "genre_seed_holdout", build)
    counts = genre_counts(spark, sf_dir)
    inferred = R.infer_label(seeds, R.majority_label(counts), ev)
    recs = R.rec_by_label(seeds, inferred, R.label_popularity(counts), K)
    ev_l = ev.join(test, "pid").join(inferred, "pid").withColumn(
        "genre_hit", (F.col("inferred") == F.col("genre")).cast("int"))
    return recs, hold, ev_l, inferred


@register("normalize_titles", sql(f"""
SELECT 'playlist' AS source, pid AS id, name AS text, {_sql_norm('name')} AS text_norm FROM playlists
UNION ALL
SELECT 'document' AS source, doc_id AS id, text, {_sql_norm('text')} AS text_norm FROM documents"""))
def q_normalize_titles(spark, sf_dir):
    t = tables(spark, sf_dir)
    p = t.playlists().select(F.lit("playlist").alias("source"), F.col("pid").alias("id"),
                             F.col("name").alias("text"))
    d = t.documents().select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text")
    return p.unionByName(d).withColumn("text_norm", normalize_title("text"))


def glabel(spark, sf_dir):
    p = tables(spark, sf_dir).playlists().select("pid", "name").withColumn("name_norm", normalize_title("name"))
    return p.withColumn("genre", keyword_label("name_norm"))


@register("genre_label", sql(LABEL_CTE + "SELECT pid, name, name_norm, genre FROM glabel"))
def q_genre_label(spark, sf_dir):
    return glabel(spark, sf_dir)


def _sql_label_words(c: str) -> str:
    whens = []
    for label, kws in GENRE_KEYWORDS.items():
        cond = " OR ".join(f"contains(' ' || {c} || ' ', ' {kw} ')" for kw in kws)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + " ELSE 'unknown' END"


@register("genre_label_words", sql(LABEL_CTE + f"""
, _d AS (SELECT doc_id, {_sql_norm('text')} AS text_norm FROM documents)
SELECT 'playlist' AS source, pid AS id, {_sql_label_words('name_norm')} AS genre FROM _norm
UNION ALL SELECT 'document', doc_id, {_sql_label_words('text_norm')} FROM _d"""))
def q_genre_label_words(spark, sf_dir):
    """Labels by keywords that stand as whole words, of titles and of long texts."""
    t = tables(spark, sf_dir)
    p = t.playlists().select(F.lit("playlist").alias("source"), F.col("pid").alias("id"), F.col("name").alias("text"))
    d = t.documents().select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text")
    return p.unionByName(d).select("source", "id", keyword_label_words(normalize_title("text")).alias("genre"))


@register("genre_distribution", sql(LABEL_CTE + """
, _c AS (SELECT genre, CAST(count(*) AS BIGINT) AS n FROM glabel GROUP BY genre)
, _t AS (SELECT sum(n) AS total, sum(CASE WHEN genre <> 'unknown' THEN n ELSE 0 END) AS lab FROM _c)
SELECT genre, n, round(100.0 * n / total, 9) AS pct FROM _c, _t
UNION ALL SELECT 'labeled', CAST(lab AS BIGINT), round(100.0 * lab / total, 9) FROM _t
UNION ALL SELECT 'total', CAST(total AS BIGINT), 100.0 FROM _t"""))
def q_genre_distribution(spark, sf_dir):
    from cadence.operators.profile import distribution
    return distribution(glabel(spark, sf_dir), "genre", unknown="unknown")


@register("filter_labelled", sql(GENRE_CTE + "SELECT pid, genre FROM labelled"))
def q_filter_labelled(spark, sf_dir):
    return labelled(spark, sf_dir)


@register("genre_split", sql(GENRE_CTE + "SELECT pid, genre, split FROM lsplit"))
def q_genre_split(spark, sf_dir):
    return label_split(spark, sf_dir).select("pid", "genre", "split")


@register("track_genre_vote", sql(GENRE_CTE + "SELECT track_uri, genre, genre_count FROM tvote"))
def q_track_genre_vote(spark, sf_dir):
    return R.majority_label(genre_counts(spark, sf_dir))


@register("genre_popularity", sql(GENRE_CTE + """
, _meta AS (SELECT track_uri, track_name, artist_name FROM (
              SELECT *, row_number() OVER (PARTITION BY track_uri ORDER BY pid, pos) AS _r FROM tracks) WHERE _r = 1)
SELECT p.genre, p.rank, p.track_uri, p.cnt, m.track_name, m.artist_name FROM gpop p LEFT JOIN _meta m USING (track_uri)"""))
def q_genre_popularity(spark, sf_dir):
    pop = R.label_popularity(genre_counts(spark, sf_dir))
    meta = R.track_meta(tables(spark, sf_dir).tracks()).select("track_uri", "track_name", "artist_name")
    return pop.join(meta, "track_uri", "left").select("genre", "rank", "track_uri", "cnt",
                                                      "track_name", "artist_name")


@register("infer_genre", sql(GENRE_CTE + "SELECT i.pid, i.inferred, l.genre FROM inferred i JOIN lsplit l USING (pid)"))
def q_infer_genre(spark, sf_dir):
    _, _, ev_l, _ = genre_parts(spark, sf_dir)
    return ev_l.select("pid", "inferred", "genre")


@register("infer_genre_sampled", sql(GENRE_CTE + """
, _ss AS (SELECT pid, track_uri FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY md5('42|' || pid || '|' || pos), pos) AS _k FROM seeds) WHERE _k <= 25)
, _sv AS (SELECT s.pid, v.genre, count(*) AS _c FROM _ss s JOIN tvote v USING (track_uri) GROUP BY 1, 2)
SELECT e.pid, coalesce(x.genre, 'unknown') AS inferred FROM evaluated e LEFT JOIN (
  SELECT pid, genre FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY _c DESC, genre) AS _r FROM _sv) WHERE _r = 1) x USING (pid)"""))
def q_infer_genre_sampled(spark, sf_dir):
    """Labels from 25 seed entries of each group, in hash order."""
    genre_parts(spark, sf_dir)
    seeds, _, ev = C.staged_split(spark, sf_dir, "genre_seed_holdout", None)
    return R.infer_label(seeds, R.majority_label(genre_counts(spark, sf_dir)), ev, sample_n=25)


@register("rec_genre", sql(GENRE_CTE + "SELECT pid, CAST(rank AS BIGINT) AS rank, item, score FROM recs"))
def q_rec_genre(spark, sf_dir):
    recs, _, _, _ = genre_parts(spark, sf_dir)
    return recs.select("pid", F.col("rank").cast("long"), "item", "score")


@register("metrics_genre", sql(GENRE_CTE + EV.metrics_sql(
    evaluated="evaluated_l", item="track_uri", carry=("genre_hit",),
    extra_sel=("round(avg(genre_hit), 9) AS genre_accuracy",))))
def q_metrics_genre(spark, sf_dir):
    recs, hold, ev_l, _ = genre_parts(spark, sf_dir)
    per = EV.per_group_hits(recs, hold, ev_l, item="track_uri").join(ev_l.select("pid", "genre_hit"), "pid")
    return EV.summarize(per, extra=[F.round(F.avg("genre_hit"), 9).alias("genre_accuracy")])


@register("metrics_by_genre", sql(GENRE_CTE + EV.metrics_sql(
    evaluated="evaluated_l", item="track_uri", by="genre", ks=(10,), base=False)))
def q_metrics_by_genre(spark, sf_dir):
    recs, hold, ev_l, _ = genre_parts(spark, sf_dir)
    per = EV.per_group_hits(recs, hold, ev_l, ks=(10,), item="track_uri").join(ev_l.select("pid", "genre"), "pid")
    return EV.summarize(per, ks=(10,), by="genre", base=False).orderBy(F.col("r_at_10").desc(), "genre")
