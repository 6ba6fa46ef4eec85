"""Profiling queries over the canonical tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.text import epoch_date, normalize_title
from cadence.operators import profile as P
from cadence.operators.quantiles import exact_quantiles
from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.q_genre import _sql_norm
from cadence.plans.registry import register
from cadence.sources.fixtures import N_FEATURES, tables

STAT_COLS = ["num_tracks", "num_artists", "num_albums", "num_followers", "num_edits", "duration_ms"]
FEATS = [f"f{i}" for i in range(N_FEATURES)]
SEP = "  –  "


def _long_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS x FROM {table}" for c in cols)


@register("dataset_totals", sql(f"""
, _p AS (SELECT count(*) AS n_playlists, count(DISTINCT name) AS n_titles,
                count(DISTINCT {_sql_norm('name')}) AS n_titles_norm,
                sum(CASE WHEN has_desc THEN 1 ELSE 0 END) AS n_with_desc,
                round(avg(num_followers), 9) AS mean_followers FROM playlists)
, _t AS (SELECT count(*) AS n_entries, count(DISTINCT track_uri) AS n_tracks, count(DISTINCT album_uri) AS n_albums,
                count(DISTINCT artist_uri) AS n_artists, count(DISTINCT pid) AS n_groups,
                round(avg(track_dur_ms), 9) AS mean_track_dur_ms,
                round(count(*) / count(DISTINCT pid), 9) AS mean_len FROM tracks)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  UNPIVOT _p ON n_playlists, n_titles, n_titles_norm, n_with_desc, mean_followers INTO NAME metric VALUE value)
UNION ALL
SELECT metric, CAST(value AS DOUBLE) FROM (
  UNPIVOT _t ON n_entries, n_tracks, n_albums, n_artists, n_groups, mean_track_dur_ms, mean_len
  INTO NAME metric VALUE value)"""))
def q_totals(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.totals_long(t.playlists(), t.tracks(), normalize_title("name"))


@register("value_histograms", sql(f"""
, _v AS (
  SELECT 'title' AS histogram, {_sql_norm('name')} AS value FROM playlists
  UNION ALL SELECT 'track', track_name || ' by ' || artist_name FROM tracks
  UNION ALL SELECT 'artist', artist_name FROM tracks
  UNION ALL SELECT 'num_edits', CAST(num_edits AS VARCHAR) FROM playlists
  UNION ALL SELECT 'modified', CAST(DATE '1970-01-01' + CAST(floor(modified_at / 86400) AS INTEGER) AS VARCHAR)
            FROM playlists
  UNION ALL SELECT 'length', CAST(num_tracks AS VARCHAR) FROM playlists
  UNION ALL SELECT 'followers', CAST(num_followers AS VARCHAR) FROM playlists)
, _c AS (SELECT histogram, value, CAST(count(*) AS BIGINT) AS n FROM _v GROUP BY 1, 2)
SELECT histogram, value, n, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY histogram ORDER BY n DESC, value) AS BIGINT) AS rank FROM _c)
WHERE rank <= 20"""))
def q_value_histograms(spark, sf_dir):
    t = tables(spark, sf_dir)
    p, tr = t.playlists(), t.tracks()
    v = p.select(F.lit("title").alias("histogram"), normalize_title("name").alias("value"))
    v = v.unionByName(tr.select(F.lit("track").alias("histogram"),
                                F.concat_ws(" by ", "track_name", "artist_name").alias("value")))
    v = v.unionByName(tr.select(F.lit("artist").alias("histogram"), F.col("artist_name").alias("value")))
    for tag, c in (("num_edits", F.col("num_edits").cast("string")), ("modified", epoch_date("modified_at")),
                   ("length", F.col("num_tracks").cast("string")),
                   ("followers", F.col("num_followers").cast("string"))):
        v = v.unionByName(p.select(F.lit(tag).alias("histogram"), c.alias("value")))
    return P.top_values(v, "histogram", "value", 20)


@register("top_artists", sql("""
SELECT artist_uri, artist_name, CAST(count(*) AS BIGINT) AS n FROM tracks GROUP BY 1, 2
ORDER BY n DESC, artist_uri, artist_name LIMIT 10"""))
def q_top_artists(spark, sf_dir):
    return P.top_by_count(tables(spark, sf_dir).tracks(), ["artist_uri", "artist_name"], 10)


@register("top_albums", sql(f"""
SELECT album_uri, album_name, artist_name, CAST(count(*) AS BIGINT) AS n,
       substr(album_name, 1, 30) || '{SEP}' || substr(artist_name, 1, 20) AS label
FROM tracks GROUP BY 1, 2, 3 ORDER BY n DESC, album_uri, album_name, artist_name LIMIT 10"""))
def q_top_albums(spark, sf_dir):
    from cadence.functions.text import display_label
    r = P.top_by_count(tables(spark, sf_dir).tracks(), ["album_uri", "album_name", "artist_name"], 10)
    return r.withColumn("label", display_label("album_name", "artist_name", 30, 20, SEP))


@register("top_tracks", sql(f"""
SELECT track_uri, track_name, artist_name, CAST(count(*) AS BIGINT) AS n,
       CAST(count(DISTINCT pid) AS BIGINT) AS n_playlists,
       substr(track_name, 1, 30) || '{SEP}' || substr(artist_name, 1, 20) AS label
FROM tracks GROUP BY 1, 2, 3 ORDER BY n DESC, track_uri, track_name, artist_name LIMIT 20"""))
def q_top_tracks(spark, sf_dir):
    from cadence.functions.text import display_label
    r = P.top_by_count(tables(spark, sf_dir).tracks(), ["track_uri", "track_name", "artist_name"], 20,
                       extra_aggs=[F.countDistinct("pid").cast("long").alias("n_playlists")])
    return r.withColumn("label", display_label("track_name", "artist_name", 30, 20, SEP))


@register("top_names", sql(f"""
SELECT {_sql_norm('name')} AS name_norm, CAST(count(*) AS BIGINT) AS n FROM playlists GROUP BY 1
ORDER BY n DESC, name_norm LIMIT 20"""))
def q_top_names(spark, sf_dir):
    p = tables(spark, sf_dir).playlists().select(normalize_title("name").alias("name_norm"))
    return P.top_by_count(p, ["name_norm"], 20)


@register("trimmed_stats", sql(f"""
, _long AS ({_long_sql('playlists', STAT_COLS)})
, _b AS (SELECT variable, quantile_cont(x, 0.1) AS lo, quantile_cont(x, 0.9) AS hi FROM _long GROUP BY variable)
SELECT variable, round(median(x), 2) AS trimmed_median, round(avg(x), 2) AS trimmed_mean,
       round(stddev_samp(x), 2) AS trimmed_std, round(first(lo), 2) AS p_lo, round(first(hi), 2) AS p_hi
FROM _long JOIN _b USING (variable) WHERE x >= lo AND x <= hi GROUP BY variable"""))
def q_trimmed_stats(spark, sf_dir):
    return P.trimmed_stats(tables(spark, sf_dir).playlists(), STAT_COLS, 0.1, 0.9)


@register("corr_matrix", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM playlists"
    for a in STAT_COLS for b in STAT_COLS)))
def q_corr(spark, sf_dir):
    return P.corr_matrix(tables(spark, sf_dir).playlists(), STAT_COLS)


@register("feature_corr", sql(f"""
, _long AS (SELECT item, variable, x FROM (SELECT item, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATS)} FROM features)
            UNPIVOT (x FOR variable IN ({', '.join(FEATS)})))
SELECT a.variable AS a, b.variable AS b, round(corr(a.x, b.x), 9) AS r FROM _long a JOIN _long b USING (item) GROUP BY 1, 2"""))
def q_feature_corr(spark, sf_dir):
    """Correlation of all feature columns."""
    return P.gram_corr(tables(spark, sf_dir).features(), FEATS)


def _hist_sql(src: str, col: str, bins: int, lo: str, hi: str, by: str | None = None, where: str = "") -> str:
    """SQL mirror of profile.histogram: (by,) bin, n, bin_lo, bin_hi."""
    bsel = f"{by}, " if by else ""
    return f"""
SELECT {bsel}bin, CAST(count(*) AS BIGINT) AS n, _lo + bin * _w AS bin_lo, _lo + (bin + 1) * _w AS bin_hi FROM (
  SELECT {bsel}CAST(least(floor((CAST({col} AS DOUBLE) - _lo) / _w), {bins - 1}) AS INTEGER) AS bin, _lo, _w
  FROM {src}, (SELECT _lo, CASE WHEN _hi > _lo THEN (_hi - _lo) / {bins} ELSE 1.0 END AS _w FROM (
                 SELECT CAST({lo} AS DOUBLE) AS _lo, CAST({hi} AS DOUBLE) AS _hi))
  WHERE CAST({col} AS DOUBLE) >= _lo AND CAST({col} AS DOUBLE) <= CAST({hi} AS DOUBLE) {where})
GROUP BY {bsel}bin, _lo, _w"""


@register("length_hist", sql(C.SPLIT_CTE + """
SELECT 'playlists' AS hist, 'all' AS split, bin, n, bin_lo, bin_hi,
       CAST(NULL AS DOUBLE) AS density FROM (""" + _hist_sql(
    "playlists", "num_tracks", 50, "(SELECT CAST(min(num_tracks) AS DOUBLE) FROM playlists)",
    "(SELECT CAST(max(num_tracks) AS DOUBLE) FROM playlists)") + """)
UNION ALL
SELECT 'split' AS hist, split, bin, n, bin_lo, bin_hi,
       round(n / (sum(n) OVER (PARTITION BY split) * 5.0), 9) AS density FROM (""" + _hist_sql(
    "gsplit", "seq_len", 52, "0.0", "260.0", by="split") + ")"))
def q_length_hist(spark, sf_dir):
    p = P.histogram(tables(spark, sf_dir).playlists(), "num_tracks", 50)
    a = p.select(F.lit("playlists").alias("hist"), F.lit("all").alias("split"), "bin", "n", "bin_lo", "bin_hi",
                 F.lit(None).cast("double").alias("density"))
    s = P.histogram(C.groups_split(spark, sf_dir), "seq_len", 52, 0.0, 260.0, by="split")
    from pyspark.sql import Window
    s = s.withColumn("density", F.round(F.col("n") / (F.sum("n").over(Window.partitionBy("split")) * 5.0), 9))
    return a.unionByName(s.select(F.lit("split").alias("hist"), "split", "bin", "n", "bin_lo", "bin_hi", "density"))


@register("duration_hist", sql("""
, _d AS (SELECT track_dur_ms / 1000.0 AS s FROM tracks)
, _q AS (SELECT quantile_cont(s, 0.01) AS lo, quantile_cont(s, 0.99) AS hi FROM _d)
, _t AS (SELECT s FROM _d, _q WHERE s >= lo AND s <= hi)
, _m AS (SELECT min(s) AS lo, max(s) AS hi FROM _t)
SELECT bin, n, bin_lo, bin_hi,
       CAST(floor(bin_lo / 60) AS BIGINT) || ':' || lpad(CAST(CAST(floor(bin_lo) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS label
FROM (""" + _hist_sql("_t", "s", 60, "(SELECT lo FROM _m)", "(SELECT hi FROM _m)") + ")"))
def q_duration_hist(spark, sf_dir):
    d = tables(spark, sf_dir).tracks().select((F.col("track_dur_ms") / 1000.0).alias("s"))
    q = exact_quantiles(d, ["s"], [0.01, 0.99])[None, "s"]
    t = d.where((F.col("s") >= q[0]) & (F.col("s") <= q[1]))
    h = P.histogram(t, "s", 60)
    label = F.concat(F.floor(F.col("bin_lo") / 60).cast("long").cast("string"), F.lit(":"),
                     F.lpad((F.floor("bin_lo").cast("long") % 60).cast("string"), 2, "0"))
    return h.withColumn("label", label)


@register("feature_hist", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, * FROM (" + _hist_sql(
        "features", c, 50, f"(SELECT min({c}) FROM features)", f"(SELECT max({c}) FROM features)") + ")" for c in FEATS)))
def q_feature_hist(spark, sf_dir):
    return P.histograms(tables(spark, sf_dir).features(), FEATS, 50).withColumnRenamed("variable", "feature")


@register("feature_describe", sql(f"""
, _long AS ({_long_sql('features', FEATS)})
SELECT variable, CAST(count(x) AS BIGINT) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std,
       min(x) AS min, round(quantile_cont(x, 0.25), 9) AS p25, round(quantile_cont(x, 0.5), 9) AS p50,
       round(quantile_cont(x, 0.75), 9) AS p75, max(x) AS max
FROM _long WHERE x IS NOT NULL GROUP BY variable"""))
def q_feature_describe(spark, sf_dir):
    return P.describe_exact(tables(spark, sf_dir).features(), FEATS)


_PCTS = (0.1, 1, 5, 10, 25, 50)


@register("coverage_top_pct", sql(C.VOCAB_CTE + """
, _V AS (SELECT count(*) AS V, sum(corpus_freq) AS T FROM vocab)
, _p(pct) AS (VALUES """ + ", ".join(f"({float(p)})" for p in _PCTS) + """)
, _n AS (SELECT pct, greatest(1, CAST(floor(V * pct / 100) AS BIGINT)) AS n_items, T FROM _p, _V)
SELECT CAST(pct AS DOUBLE) AS pct, n_items,
       round((SELECT sum(corpus_freq) FROM vocab WHERE corpus_idx < n_items) * 100.0 / T, 9) AS coverage_pct
FROM _n"""))
def q_coverage_top_pct(spark, sf_dir):
    return P.coverage_top_pct(C.vocab(spark, sf_dir), _PCTS)


@register("coverage_curve", sql(C.VOCAB_CTE + """
SELECT corpus_idx, corpus_freq,
       CAST(sum(corpus_freq) OVER (ORDER BY corpus_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_freq,
       round(sum(corpus_freq) OVER (ORDER BY corpus_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
             / (SELECT sum(corpus_freq) FROM vocab), 9) AS coverage_pct
FROM vocab"""))
def q_coverage_curve(spark, sf_dir):
    return P.coverage_curve(C.vocab(spark, sf_dir))


@register("vocab_limit_coverage", sql(C.VOCAB_CTE + " UNION ALL ".join(f"""
SELECT CAST({v} AS BIGINT) AS vocab_limit,
       round(sum(CASE WHEN corpus_idx < {v} THEN corpus_freq ELSE 0 END) * 100.0 / sum(corpus_freq), 9) AS coverage_pct,
       round(100.0 - sum(CASE WHEN corpus_idx < {v} THEN corpus_freq ELSE 0 END) * 100.0 / sum(corpus_freq), 9) AS unk_pct
FROM vocab""" for v in (100, 1000))))
def q_vocab_limit_coverage(spark, sf_dir):
    return P.vocab_limit_coverage(C.vocab(spark, sf_dir), (100, 1000))


@register("artist_diversity", sql("""
, _d AS (SELECT pid, count(DISTINCT artist_uri) AS n_art FROM tracks GROUP BY pid)
, _j AS (SELECT d.n_art, least(greatest(d.n_art / nullif(p.num_tracks, 0), 0.0), 1.0) AS ratio
         FROM _d d JOIN playlists p USING (pid))
SELECT round(median(n_art), 9) AS artists_median, round(avg(n_art), 9) AS artists_mean,
       round(quantile_cont(n_art, 0.1), 9) AS artists_p10, round(quantile_cont(n_art, 0.9), 9) AS artists_p90,
       CAST(max(n_art) AS BIGINT) AS artists_max, round(median(ratio), 9) AS ratio_median,
       round(avg(ratio), 9) AS ratio_mean FROM _j"""))
def q_artist_diversity(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.artist_diversity(t.playlists(), t.tracks())


_AD_CTE = """
, _d AS (SELECT pid, count(DISTINCT artist_uri) AS n_art FROM tracks GROUP BY pid)
, _j AS (SELECT d.n_art, least(greatest(d.n_art / nullif(p.num_tracks, 0), 0.0), 1.0) AS ratio FROM _d d JOIN playlists p USING (pid))
"""


@register("artist_diversity_hist", sql(_AD_CTE + "SELECT 'artists' AS hist, bin, n, bin_lo, bin_hi FROM (" + _hist_sql(
    "_j", "n_art", 50, "(SELECT CAST(min(n_art) AS DOUBLE) FROM _j)", "(SELECT CAST(max(n_art) AS DOUBLE) FROM _j)")
    + ") UNION ALL SELECT 'ratio' AS hist, bin, n, bin_lo, bin_hi FROM (" + _hist_sql("_j", "ratio", 50, "0.0", "1.0") + ")"))
def q_artist_diversity_hist(spark, sf_dir):
    """Histograms of distinct artists per group and of their ratio to the group's entries."""
    t = tables(spark, sf_dir)
    d = P.artists_per_group(t.playlists(), t.tracks())
    a, r = P.histogram(d, "n_art", 50), P.histogram(d, "ratio", 50, 0.0, 1.0)
    return a.select(F.lit("artists").alias("hist"), *a.columns).unionByName(r.select(F.lit("ratio").alias("hist"), *r.columns))


@register("split_profile", sql(C.SPLIT_CTE + """
, _s AS (SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(min(seq_len) AS DOUBLE) AS min,
                quantile_cont(seq_len, 0.1) AS p10, CAST(median(seq_len) AS DOUBLE) AS median,
                round(avg(seq_len), 9) AS mean, quantile_cont(seq_len, 0.9) AS p90, CAST(max(seq_len) AS DOUBLE) AS max,
                quantile_cont(seq_len, 0.25) AS q1, quantile_cont(seq_len, 0.75) AS q3 FROM gsplit GROUP BY split)
SELECT s.*, (SELECT CAST(min(seq_len) AS DOUBLE) FROM gsplit g WHERE g.split = s.split AND seq_len >= s.q1 - 1.5 * (s.q3 - s.q1)) AS whisker_lo,
            (SELECT CAST(max(seq_len) AS DOUBLE) FROM gsplit g WHERE g.split = s.split AND seq_len <= s.q3 + 1.5 * (s.q3 - s.q1)) AS whisker_hi
FROM _s s"""))
def q_split_profile(spark, sf_dir):
    return P.split_profile(C.groups_split(spark, sf_dir))
