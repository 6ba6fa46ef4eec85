"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import quality as Q
from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.registry import register
from cadence.sources import dirty as D
from cadence.sources.fixtures import tables

_V = "CAST({pid} AS BIGINT) AS pid, CAST({pos} AS BIGINT) AS pos, CAST({detail} AS VARCHAR) AS detail"


def _sel(rule, pid="pid", pos="NULL", detail="''"):
    return f"SELECT '{rule}' AS rule, " + _V.format(pid=pid, pos=pos, detail=detail)


@register("check_playlists", sql(f"""
, _per AS (SELECT pid, count(*) AS _t, count(DISTINCT artist_uri) AS _ar, count(DISTINCT album_uri) AS _al
           FROM tracks GROUP BY pid)
, _j AS (SELECT p.pid, coalesce(_t, 0) AS _t, coalesce(_ar, 0) AS _ar, coalesce(_al, 0) AS _al
         FROM playlists p LEFT JOIN _per USING (pid))
{_sel('duplicate_pid', detail="printf('%d copies', count(*))")} FROM playlists GROUP BY pid HAVING count(*) > 1
UNION ALL {_sel('empty_name')} FROM playlists WHERE length(name) = 0
UNION ALL {_sel('too_few_tracks', detail='_t')} FROM _j WHERE _t < 5
UNION ALL {_sel('too_few_artists', detail='_ar')} FROM _j WHERE _ar < 3
UNION ALL {_sel('too_few_albums', detail='_al')} FROM _j WHERE _al < 2
UNION ALL {_sel('too_few_followers', detail='num_followers')} FROM playlists WHERE num_followers < 1
UNION ALL {_sel('too_few_edits', detail='num_edits')} FROM playlists WHERE num_edits <= 0
UNION ALL {_sel('modified_too_late', detail='modified_at')} FROM playlists WHERE modified_at > {Q.CUTOFF_EPOCH_S}"""))
def q_check_playlists(spark, sf_dir):
    t = tables(spark, sf_dir)
    return Q.playlist_rules(t.playlists(), t.tracks())


@register("check_tracks", sql(f"""
, _ix AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY pos) - 1 AS _i FROM tracks)
{_sel('out_of_order', pos='_i', detail="printf('%d %d', _i, pos)")} FROM _ix WHERE pos <> _i
UNION ALL {_sel('invalid_track_uri', pos='pos', detail='track_uri')} FROM tracks WHERE NOT starts_with(track_uri, 'spotify:track:')
UNION ALL {_sel('invalid_album_uri', pos='pos', detail='album_uri')} FROM tracks WHERE NOT starts_with(album_uri, 'spotify:album:')
UNION ALL {_sel('invalid_artist_uri', pos='pos', detail='artist_uri')} FROM tracks WHERE NOT starts_with(artist_uri, 'spotify:artist:')"""))
def q_check_tracks(spark, sf_dir):
    from cadence.operators.ranking import renumber
    t = tables(spark, sf_dir).tracks()
    # the array index of a row = its rank by pos inside the group
    ix = renumber(t.withColumn("_orig", F.col("pos")), "pid", "pos", "_i")
    return Q.track_rules(ix, "_i")


@register("check_name_consistency", sql(" UNION ALL ".join(f"""
{_sel(f'mismatch_{k}_name', pos='t.pos', detail=f"t.{k}_name || ' | ' || f._first")}
FROM tracks t JOIN (SELECT {k}_uri, arg_min({k}_name, (pid, pos)) AS _first FROM tracks GROUP BY 1) f USING ({k}_uri)
WHERE t.{k}_name IS DISTINCT FROM f._first""" for k in ("artist", "album", "track"))))
def q_check_names(spark, sf_dir):
    return Q.name_consistency(tables(spark, sf_dir).tracks())


@register("check_reconcile", sql("""
, _per AS (SELECT pid, count(*) AS _num_tracks, count(DISTINCT artist_uri) AS _num_artists,
                  count(DISTINCT album_uri) AS _num_albums, sum(track_dur_ms) AS _duration_ms FROM tracks GROUP BY pid)
, _j AS (SELECT * FROM playlists LEFT JOIN _per USING (pid))
""" + " UNION ALL ".join(
    f"{_sel(c + '_mismatch', detail=chr(39).join(['printf(', '%d %d', f', coalesce(_{c}, 0), {c})']))} FROM _j WHERE {c} <> coalesce(_{c}, 0)"
    for c in ("num_tracks", "num_artists", "num_albums", "duration_ms"))))
def q_check_reconcile(spark, sf_dir):
    t = tables(spark, sf_dir)
    return Q.reconcile(t.playlists(), t.tracks())


def _playlist_json(p):
    cols = ["name", "collaborative", "pid", "modified_at", "num_albums", "num_tracks", "num_followers",
            "num_edits", "duration_ms", "num_artists"]
    st = F.struct(*[F.col(c) for c in cols], F.lit("[]").alias("tracks"), "zz_note",
                  F.when(F.col("has_desc"), F.col("description")).alias("description"))
    return p.select("pid", F.to_json(st).alias("_json"))


def _track_json(t):
    st = F.struct("pos", "artist_name", "artist_uri", "album_uri", "album_name", "track_uri", "track_name",
                  F.col("track_dur_ms").alias("duration_ms"), "zz_flag")
    return t.select("pid", "idx", F.to_json(st).alias("_json"))


_PL_KEYS = "['name', 'collaborative', 'pid', 'modified_at', 'num_albums', 'num_tracks', 'num_followers', 'num_edits', 'duration_ms', 'num_artists', 'tracks']"
_TR_KEYS = "['pos', 'artist_name', 'artist_uri', 'album_uri', 'album_name', 'track_uri', 'track_name', 'duration_ms']"


@register("check_fields", sql(f"""
, _pk AS (SELECT pid, list_filter({_PL_KEYS}, lambda x: x <> 'num_albums' OR pid % 13 <> 2) || CASE WHEN pid % 13 = 3 THEN ['zz_note'] ELSE [] END
                 || CASE WHEN has_desc THEN ['description'] ELSE [] END AS k FROM playlists)
, _tk AS (SELECT pid, pos, list_filter({_TR_KEYS}, lambda x: x <> 'album_name' OR pid % 11 <> 4 OR pos <> 0) || CASE WHEN pid % 11 = 5 AND pos = 1 THEN ['zz_flag'] ELSE [] END AS k FROM tracks)
{_sel('extra_field', detail='f')} FROM (SELECT pid, unnest(list_filter(k, lambda x: NOT list_contains({_PL_KEYS} || ['description'], x))) AS f FROM _pk)
UNION ALL {_sel('missing_field', detail='f')} FROM (SELECT pid, unnest(list_filter({_PL_KEYS}, lambda x: NOT list_contains(k, x))) AS f FROM _pk)
UNION ALL {_sel('extra_track_field', pos='pos', detail='f')} FROM (SELECT pid, pos, unnest(list_filter(k, lambda x: NOT list_contains({_TR_KEYS}, x))) AS f FROM _tk)
UNION ALL {_sel('missing_track_field', pos='pos', detail='f')} FROM (SELECT pid, pos, unnest(list_filter({_TR_KEYS}, lambda x: NOT list_contains(k, x))) AS f FROM _tk)"""))
def q_check_fields(spark, sf_dir):
    """Key rules on JSON objects with missing and unknown keys (the raw-slice
    form is read by cadence.sources.slices.read_slice_text and checked by the
    same rules)."""
    t = tables(spark, sf_dir)
    p, tr = D.with_key_defects(t.playlists(), t.tracks())
    pl = Q.key_rules(_playlist_json(p), "_json", Q.PLAYLIST_FIELDS, Q.OPTIONAL_PLAYLIST_FIELDS, "")
    return pl.unionByName(Q.key_rules(_track_json(tr), "_json", Q.TRACK_FIELDS, [], "track_", F.col("idx")))


def _playlist_rules_sql(p: str, t: str) -> str:
    return f"""
, _per AS (SELECT pid, count(*) AS _t, count(DISTINCT artist_uri) AS _ar, count(DISTINCT album_uri) AS _al
           FROM {t} GROUP BY pid)
, _j AS (SELECT p.pid, coalesce(_t, 0) AS _t, coalesce(_ar, 0) AS _ar, coalesce(_al, 0) AS _al
         FROM {p} p LEFT JOIN _per USING (pid))
{_sel('duplicate_pid', detail="printf('%d copies', count(*))")} FROM {p} GROUP BY pid HAVING count(*) > 1
UNION ALL {_sel('empty_name')} FROM {p} WHERE coalesce(length(name), 0) = 0
UNION ALL {_sel('too_few_tracks', detail='_t')} FROM _j WHERE _t < 5
UNION ALL {_sel('too_few_artists', detail='_ar')} FROM _j WHERE _ar < 3
UNION ALL {_sel('too_few_albums', detail='_al')} FROM _j WHERE _al < 2
UNION ALL {_sel('too_few_followers', detail='num_followers')} FROM {p} WHERE num_followers < 1
UNION ALL {_sel('too_few_edits', detail='num_edits')} FROM {p} WHERE num_edits <= 0
UNION ALL {_sel('modified_too_late', detail='modified_at')} FROM {p} WHERE modified_at > {Q.CUTOFF_EPOCH_S}"""


def _reconcile_sql(p: str, t: str) -> str:
    return f"""
, _per AS (SELECT pid, count(*) AS _num_tracks, count(DISTINCT artist_uri) AS _num_artists,
                  count(DISTINCT album_uri) AS _num_albums, sum(track_dur_ms) AS _duration_ms FROM {t} GROUP BY pid)
, _j AS (SELECT * FROM {p} LEFT JOIN _per USING (pid))
""" + " UNION ALL ".join(_sel(c + "_mismatch", detail=f"printf('%d %d', coalesce(_{c}, 0), {c})") + f" FROM _j WHERE {c} <> coalesce(_{c}, 0)"
                         for c in ("num_tracks", "num_artists", "num_albums", "duration_ms"))


def _or_null(kind: str) -> str:
    return f"coalesce({kind}_uri, 'null')"


def dirty(spark, sf_dir):
    t = tables(spark, sf_dir)
    return (C.memo(spark, sf_dir, "dirty_playlists", lambda: D.dirty_playlists(t.playlists())),
            C.memo(spark, sf_dir, "dirty_tracks", lambda: D.dirty_tracks(t.tracks())))


@register("check_playlists_dirty", sql(D.DIRTY_CTE + _playlist_rules_sql("dplaylists", "dtracks")))
def q_check_playlists_dirty(spark, sf_dir):
    return Q.playlist_rules(*dirty(spark, sf_dir))


@register("check_tracks_dirty", sql(D.DIRTY_CTE + f"""
{_sel('out_of_order', pos='idx', detail="printf('%d %d', idx, pos)")} FROM dtracks WHERE pos <> idx
""" + "".join(f" UNION ALL {_sel(f'invalid_{k}_uri', pos='idx', detail=_or_null(k))} FROM dtracks WHERE NOT coalesce(starts_with({k}_uri, 'spotify:{k}:'), false)"
              for k in ("track", "album", "artist"))))
def q_check_tracks_dirty(spark, sf_dir):
    return Q.track_rules(dirty(spark, sf_dir)[1], "idx")


@register("check_name_consistency_dirty", sql(D.DIRTY_CTE + " UNION ALL ".join(f"""
{_sel(f'mismatch_{k}_name', pos='t.pos', detail=f"t.{k}_name || ' | ' || f._first")}
FROM dtracks t JOIN (SELECT {k}_uri, arg_min({k}_name, (pid, pos)) AS _first FROM dtracks GROUP BY 1) f USING ({k}_uri)
WHERE t.{k}_name IS DISTINCT FROM f._first""" for k in ("artist", "album", "track"))))
def q_check_names_dirty(spark, sf_dir):
    return Q.name_consistency(dirty(spark, sf_dir)[1])


@register("check_reconcile_dirty", sql(D.DIRTY_CTE + _reconcile_sql("dplaylists", "dtracks")))
def q_check_reconcile_dirty(spark, sf_dir):
    return Q.reconcile(*dirty(spark, sf_dir))


@register("check_missing_ids_dirty", sql(D.DIRTY_CTE + """
SELECT CAST(r.range AS BIGINT) AS pid FROM range(0, (SELECT max(pid) + 1 FROM dplaylists)) r
WHERE r.range NOT IN (SELECT pid FROM dplaylists)"""))
def q_missing_ids_dirty(spark, sf_dir):
    return Q.missing_ids(dirty(spark, sf_dir)[0], "pid")


@register("check_missing_ids", sql("""
SELECT CAST(r.range AS BIGINT) AS pid FROM range(0, (SELECT max(pid) + 1 FROM playlists)) r
WHERE r.range NOT IN (SELECT pid FROM playlists)"""))
def q_missing_ids(spark, sf_dir):
    return Q.missing_ids(tables(spark, sf_dir).playlists(), "pid")


@register("validate_counts", sql("""
, _got(check_name, got) AS (
  SELECT 'n_playlists', CAST(count(*) AS DOUBLE) FROM playlists
  UNION ALL SELECT 'n_entries', CAST(count(*) AS DOUBLE) FROM tracks
  UNION ALL SELECT 'n_tracks', CAST(count(DISTINCT track_uri) AS DOUBLE) FROM tracks
  UNION ALL SELECT 'n_tracks_by_name', CAST(count(DISTINCT track_name || ' by ' || artist_name) AS DOUBLE) FROM tracks
  UNION ALL SELECT 'n_artists', CAST(count(DISTINCT artist_uri) AS DOUBLE) FROM tracks
  UNION ALL SELECT 'mean_len', CAST(count(*) AS DOUBLE) / count(DISTINCT pid) FROM tracks
  UNION ALL SELECT 'n_catalog', CAST(count(DISTINCT track_uri) AS DOUBLE) FROM tracks
  UNION ALL SELECT 'spot_brand13_entries', CAST(count(*) AS DOUBLE) FROM tracks WHERE artist_name = 'Brand#13')
, _exp(check_name, expected) AS (
  SELECT 'n_playlists', CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'n_entries', CAST(count(*) AS DOUBLE) FROM lineitem
  UNION ALL SELECT 'n_tracks', CAST(count(DISTINCT l_partkey) AS DOUBLE) FROM lineitem
  UNION ALL SELECT 'n_tracks_by_name', CAST(count(DISTINCT p_name || ' by ' || p_brand) AS DOUBLE) FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'n_artists', CAST(count(DISTINCT p_brand) AS DOUBLE) FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'mean_len', CAST(count(*) AS DOUBLE) / count(DISTINCT o_custkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'n_catalog', CAST(count(*) AS DOUBLE) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)
  UNION ALL SELECT 'spot_brand13_entries', CAST(count(*) AS DOUBLE) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#13')
SELECT check_name, got, expected, CASE WHEN abs(got - expected) <= 0.001 THEN 'PASS' ELSE 'FAIL' END AS status
FROM _got FULL JOIN _exp USING (check_name)"""))
def q_validate_counts(spark, sf_dir):
    """Derived-table totals against the same totals taken from the source tables."""
    t = tables(spark, sf_dir)
    tr, pl = t.tracks(), t.playlists()
    li, o, p = t.raw("lineitem"), t.raw("orders"), t.raw("part")
    lp = li.join(p, li.l_partkey == p.p_partkey)
    lo = li.join(o, li.l_orderkey == o.o_orderkey)

    def one(df, name, expr):
        return df.agg(expr.cast("double").alias("v")).select(F.lit(name).alias("check_name"), "v")

    got = [one(pl, "n_playlists", F.count(F.lit(1))), one(tr, "n_entries", F.count(F.lit(1))),
           one(tr, "n_tracks", F.countDistinct("track_uri")),
           one(tr, "n_tracks_by_name", F.countDistinct(F.concat("track_name", F.lit(" by "), "artist_name"))), one(tr, "n_artists", F.countDistinct("artist_uri")),
           one(tr, "mean_len", F.count(F.lit(1)) / F.countDistinct("pid")),
           one(tr, "n_catalog", F.countDistinct("track_uri")),
           one(tr.where(F.col("artist_name") == "Brand#13"), "spot_brand13_entries", F.count(F.lit(1)))]
    exp = [one(lo, "n_playlists", F.countDistinct("o_custkey")), one(li, "n_entries", F.count(F.lit(1))),
           one(li, "n_tracks", F.countDistinct("l_partkey")),
           one(lp, "n_tracks_by_name", F.countDistinct(F.concat("p_name", F.lit(" by "), "p_brand"))), one(lp, "n_artists", F.countDistinct("p_brand")),
           one(lo, "mean_len", F.count(F.lit(1)) / F.countDistinct("o_custkey")),
           one(p.join(li, p.p_partkey == li.l_partkey, "left_semi"), "n_catalog", F.count(F.lit(1))),
           one(lp.where(F.col("p_brand") == "Brand#13"), "spot_brand13_entries", F.count(F.lit(1)))]
    g = got[0]
    for x in got[1:]:
        g = g.unionByName(x)
    e = exp[0]
    for x in exp[1:]:
        e = e.unionByName(x)
    return Q.validate_counts(g.withColumnRenamed("v", "got"), e.withColumnRenamed("v", "expected"), 0.001)
