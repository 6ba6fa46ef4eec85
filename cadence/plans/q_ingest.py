"""Raw JSON slice ingest (batch and incremental). The slices are first
written from the canonical tables into the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.plans import common as C
from cadence.plans.oracle import sql
from cadence.plans.q_itemcf import META_CTE
from cadence.plans.registry import register
from cadence.session import scratch_path
from cadence.sources import dirty as D
from cadence.sources import slices as SL
from cadence.sources.fixtures import tables
from cadence.session import session_key

PER_SLICE = 250
MOST_BATCHES = 32  # of the incremental ingest
FILES_PER_CORE = 4  # in a batch of it, where that leaves LEAST_BATCHES
LEAST_BATCHES = 4


def slices_dir(spark, sf_dir):
    key = (session_key(spark), sf_dir, "slices_dir")
    if key not in C._MEMO:
        t = tables(spark, sf_dir)
        path = scratch_path(spark, "slices")
        SL.write_slices(t.playlists(), t.tracks(), path, PER_SLICE)
        C._MEMO[key] = path
    return C._MEMO[key]


def dirty_slices_dir(spark, sf_dir):
    """Slices with exchanged entries and with missing and unknown keys (see sources.dirty)."""
    key = (session_key(spark), sf_dir, "dirty_slices_dir")
    if key not in C._MEMO:
        t = tables(spark, sf_dir)
        p, tr = D.with_key_defects(t.playlists(), t.tracks())
        path = scratch_path(spark, "dirty-slices")
        SL.write_slices(p, tr, path, PER_SLICE, order="idx", extra_playlist=["zz_note"], extra_track=["zz_flag"], info=lambda i: {
            "version": F.when(i % 2 == 0, F.lit("v1")), "zz": F.when(i % 3 == 2, F.lit(1))})
        C._MEMO[key] = path
    return C._MEMO[key]


def read(spark, sf_dir):
    return SL.read_slices(spark, slices_dir(spark, sf_dir), pattern=SL.WRITTEN_PATTERN)


@register("ingest_playlists", sql("SELECT * FROM playlists"))
def q_ingest_playlists(spark, sf_dir):
    return SL.slice_playlists(read(spark, sf_dir))


@register("ingest_tracks", sql("SELECT * FROM tracks"))
def q_ingest_tracks(spark, sf_dir):
    return SL.slice_tracks(read(spark, sf_dir))


@register("ingest_catalog", sql(META_CTE + "SELECT * FROM meta"))
def q_ingest_catalog(spark, sf_dir):
    return SL.slice_catalog(read(spark, sf_dir))


FIRST_SLICES = f"""
SELECT {{}} FROM {{}} WHERE pid // {PER_SLICE} IN (
  SELECT s FROM (SELECT DISTINCT pid // {PER_SLICE} AS s FROM playlists) ORDER BY printf('%d-%d', s * {PER_SLICE}, s * {PER_SLICE} + {PER_SLICE - 1}) LIMIT 2)"""


@register("ingest_limited", sql(FIRST_SLICES.format("*", "playlists")))
def q_ingest_limited(spark, sf_dir):
    """The first two slice files in name order (the file limit, and quick mode)."""
    return SL.slice_playlists(SL.read_slices(spark, slices_dir(spark, sf_dir), limit_files=2, pattern=SL.WRITTEN_PATTERN))


@register("ingest_limited_tracks", sql(FIRST_SLICES.format("*", "tracks")))
def q_ingest_limited_tracks(spark, sf_dir):
    return SL.slice_tracks(SL.read_slices(spark, slices_dir(spark, sf_dir), limit_files=2, pattern=SL.WRITTEN_PATTERN))


def batch_files(files: int, cores: int) -> int:
    """Files per trigger: a batch costs a second or two whatever it holds, so it takes ``FILES_PER_CORE`` for each core, or
    fewer where there would not be ``LEAST_BATCHES``, and more where ``MOST_BATCHES`` would not hold all; two at least."""
    return max(2, -(-files // MOST_BATCHES), min(FILES_PER_CORE * cores, -(-files // LEAST_BATCHES)))


def stream_out(spark, sf_dir):
    """Incremental ingest of the slice files into a fresh folder, in batches that keep the cores busy (see ``batch_files``)."""
    from cadence.streaming.catalog import stream_ingest
    key = (session_key(spark), sf_dir, "stream_out")
    if key not in C._MEMO:
        out = scratch_path(spark, "stream-out")
        src = slices_dir(spark, sf_dir)
        files = len(SL.list_slices(spark, src, pattern=SL.WRITTEN_PATTERN))
        q = stream_ingest(spark, src, out, out + "-checkpoint", files_per_trigger=batch_files(files, spark.sparkContext.defaultParallelism),
                          glob_filter="part-*", recursive=True)
        q.awaitTermination()
        C._MEMO[key] = out
    return C._MEMO[key]


@register("stream_catalog", sql(META_CTE + "SELECT * FROM meta"))
def q_stream_catalog(spark, sf_dir):
    from cadence.streaming.catalog import read_catalog
    return read_catalog(spark, stream_out(spark, sf_dir)).select("track_uri", "track_name", "artist_uri", "artist_name",
                                                                 "album_uri", "album_name", "track_dur_ms")


@register("stream_playlists", sql("SELECT * FROM playlists"))
def q_stream_playlists(spark, sf_dir):
    from cadence.streaming.catalog import read_appended
    return read_appended(spark, stream_out(spark, sf_dir), "playlists")


@register("stream_tracks", sql("SELECT * FROM tracks"))
def q_stream_tracks(spark, sf_dir):
    from cadence.streaming.catalog import read_appended
    return read_appended(spark, stream_out(spark, sf_dir), "tracks")


@register("stream_totals", sql("""
SELECT CAST((SELECT count(*) FROM playlists) AS BIGINT) AS playlists, CAST(count(*) AS BIGINT) AS entries,
       CAST(count(DISTINCT track_uri) AS BIGINT) AS unique_tracks FROM tracks"""))
def q_stream_totals(spark, sf_dir):
    """The running totals after the last batch."""
    from cadence.streaming.catalog import running_totals
    t = running_totals(spark, stream_out(spark, sf_dir))
    return t.orderBy(F.col("batch_id").desc()).limit(1).select("playlists", "entries", "unique_tracks")


_ROW = "CAST({} AS VARCHAR) AS rule, CAST({} AS BIGINT) AS pid, CAST({} AS BIGINT) AS pos, CAST({} AS VARCHAR) AS detail"


@register("check_raw_fields", sql(f"""
SELECT {_ROW.format("'missing_field'", "pid", "NULL", "'num_albums'")} FROM playlists WHERE pid % 13 = 2
UNION ALL SELECT {_ROW.format("'extra_field'", "pid", "NULL", "'zz_note'")} FROM playlists WHERE pid % 13 = 3
UNION ALL SELECT {_ROW.format("'missing_track_field'", "pid", "pos", "'album_name'")} FROM tracks WHERE pid % 11 = 4 AND pos = 0
UNION ALL SELECT {_ROW.format("'extra_track_field'", "pid", "pos", "'zz_flag'")} FROM tracks WHERE pid % 11 = 5 AND pos = 1
UNION ALL SELECT {_ROW.format("'missing_info_field'", "NULL", "NULL", "'version'")} FROM (SELECT DISTINCT pid // {PER_SLICE} AS s FROM playlists) WHERE s % 2 = 1
UNION ALL SELECT {_ROW.format("'extra_info_field'", "NULL", "NULL", "'zz'")} FROM (SELECT DISTINCT pid // {PER_SLICE} AS s FROM playlists) WHERE s % 3 = 2"""))
def q_check_raw_fields(spark, sf_dir):
    """I4 / I7 / I13 on the raw text of defective slice files."""
    from cadence.operators import quality as Q
    pls, trs, info = SL.read_slice_text(spark, dirty_slices_dir(spark, sf_dir), pattern=SL.WRITTEN_PATTERN)
    out = Q.key_rules(pls, "_json", Q.PLAYLIST_FIELDS, Q.OPTIONAL_PLAYLIST_FIELDS, "")
    out = out.unionByName(Q.key_rules(trs, "_json", Q.TRACK_FIELDS, [], "track_", F.col("pos")))
    return out.unionByName(Q.key_rules(info, "_json", Q.INFO_FIELDS, [], "info_"))


@register("check_slice_order", sql(f"""
SELECT {_ROW.format("'out_of_order'", "pid", "pos", "printf('%d %d', pos, 1 - pos)")} FROM tracks WHERE pid % 19 = 2 AND pos < 2"""))
def q_check_slice_order(spark, sf_dir):
    """I8 on defective slice files: the place in the stored array against the stored position."""
    from cadence.operators import quality as Q
    s = SL.read_slices(spark, dirty_slices_dir(spark, sf_dir), pattern=SL.WRITTEN_PATTERN)
    return Q.track_rules(SL.slice_tracks(s, with_index=True), "idx")


@register("metric_sinks", sql("""
, _sz AS (SELECT pid, count(*) AS n FROM tracks GROUP BY pid)
, _r AS (SELECT CAST(count(*) AS BIGINT) AS n_before, CAST(sum(CASE WHEN n >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_after,
                CAST(count(*) - sum(CASE WHEN n >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped FROM _sz)
SELECT 'csv' AS format, * FROM _r UNION ALL SELECT 'parquet', * FROM _r"""))
def q_metric_sinks(spark, sf_dir):
    """A metric table through the CSV and the Parquet sink and back."""
    from cadence.operators import sequences as S
    report = S.corpus_report(tables(spark, sf_dir).tracks(), C.MIN_LEN)
    out = None
    for fmt in ("csv", "parquet"):
        path = scratch_path(spark, f"metrics-{fmt}")
        SL.write_table(report, path, fmt)
        r = spark.read.schema(report.schema).option("header", True).format(fmt).load(path).select(F.lit(fmt).alias("format"), "*")
        out = r if out is None else out.unionByName(r)
    return out
