"""Raw slice files: one JSON document per file, ``{info, playlists: [...]}``.

Reading uses an explicit schema with ``multiLine`` (one task per file, the
format is not splittable) and two ``explode`` steps to flatten playlists and
track entries. Field-presence rules need the raw text, which
``read_slice_text`` keeps per playlist and per track object.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACK = T.StructType([
    T.StructField("pos", T.LongType()), T.StructField("artist_name", T.StringType()),
    T.StructField("track_uri", T.StringType()), T.StructField("artist_uri", T.StringType()),
    T.StructField("track_name", T.StringType()), T.StructField("album_uri", T.StringType()),
    T.StructField("duration_ms", T.LongType()), T.StructField("album_name", T.StringType())])
PLAYLIST = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("collaborative", T.StringType()),
    T.StructField("pid", T.LongType()), T.StructField("modified_at", T.LongType()),
    T.StructField("num_tracks", T.LongType()), T.StructField("num_albums", T.LongType()),
    T.StructField("num_followers", T.LongType()), T.StructField("num_edits", T.LongType()),
    T.StructField("duration_ms", T.LongType()), T.StructField("num_artists", T.LongType()),
    T.StructField("description", T.StringType()), T.StructField("tracks", T.ArrayType(TRACK))])
INFO = T.StructType([T.StructField("generated_on", T.StringType()), T.StructField("slice", T.StringType()),
                     T.StructField("version", T.StringType())])
SLICE = T.StructType([T.StructField("info", INFO), T.StructField("playlists", T.ArrayType(PLAYLIST))])


def list_slices(spark: SparkSession, path: str, limit_files: int | None = None,
                pattern: str = "mpd.slice.*.json") -> list[str]:
    """Slice files under ``path`` in lexicographic name order, first
    ``limit_files`` of them (file listing through the Hadoop FS API)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + pattern)
    fs = p.getFileSystem(conf)
    stats = fs.globStatus(p) or []
    files = sorted(str(s.getPath().toString()) for s in stats)
    return files[:limit_files] if limit_files is not None else files


def read_slices(spark: SparkSession, path: str, limit_files: int | None = None,
                pattern: str = "mpd.slice.*.json") -> DataFrame:
    files = list_slices(spark, path, limit_files, pattern)
    df = spark.read.schema(SLICE).option("multiLine", True).json(files)
    return df.withColumn("file", F.col("_metadata.file_name"))


def slice_playlists(slices: DataFrame) -> DataFrame:
    """12-column playlist table; has_desc = description key present."""
    p = slices.select(F.explode("playlists").alias("p")).select("p.*")
    return p.select("pid", "name", "num_tracks", "num_artists", "num_albums", "num_followers", "num_edits",
                    "duration_ms", "modified_at", "collaborative",
                    F.col("description").isNotNull().alias("has_desc"),
                    F.coalesce("description", F.lit("")).alias("description"))


def slice_tracks(slices: DataFrame, with_file: bool = False, with_index: bool = False) -> DataFrame:
    """One row per playlist entry, parent pid carried down; ``idx`` = place in the stored array."""
    p = slices.select("file", F.explode("playlists").alias("p"))
    t = p.select("file", F.col("p.pid").alias("pid"), F.posexplode("p.tracks").alias("idx", "t"))
    cols = ["pid", F.col("t.pos").alias("pos"), F.col("t.track_uri").alias("track_uri"),
            F.col("t.track_name").alias("track_name"), F.col("t.artist_uri").alias("artist_uri"),
            F.col("t.artist_name").alias("artist_name"), F.col("t.album_uri").alias("album_uri"),
            F.col("t.album_name").alias("album_name"), F.col("t.duration_ms").alias("track_dur_ms")]
    return t.select(*(["file"] if with_file else []), *([F.col("idx").cast("long").alias("idx")] if with_index else []), *cols)


def slice_catalog(slices: DataFrame) -> DataFrame:
    """First-seen row per track_uri in (file, pid, pos) order."""
    from cadence.operators.recommend import first_per_key
    t = slice_tracks(slices, with_file=True)
    cols = ["track_name", "artist_uri", "artist_name", "album_uri", "album_name", "track_dur_ms"]
    return first_per_key(t, "track_uri", ["file", "pid", "pos"], cols)


def read_slice_text(spark: SparkSession, path: str, limit_files: int | None = None,
                    pattern: str = "mpd.slice.*.json"):
    """(playlist objects, track objects, info objects) as raw JSON text for the
    field-presence rules. Nested objects are kept as text by the string schema."""
    files = list_slices(spark, path, limit_files, pattern)
    raw = spark.read.text(files, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    top = raw.select("file", F.from_json("value", "info string, playlists array<string>").alias("j"))
    info = top.select("file", F.col("j.info").alias("_json"), F.lit(None).cast("long").alias("pid"))
    pls = top.select("file", F.explode("j.playlists").alias("_json"))
    pls = pls.withColumn("pid", F.get_json_object("_json", "$.pid").cast("long"))
    trs = pls.select("file", "pid", F.posexplode(
        F.from_json(F.get_json_object("_json", "$.tracks"), "array<string>")).alias("pos", "_json"))
    return pls, trs, info


def write_slices(playlists: DataFrame, tracks: DataFrame, out_dir: str, per_slice: int = 1000,
                 generated_on: str = "2017-12-03 08:41:42.057563", version: str = "v1", order: str = "pos",
                 extra_playlist=(), extra_track=(), info=lambda i: {}) -> None:
    """Write tables in the raw slice format: one JSON document per folder
    ``slice=A-B`` holding ``per_slice`` consecutive pids (read them back with
    ``pattern=WRITTEN_PATTERN``); the description key only where present.
    Entries stand in the array in the order of column ``order``; a null field
    is left out. ``extra_*`` name further fields of the objects, ``info(i)``
    gives fields of the info object by slice number (both for defective slices).

    A slice document holds all of its playlists and entries; that is the
    format (one JSON document per file), so each slice is assembled in one task.
    Playlists and entries are shuffled once, together, by slice; a task gets about
    ``SLICES_PER_TASK`` of them, however many there are. The text is gzipped.
    """
    from cadence.operators.profile import fit_scalars
    of_pid = F.floor(F.col("pid") / per_slice).alias("_slice")
    t = tracks.select(of_pid, "pid", F.struct(F.col(order).alias("_o"), F.struct(
        "pos", "artist_name", "track_uri", "artist_uri", "track_name", "album_uri",
        F.col("track_dur_ms").alias("duration_ms"), "album_name", *extra_track).alias("t")).alias("t"))
    p = playlists.select(of_pid, "pid", F.struct(
        "name", "collaborative", "modified_at", "num_tracks", "num_albums", "num_followers", "num_edits", "duration_ms", "num_artists",
        F.when(F.col("has_desc"), F.col("description")).alias("description"), *extra_playlist).alias("p"))
    n = fit_scalars(playlists.select(of_pid), F.approx_count_distinct("_slice").alias("n"))["n"] or 0
    rows = p.unionByName(t, allowMissingColumns=True).repartition(max(1, math.ceil(n / SLICES_PER_TASK)), "_slice")
    nested = rows.groupBy("_slice", "pid").agg(F.collect_list("p").alias("ps"), F.sort_array(F.collect_list("t")).alias("ts"))
    # entries without a playlist are left out; a null pid joins no entries
    lists = nested.select("_slice", "pid", F.explode("ps").alias("p"), F.when(F.col("pid").isNotNull(), F.transform("ts", lambda x: x["t"])).alias("tracks"))
    pl = F.struct("p.name", "p.collaborative", "pid", "p.modified_at", "p.num_tracks", "p.num_albums", "p.num_followers",
                  "p.num_edits", "p.duration_ms", "p.num_artists", "p.description",
                  F.coalesce("tracks", F.array()).alias("tracks"), *[f"p.{c}" for c in extra_playlist])
    doc = lists.groupBy("_slice").agg(F.array_sort(F.collect_list(F.struct("pid", pl.alias("p")))).alias("ps"))
    lo = F.col("_slice") * per_slice
    name = F.format_string("%d-%d", lo, lo + per_slice - 1)
    fields = {"generated_on": F.lit(generated_on), "slice": name, "version": F.lit(version), **info(F.col("_slice"))}
    doc = doc.select(name.alias("slice"), F.to_json(F.struct(
        F.struct(*[c.alias(k) for k, c in fields.items()]).alias("info"),
        F.transform("ps", lambda x: x["p"]).alias("playlists"))).alias("value"))
    # one slice per output folder slice=A-B, written by the task that holds it
    doc.write.mode("overwrite").partitionBy("slice").option("compression", "gzip").text(out_dir)


SLICES_PER_TASK = 8
WRITTEN_PATTERN = "slice=*/part-*"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> None:
    """Whole-table sink: Parquet (default) or CSV with a header (metric tables)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)
