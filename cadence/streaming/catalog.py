"""Incremental ingest of slice files with Structured Streaming.

Files arrive in batches (``maxFilesPerTrigger``); each micro-batch appends its
playlists, its track entries, the catalogue rows of track URIs not seen in
earlier batches (first seen in (file, pid, pos) order inside the batch) and a
row of totals.

The "seen" set is keyed streaming state: the URIs of a batch pass through
``dropDuplicates`` on a RocksDB state store, which lets a URI through once, so no
batch reads earlier output.  What comes through names the new URIs; their rows
are chosen from the batch itself.  The state is versioned by batch under the
checkpoint, and every batch writes its own folder (overwrite), so a batch that is
replayed after a failure starts from the state before it and rewrites the same
output.  ``availableNow`` drains what exists and stops.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.sources.slices import SLICE, slice_catalog, slice_playlists, slice_tracks


def _batch_paths(spark: SparkSession, root: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/batch=*")
    stats = p.getFileSystem(conf).globStatus(p) or []
    return sorted(str(s.getPath().toString()) for s in stats)


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def with_new_uris(stream: DataFrame) -> DataFrame:
    """The rows of a stream of slices (``new`` false), and one row per track URI that no earlier batch held (``new`` true, ``uri``).

    A null URI is a URI like any other."""
    uris = stream.select(F.explode("playlists.tracks").alias("tracks")).select(F.explode("tracks.track_uri").alias("uri"))
    seen_first = uris.dropDuplicates(["uri"]).withColumn("new", F.lit(True))
    return stream.withColumn("new", F.lit(False)).unionByName(seen_first, allowMissingColumns=True)


def stream_ingest(spark: SparkSession, src: str, out: str, checkpoint: str, files_per_trigger: int = 50,
                  glob_filter: str = "mpd.slice.*.json", recursive: bool = False):
    """Start the incremental ingest of playlists, tracks, catalogue and totals; returns the StreamingQuery.

    A batch pays for every partition of the state, so there is one for each core and not the session's number, and
    a batch commits the changes of the state, not the state. What a batch writes is small beside the cluster: the
    tables are written at the same time, from the batch that the first job, the totals, has read."""
    stream = (spark.readStream.schema(SLICE).option("multiLine", True)
              .option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", glob_filter)
              .option("recursiveFileLookup", recursive).json(src)
              .withColumn("file", F.col("_metadata.file_path")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the state store is asked once
        try:
            # over all rows: the job asks the state store once, in every partition
            lists = F.coalesce("playlists", F.array().cast(batch.schema["playlists"].dataType))
            entries = F.aggregate(lists, F.lit(0), lambda a, p: a + F.greatest(F.size(p["tracks"]), F.lit(0)))
            batch.agg(F.coalesce(F.sum(F.size(lists)), F.lit(0)).cast("long").alias("playlists"), F.coalesce(F.sum(entries), F.lit(0)).cast("long").alias("entries")) \
                .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/totals/batch={batch_id}")
            slices, new = batch.where(~F.col("new")).drop("new", "uri"), batch.where("new").select("uri")
            cat = slice_catalog(slices).join(new, F.col("track_uri").eqNullSafe(F.col("uri")), "left_semi")
            tables = {"playlists": slice_playlists(slices), "tracks": slice_tracks(slices), "catalog": cat}
            write = inheritable_thread_target(batch.sparkSession)(
                lambda name: tables[name].write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}"))
            with ThreadPoolExecutor(len(tables)) as pool:
                list(pool.map(write, tables))
        finally:
            batch.unpersist()

    own = {STATE_PROVIDER: ROCKSDB, CHANGELOG: "true", PARTITIONS: str(min(int(spark.conf.get(PARTITIONS)), max(4, spark.sparkContext.defaultParallelism)))}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():  # a query keeps the settings it was started with
        spark.conf.set(k, v)
    try:
        return (with_new_uris(stream).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_catalog(spark: SparkSession, out: str) -> DataFrame:
    paths = _batch_paths(spark, f"{out}/catalog")
    return spark.read.parquet(*paths)


def read_appended(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All batches of ``playlists`` or ``tracks``."""
    return spark.read.parquet(*_batch_paths(spark, f"{out}/{table}"))


def running_totals(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, playlists, entries, unique_tracks) cumulated over batches."""
    from pyspark.sql import Window
    tot = spark.read.parquet(*_batch_paths(spark, f"{out}/totals"))
    cat = read_catalog(spark, out).withColumn("batch_id", F.regexp_extract(F.input_file_name(), r"batch=(\d+)", 1).cast("long"))
    new = cat.groupBy("batch_id").agg(F.count(F.lit(1)).alias("new_tracks"))
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)  # one row per batch
    j = tot.join(new, "batch_id", "left").fillna(0, ["new_tracks"])
    return j.select("batch_id", F.sum("playlists").over(w).alias("playlists"),
                    F.sum("entries").over(w).alias("entries"), F.sum("new_tracks").over(w).alias("unique_tracks"))
