"""Canonical sequence tables derived from the driver's star-schema tables.

The driver ships TPC-H-like Parquet tables. The reference works on playlists
of tracks; the mapping below (see FIXTURES.md) turns customers into groups
(``pid``) and their line items, ordered by order date, into ordered entries.
Everything is a lazy DataFrame over the Parquet scans, so Catalyst prunes
columns and pushes filters into the readers.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.text import uri_of
from cadence.operators.profile import in_slices, slices_for
from cadence.operators.ranking import ordered_index
from cadence.session import MEMOS, bound_partitions, session_key

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

ENTRY_TABLES = ["orders", "lineitem"]  # what entries are made of

# Fixed fixture values: playlist titles, assigned by pid modulo the list length.
TITLES = ["Hip-Hop!!", "R&B (chill)", "country roads", "Rock_n_Roll", "CHILL  vibes",
          "gym @ 6am", "90s Throwback", "party/party", "Summer Hits", "Worship*",
          "X-mas ^ 2016", "EDM; bass", "Reggaeton", "Jazz~Blues", "grape soda", "Study #1",
          "my playlist", "favorites", "Motown", "   lofi   beats  ", "untitled", "misc",
          "2017", "été"]
N_FEATURES = 64  # every component of an embedding


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts) -> F.Column:
    """Epoch seconds of a wall-clock timestamp read as UTC (no session time zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600
            + F.minute(c) * 60 + F.second(c)).cast("long")


def stage(df: DataFrame, name: str = "") -> DataFrame:
    """Keep a stage output that several plans reuse, with a short lineage.

    Default (``cadence.stage=table``): write it as Parquet under the shared
    ``spark.checkpoint.dir`` and read it back -- later plans start from files
    (column pruning, filter pushdown), an executor loss does not recompute the
    upstream plan, and planning stays cheap. ``checkpoint`` uses
    ``DataFrame.checkpoint``; ``persist`` keeps it in executor memory/disk;
    ``none`` keeps the plan as it is.
    """
    spark = df.sparkSession
    mode = spark.conf.get("cadence.stage", "table")
    if mode == "none":
        return df
    if mode == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    from cadence.session import ensure_checkpoint_dir, scratch_path
    ensure_checkpoint_dir(spark)
    if mode == "checkpoint":
        return df.checkpoint(eager=True)
    path = scratch_path(spark, f"stage-{name or 'df'}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_together(frames, name: str = "") -> DataFrame:
    """``stage`` of the union of ``frames``, which are made and written one after the other: one table, read by one scan."""
    path = schema = None
    kept = []
    for df in frames:
        spark = df.sparkSession
        if spark.conf.get("cadence.stage", "table") != "table":
            kept.append(stage(df, name))
            continue
        if path is None:
            from cadence.session import scratch_path
            path, schema = scratch_path(spark, f"stage-{name or 'df'}"), df.schema
        df.write.mode("append").parquet(path)
    return functools.reduce(DataFrame.unionByName, kept) if kept else spark.read.schema(schema).parquet(path)


stage.together = stage_together


class Tables:
    """Lazy canonical tables for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def _get(self, name, build, staged: bool = True):
        if name not in self._memo:
            self._memo[name] = stage(build(), name) if staged else build()
        return self._memo[name]

    # -- entries ------------------------------------------------------------
    def entries_wide(self) -> DataFrame:
        """(pid, pos, item, order_key, order_ts): one row per line item.

        ``pos`` is the 0-based rank inside the customer by order date and line
        keys. It is numbered per (pid, day) bucket after a running offset over
        the (pid, day) counts, so a customer holding a large share of all rows
        is still numbered by many tasks. Many line items are joined slice by slice of
        the orders, and numbered slice by slice of the customers (``in_slices``).
        """
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                         "l_linenumber", "l_extendedprice")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")

        def joined(part):
            return part.join(o, part.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")

        def numbered(j):
            r = ordered_index(
                j.withColumn("_day", F.to_date("o_orderdate")),
                partition_by=["o_custkey"], bucket=["_day"], bucket_order=[F.col("_day")],
                row_order=[F.col(c) for c in ("o_orderdate", "l_orderkey", "l_linenumber",
                                              "l_partkey", "l_suppkey", "l_extendedprice")],
                index_col="pos")
            return r.select(F.col("o_custkey").alias("pid"), "pos",
                            F.col("l_partkey").alias("item"),
                            F.col("l_orderkey").alias("order_key"),
                            F.col("o_orderdate").alias("order_ts"))

        if "entries_wide" not in self._memo:
            if slices_for(li) == 1:
                self._memo["entries_wide"] = stage(numbered(joined(li)), "entries_wide")
            else:
                rows = in_slices(li, "l_orderkey", joined, stage, "entry_rows")
                self._memo["entries_wide"] = in_slices(rows, "o_custkey", numbered, stage, "entries_wide")
        return self._memo["entries_wide"]

    def entries(self) -> DataFrame:
        return self._get("entries", lambda: self.entries_wide().select("pid", "pos", "item"), staged=False)

    def tracks(self) -> DataFrame:
        """Entry table of the reference: one row per (pid, pos) with track metadata."""
        def build():
            p = self.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
            e = self.entries()
            album = F.concat_ws(" ", "p_brand", "p_type")
            return e.join(p, e.item == p.p_partkey, "inner").select(
                "pid", "pos",
                uri_of("track", "item").alias("track_uri"),
                F.col("p_name").alias("track_name"),
                uri_of("artist", "p_brand").alias("artist_uri"),
                F.col("p_brand").alias("artist_name"),
                uri_of("album", album).alias("album_uri"),
                album.alias("album_name"),
                (F.lit(120000) + F.lit(1000) * F.col("p_size")).cast("long").alias("track_dur_ms"))
        return self._get("tracks", build)

    def playlists(self) -> DataFrame:
        def build():
            t = self.tracks()
            per_pid = t.groupBy("pid").agg(
                F.count(F.lit(1)).alias("num_tracks"),
                F.countDistinct("artist_uri").alias("num_artists"),
                F.countDistinct("album_uri").alias("num_albums"),
                F.sum("track_dur_ms").cast("long").alias("duration_ms"))
            per_order = self.entries_wide().groupBy("pid").agg(
                F.countDistinct("order_key").alias("num_edits"),
                F.max("order_ts").alias("_last"))
            c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
            titles = F.array(*[F.lit(x) for x in TITLES])
            desc = (F.col("pid") % 53) == 0
            return (c.withColumnRenamed("c_custkey", "pid").join(per_pid, "pid").join(per_order, "pid")
                    .select(
                        "pid",
                        F.element_at(titles, (F.col("pid") % len(TITLES) + 1).cast("int")).alias("name"),
                        "num_tracks", "num_artists", "num_albums",
                        (F.col("c_nationkey") + 1).cast("long").alias("num_followers"),
                        F.col("num_edits").cast("long").alias("num_edits"),
                        "duration_ms",
                        epoch_seconds("_last").alias("modified_at"),
                        F.when(F.col("pid") % 50 == 0, "true").otherwise("false").alias("collaborative"),
                        desc.alias("has_desc"),
                        F.when(desc, F.concat(F.lit("songs for "), F.col("c_name")))
                        .otherwise(F.lit("")).alias("description")))
        return self._get("playlists", build)

    def playlist_genres(self) -> DataFrame:
        """Given labels: (pid, genre) from the market segment."""
        return self._get("playlist_genres", lambda: self.raw("customer").select(
            F.col("c_custkey").alias("pid"), F.col("c_mktsegment").alias("genre")), staged=False)

    def features(self) -> DataFrame:
        """(item, f0..f63): the components of the item's embedding."""
        def build():
            e = self.raw("embeddings")
            return e.select(F.col("vec_id").alias("item"),
                            *[F.element_at("embedding", i + 1).cast("double").alias(f"f{i}")
                              for i in range(N_FEATURES)])
        return self._get("features", build, staged=False)

    def external_features(self) -> DataFrame:
        """A feature file keyed by decorated names (artist_name, track_name).

        Decorations follow the item id: upper case, ``(feat. X)``, ``[Remix]``,
        punctuation, a foreign artist (only the title can match) and missing
        titles (no match). ``row_id`` is the file order for first-per-key rules.
        """
        def build():
            e = self.raw("embeddings").select("vec_id", "embedding")
            p = self.raw("part").select("p_partkey", "p_name", "p_brand")
            v = F.col("vec_id")
            artist = (F.when(v % 7 == 3, F.lit("Various Artists"))
                      .otherwise(F.concat(F.upper("p_brand"),
                                          F.when(v % 4 == 1, F.lit(" (feat. X)")).otherwise(F.lit("")))))
            title = (F.when(v % 11 == 5, F.lit(None).cast("string"))
                     .when(v % 3 == 0, F.upper("p_name"))
                     .when(v % 3 == 1, F.concat("p_name", F.lit(" [Remix]")))
                     .otherwise(F.concat("p_name", F.lit("!!"))))
            return e.join(p, e.vec_id == p.p_partkey, "inner").select(
                v.alias("row_id"), artist.alias("artist_name"), title.alias("track_name"),
                *[F.element_at("embedding", i + 1).cast("double").alias(f"f{i}")
                  for i in range(N_FEATURES)])
        return self._get("external_features", build)

    def documents(self) -> DataFrame:
        return self.raw("documents")


_CACHE: dict[tuple, Tables] = {}
MEMOS.append(_CACHE)

def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        bound_partitions(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ENTRY_TABLES])
        _CACHE[key] = Tables(spark, sf_dir)
    return _CACHE[key]
