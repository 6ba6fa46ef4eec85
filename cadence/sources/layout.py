"""Stored layout of encoded sequences: partitioned by split, bucketed by group and stretch.

A sequence is cut into stretches of ``chunk`` positions, and (pid, chunk) is the
bucket key, so a group of any length lies in many buckets. Joins and windows on
(pid, chunk) read the table as it lies, without a shuffle of the sequences: seeds
and holdouts meet their group's split point there, and pairs of entries a few
positions apart lie in one stretch but for those that cross its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.operators.sequences import split_point

CHUNK = 4096


def write_bucketed(seqs: DataFrame, split: DataFrame, table: str, path: str, buckets: int, item: str = "track_idx", chunk: int = CHUNK) -> DataFrame:
    """Write ``seqs`` (pid, pos, item) with the ``split`` of its group (pid, split) as catalogue table ``table``, files under ``path``.

    Groups without a split are left out."""
    s = seqs.select("pid", "pos", item).join(split.select("pid", "split"), "pid")
    s = s.withColumn("chunk", F.floor(F.col("pos") / chunk).cast("int")).repartition(buckets, "pid", "chunk")
    s.write.partitionBy("split").bucketBy(buckets, "pid", "chunk").sortBy("pid", "chunk", "pos").option("path", path).saveAsTable(table)
    return s.sparkSession.table(table)


def read_bucketed(spark: SparkSession, table: str, split: str | None = None) -> DataFrame:
    """The stored sequences; a split reads its own partition only."""
    t = spark.table(table)
    return t if split is None else t.where(F.col("split") == split)


def with_split_point(stored: DataFrame, groups: DataFrame, ratio: float = 0.8, chunk: int = CHUNK) -> DataFrame:
    """``stored`` rows of ``groups`` (pid, seq_len) with ``sp``, where the holdout begins. A group goes to each of its stretches."""
    g = groups.select("pid", split_point("seq_len", ratio).alias("sp"), F.explode(
        F.sequence(F.lit(0), F.floor((F.col("seq_len") - 1) / chunk).cast("int"))).alias("chunk"))
    return stored.join(g, ["pid", "chunk"])


def stored_pairs(stored: DataFrame, lags: int = 1, item: str = "track_idx", chunk: int = CHUNK) -> DataFrame:
    """(lag, input, target): the items that stand ``lag`` (1..lags, under ``chunk``) positions apart.

    Within a stretch a window of at most ``chunk`` rows finds them. The first rows of
    a stretch are also sent to the one before, which alone are shuffled."""
    s = stored.select("pid", "chunk", "pos", F.col(item).alias("x"))
    order = Window.partitionBy("pid", "chunk").orderBy("pos")
    later = F.array(*[F.struct((F.lead("pos", j).over(order) - F.col("pos")).alias("lag"), F.lead("x", j).over(order).alias("target")) for j in range(1, lags + 1)])
    inside = s.withColumn("_l", later).select(F.col("x").alias("input"), F.explode("_l").alias("_l")).where(F.col("_l.lag") <= lags)
    inside = inside.select(F.col("_l.lag").cast("int").alias("lag"), "input", F.col("_l.target").alias("target"))
    heads = s.where((F.col("pos") % chunk < lags) & (F.col("chunk") > 0)).select("pid", (F.col("chunk") - 1).alias("chunk"), F.col("pos").alias("_p"), F.col("x").alias("target"))
    ends = s.where(F.col("pos") % chunk >= chunk - lags).join(heads, ["pid", "chunk"]).withColumn("lag", (F.col("_p") - F.col("pos")).cast("int"))
    return inside.unionByName(ends.where(F.col("lag") <= lags).select("lag", F.col("x").alias("input"), "target"))
