"""Positions, dense indexes and running sums without single-task windows.

A plain ``row_number().over(Window.orderBy(...))`` moves every row into one
task, and ``Window.partitionBy(g)`` does the same for a hot group ``g``. The
helpers here split the ordering into *buckets* (a monotone coarsening of the
order key, e.g. ``(freq, uri prefix)`` or ``(pid, day)``):

1. count (and sum) rows per bucket -- a partial aggregate, small output;
2. running offsets over the bucket table, level by level: a window only runs
   over the siblings under one prefix of the bucket columns, so with a coarse
   first column (an order of magnitude, at most 63 values) no task sees all
   buckets;
3. join the offsets back (null-safe: null keys are buckets like any other) and
   number rows inside each bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_index(df: DataFrame, *, bucket: Sequence[str], bucket_order: Sequence[Column],
                  row_order: Sequence[Column], partition_by: Sequence[str] = (),
                  index_col: str = "idx", weight: str | None = None,
                  cum_col: str | None = None) -> DataFrame:
    """Add a 0-based ``index_col`` = position of the row inside ``partition_by``
    under the total order (bucket_order, row_order).

    ``bucket`` columns must be a coarsening of the order: every row of a bucket
    sorts after every row of the buckets before it. With ``weight``/``cum_col``
    the inclusive running sum of ``weight`` in the same order is added too.
    """
    keys = list(partition_by) + list(bucket)
    aggs = [F.count(F.lit(1)).alias("_b_n")]
    if weight:
        aggs.append(F.sum(weight).alias("_b_w"))
    # Offsets level by level: buckets are counted under each prefix of the bucket
    # columns, and a running sum only runs over the siblings under one prefix.
    off = df.groupBy(*keys).agg(*aggs)
    sums = [c for c in ("_b_n", "_b_w") if c in off.columns]
    total = {c: F.lit(0) for c in sums}
    for level in range(len(bucket), 0, -1):
        above, own = keys[: len(partition_by) + level - 1], keys[: len(partition_by) + level]
        order = bucket_order[level - 1] if len(bucket_order) == len(bucket) else None
        if order is None:
            raise ValueError("bucket_order needs one order per bucket column")
        w = Window.partitionBy(*above).orderBy(order)
        level_sums = off.groupBy(*own).agg(*[F.sum(c).alias(f"_s{c}") for c in sums])
        run = level_sums.select(*[F.col(k).alias(f"_k{k}") for k in own], *[
            F.coalesce(F.sum(f"_s{c}").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_o{level}{c}") for c in sums])
        off = off.join(run, _same(own), "inner").drop(*[f"_k{k}" for k in own])
        total = {c: total[c] + F.col(f"_o{level}{c}") for c in sums}
    names = {"_b_n": "_b_off", "_b_w": "_b_woff"}
    offsets = off.select(*[F.col(k).alias(f"_k{k}") for k in keys], *[total[c].alias(names[c]) for c in sums])
    j = df.join(offsets, _same(keys), "inner").drop(*[f"_k{k}" for k in keys])
    inside = Window.partitionBy(*keys).orderBy(*row_order)
    out = j.withColumn(index_col, (F.col("_b_off") + F.row_number().over(inside) - 1).cast("long"))
    if weight:
        run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn(cum_col or "cum", F.col("_b_woff") + F.sum(weight).over(run))
        out = out.drop("_b_woff")
    return out.drop("_b_off")


def _same(keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with their copies named ``_k<key>``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{k}"))
    return cond


def magnitude(c: str | Column) -> Column:
    """Binary order of magnitude of a positive count: at most 63 values, the coarsest bucket of an order by count."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(F.log2(F.greatest(col, F.lit(1)).cast("double"))).cast("int")


def key_prefix(c: str | Column, skip: int = 0, length: int = 2) -> Column:
    """Leading characters of a key after a constant prefix of ``skip`` characters,
    used as the bucket part of an order on that key."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col.cast("string"), skip + 1, length)


def renumber(df: DataFrame, group: str = "pid", pos: str = "pos", out: str = "pos",
             block: int = 1024) -> DataFrame:
    """Re-number positions 0..n-1 per group after rows were removed (cumcount).

    Buckets are blocks of ``block`` old positions, so a hot group is numbered
    by many tasks.
    """
    d = df.withColumn("_blk", F.floor(F.col(pos) / F.lit(block)))
    r = ordered_index(d, partition_by=[group], bucket=["_blk"], bucket_order=[F.col("_blk")],
                      row_order=[F.col(pos)], index_col="_newpos")
    return r.drop("_blk").drop(pos).withColumnRenamed("_newpos", out) if out == pos else \
        r.drop("_blk").withColumnRenamed("_newpos", out)
