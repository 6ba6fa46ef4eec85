"""Operators that work on slices of whole groups give what they give on the whole, and leave no shuffle files behind."""

import datetime
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cadence.operators import enrich as EN
from cadence.operators import features as FT
from cadence.operators import profile as P


def seen_stage(kept):
    def stage(df, name):
        kept.append((name, df))
        return df
    return stage


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_coverage_filter_in_slices(spark, monkeypatch):
    entries = spark.createDataFrame([(p, i, f"t{(p * 3 + i) % 17}") for p in range(20) for i in range(3 + p % 9)] + [(None, i, f"t{i}") for i in range(9)], "pid long, pos long, track_uri string")
    has = spark.createDataFrame([(f"t{i}", None if i % 4 == 1 else 1.0) for i in range(17)], "track_uri string, f0 double")
    want = rows(EN.coverage_filter(entries, has, "f0", 4))
    kept = []
    monkeypatch.setattr(P, "MOST_SLICES", 3)
    monkeypatch.setattr(P, "slices_for", lambda df, most=None: 3)
    got = EN.coverage_filter(entries, has, "f0", 4, stage=seen_stage(kept))
    assert rows(got) == want and want
    groups = [{r["pid"] for r in df.collect()} for _, df in kept]
    assert len(groups) == 3 and sum(map(len, groups)) == len(set().union(*groups))  # a group lies in one slice


def test_seed_profile_in_slices(spark, monkeypatch):
    cols = ["a", "b"]
    v = spark.createDataFrame([(f"t{i}", float(i), float(i * i % 7)) for i in range(30)], "track_uri string, a double, b double")
    seeds = spark.createDataFrame([(p, i, f"t{(p * 5 + i) % 40}") for p in range(25) for i in range(6)] + [(None, 0, "t3"), (None, 1, "t4")], "pid long, pos long, track_uri string")
    want = rows(FT.seed_profile(seeds, v, cols))
    kept = []
    monkeypatch.setattr(P, "slices_for", lambda df, most=None: 4)
    assert rows(FT.seed_profile(seeds, v, cols, stage=seen_stage(kept))) == want
    assert [name for name, _ in kept] == ["profile_sums"] * 4


def test_few_rows_are_one_slice(spark):
    df = spark.range(100)
    assert P.slices_for(df) == 1 and P.slices_for(df, 30) == 4 and P.slices_for(df, 1) == P.MOST_SLICES
    kept = []
    assert P.in_slices(df, "id", lambda x: x.where("id < 7"), seen_stage(kept), "one").count() == 7 and len(kept) == 1


def test_entries_in_slices_and_no_shuffle_files(spark, tmp_path, monkeypatch):
    from cadence.sources import fixtures
    day = datetime.datetime(2020, 1, 1)
    n = 300
    orders = [(i, None if i % 50 == 7 else i % 9, day + datetime.timedelta(days=i * 7 % 30)) for i in range(n)]
    lines = [(None if i % 97 == 5 else i % n, i * 11 % 40, i % 3, i // n, float(i % 5)) for i in range(4 * n)]
    pq.write_table(pa.table({"o_orderkey": pa.array([o[0] for o in orders], pa.int64()), "o_custkey": pa.array([o[1] for o in orders], pa.int64()), "o_orderdate": pa.array([o[2] for o in orders], pa.timestamp("us"))}), f"{tmp_path}/orders.parquet")
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    pq.write_table(pa.table([pa.array([x[i] for x in lines], pa.float64() if i == 4 else pa.int64()) for i in range(5)], names=names), f"{tmp_path}/lineitem.parquet")
    want = rows(fixtures.Tables(spark, str(tmp_path)).entries_wide())
    for module in (P, fixtures):
        monkeypatch.setattr(module, "slices_for", lambda df, most=None: 3)
    assert rows(fixtures.Tables(spark, str(tmp_path)).entries_wide()) == want and len(want) > n
    # Tables of entries set the session up so that an execution deletes the files of its shuffles.
    fixtures.tables(spark, str(tmp_path))
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left():
        return {os.path.basename(x) for x in local.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}

    before = left()
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    df.write.mode("overwrite").format("noop").save()
    until = time.time() + 20  # they are deleted in the background
    while left() - before and time.time() < until:
        time.sleep(0.2)
    assert not left() - before
    assert rows(df) == rows(df)  # a frame that is used again makes its shuffle anew


def test_slices_are_read_as_one_table(spark):
    """What is planned on the result is planned once, not once a slice."""
    from cadence.sources.fixtures import stage
    got = P.in_slices(spark.range(500), "id", lambda x: x.groupBy("id").count(), stage, "slices", most=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1
    assert rows(got) == [(i, 1) for i in sorted(range(500), key=lambda i: repr((i, 1)))]
