"""Bucketed layout of sequences."""

import random
import re
from collections import Counter

import pytest

from cadence.operators.recommend import adjacent_pairs
from cadence.session import scratch_path
from cadence.sources import layout as LY


@pytest.fixture(scope="module")
def seqs(spark):
    rnd = random.Random(8)
    rows = [(pid, p, rnd.randrange(40)) for pid in range(30) for p in range(rnd.randint(1, 25))] + [(100, p, rnd.randrange(40)) for p in range(400)]
    return spark.createDataFrame(rows, "pid long, pos long, track_idx int")


@pytest.fixture(scope="module")
def stored(spark, seqs):
    split = spark.createDataFrame([(p, "test" if p % 5 == 0 else "train") for p in [*range(30), 100]], "pid long, split string")
    path = scratch_path(spark, "layout-test")
    return LY.write_bucketed(seqs, split, path.rsplit("/", 1)[1].replace("-", "_"), path, 4, chunk=16)


def shuffles(df):
    """The plan with shuffles only where the layout asks for them: no broadcast, no adaptive changes."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    spark = df.sparkSession
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_and_partitions(spark, seqs, stored):
    assert sorted((r.pid, r.pos, r.track_idx) for r in stored.collect()) == sorted(map(tuple, seqs.collect()))
    assert {r.split for r in stored.where("pid = 100").select("split").distinct().collect()} == {"test"}
    assert "PartitionFilters: [isnotnull(split" in stored.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    # The long group lies in more than one bucket.
    per = Counter(re.search(r"_(\d{5})\.", r.f).group(1) for r in stored.where("pid = 100").selectExpr("input_file_name() as f").collect())
    assert len(per) > 1


def test_split_points_need_no_shuffle_of_the_sequences(spark, seqs, stored):
    groups = seqs.groupBy("pid").count().withColumnRenamed("count", "seq_len")
    out = LY.with_split_point(stored, groups, chunk=16)
    n = {r.pid: r.seq_len for r in groups.collect()}
    got = out.collect()
    assert len(got) == sum(n.values()) and all(r.sp == max(1, int(n[r.pid] * 0.8)) for r in got)
    small = spark.createDataFrame([(100, 400)], "pid long, seq_len long")
    plan = shuffles(LY.with_split_point(stored, small, chunk=16))
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    side = plan[: plan.index("Exchange")]
    assert "FileScan" in side and "Bucketed: true" in side  # the one shuffle stands under the groups, after the stored side


def test_pairs_equal_the_joined_ones(spark, seqs, stored):
    for lags in (1, 3, 15):
        want = Counter((r.lag, r.input, r.target) for r in adjacent_pairs(seqs, lags).collect())
        assert Counter((r.lag, r.input, r.target) for r in LY.stored_pairs(stored, lags, chunk=16).collect()) == want
    plan = shuffles(LY.stored_pairs(stored, 3, chunk=16))
    assert plan.count("Exchange") == 1  # the first rows of each stretch


def test_positions_with_gaps(spark):
    rows = [(1, 0, 5), (1, 2, 6), (1, 3, 7), (1, 15, 8), (1, 17, 9), (2, 16, 1)]
    s = spark.createDataFrame([(a, b, c, b // 16) for a, b, c in rows], "pid long, pos long, track_idx int, chunk int")
    got = sorted((r.lag, r.input, r.target) for r in LY.stored_pairs(s, 2, chunk=16).collect())
    assert got == [(1, 6, 7), (2, 5, 6), (2, 8, 9)]
