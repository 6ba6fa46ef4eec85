"""Scratch folders of a session."""

import os

from cadence import session as S


def test_scratch_folders_are_fresh_and_can_be_cleared(spark):
    from cadence.plans import common as C
    kept = S._SCRATCH.pop(S.session_key(spark), [])
    memo = dict(C._MEMO)
    try:
        a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
        assert a != b
        spark.range(3).write.parquet(a)
        C._MEMO[(S.session_key(spark), "dir", "stage")] = 1
        C._MEMO[("other session", "dir", "stage")] = 2
        assert os.path.exists(a) and S.clear_scratch(spark) == 1 and not os.path.exists(a)
        assert (S.session_key(spark), "dir", "stage") not in C._MEMO and ("other session", "dir", "stage") in C._MEMO
        assert S.clear_scratch(spark) == 0
    finally:
        C._MEMO.clear()
        C._MEMO.update(memo)
        S._SCRATCH[S.session_key(spark)] = kept


def test_local_masters(spark):
    assert S.is_local(spark)


def test_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    from cadence import session as SE
    (tmp_path / "t.parquet").mkdir()
    (tmp_path / "t.parquet" / "a").write_bytes(b"x" * 1000)
    first, advisory = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = {k: spark.conf.get(k, None) for k in (first, advisory)}
    try:
        spark.conf.unset(first)
        spark.conf.set(advisory, "64m")
        assert SE.bound_partitions(spark, [str(tmp_path / "t.parquet"), str(tmp_path / "none")]) == 8
        assert spark.conf.get(advisory) == str(SE.PARTITION_BYTES)
        monkeypatch.setattr(SE, "INPUT_BYTES", 100)
        assert SE.bound_partitions(spark, [str(tmp_path / "t.parquet")]) == 10
        spark.conf.set(advisory, "1m")
        assert SE.bound_partitions(spark, []) == 10 and spark.conf.get(advisory) == "1m"
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scan_tasks_do_not_grow_with_the_input(spark, tmp_path):
    """A stage table takes a few bytes a row: 128 MB of it are tens of millions of rows to one task."""
    from cadence.session import SCAN_BYTES, bound_partitions
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        bound_partitions(spark, [])
        assert int(spark.conf.get(key).rstrip("b")) == SCAN_BYTES
        spark.conf.set(key, "1m")  # finer settings are kept
        bound_partitions(spark, [])
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
