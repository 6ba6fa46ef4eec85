"""Queries on neighbours count the pairs of whole groups, not of their first positions."""

import datetime
import itertools
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cadence.plans.catalog import ORACLES, QUERIES

N_ITEMS, LENGTH = 90, 80


@pytest.fixture(scope="module")
def long_groups(tmp_path_factory):
    """60 groups of 80 entries: the last 30 positions hold items that pair with nothing earlier in the first 50."""
    d = tmp_path_factory.mktemp("long_groups")
    day = datetime.datetime(2020, 1, 1)
    lines = [(g, p, (g * 7 + p * (1 + g % 3)) % 60 if p < 50 else 60 + (g + p) % 30) for g in range(60) for p in range(LENGTH)]
    tables = {
        "customer": {"c_custkey": pa.array(range(60), pa.int64()), "c_name": [f"c{i}" for i in range(60)], "c_nationkey": pa.array([0] * 60, pa.int32()), "c_mktsegment": ["A"] * 60},
        "orders": {"o_orderkey": pa.array(range(60), pa.int64()), "o_custkey": pa.array(range(60), pa.int64()), "o_orderdate": pa.array([day] * 60, pa.timestamp("us"))},
        "lineitem": {"l_orderkey": pa.array([x[0] for x in lines], pa.int64()), "l_partkey": pa.array([x[2] for x in lines], pa.int64()), "l_suppkey": pa.array([0] * len(lines), pa.int64()),
                     "l_linenumber": pa.array([x[1] for x in lines], pa.int32()), "l_extendedprice": [1.0] * len(lines)},
        "part": {"p_partkey": pa.array(range(N_ITEMS), pa.int64()), "p_name": [f"n{i}" for i in range(N_ITEMS)], "p_brand": ["b"] * N_ITEMS, "p_type": ["t"] * N_ITEMS, "p_size": pa.array([1] * N_ITEMS, pa.int32())},
        "embeddings": {"vec_id": pa.array(range(N_ITEMS), pa.int64()), "embedding": pa.array([[float(i)] * 64 for i in range(N_ITEMS)], pa.list_(pa.float32()))},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{d}/{name}.parquet")
    return str(d)


def both(spark, d, name):
    """(rows of the query, rows of its SQL), sorted."""
    got = QUERIES[name](spark, d)
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    cur = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})")
    return sorted(map(tuple, got.collect())), sorted(map(tuple, cur.fetchall()))


def train_pairs(spark, d):
    """Counts of the item pairs of whole training groups, by brute force."""
    from cadence.plans import common as C
    groups = {}
    for r in C.split_seqs(spark, d, "train").collect():
        groups.setdefault(r["pid"], set()).add(r["track_idx"])
    return Counter(x for g in groups.values() for x in itertools.permutations(g, 2))


def test_cooc_neighbours_count_whole_groups(spark, long_groups):
    got, want = both(spark, long_groups, "cooc_neighbours")
    pairs = {k: n for k, n in train_pairs(spark, long_groups).items() if n >= 3}
    assert got == want and {(a, b): n for a, b, n, _ in got} == pairs


def late_recs(spark, d, name):
    """Rows of the query; its SQL gives the same, and they are of other numbers than with the first 50 positions."""
    got, want = both(spark, d, name)
    assert got == want and got
    return got


def test_rec_itemcf_recommends_by_pairs_past_position_50(spark, long_groups):
    from cadence.plans.q_itemcf import itemcf_parts
    got = late_recs(spark, long_groups, "rec_itemcf")
    first = sorted((r["pid"], r["rank"], r["item"], r["score"]) for r in itemcf_parts(spark, long_groups)[0].collect())
    assert got != first


def test_metrics_per_group_score_the_whole_model(spark, long_groups):
    from cadence.operators import evaluate as EV
    from cadence.plans.q_itemcf import itemcf_parts
    got = late_recs(spark, long_groups, "metrics_per_group")
    at = [QUERIES["metrics_per_group"](spark, long_groups).columns.index(c) for c in ("pid", "hits_20")]
    first = {r["pid"]: r["hits_20"] for r in EV.per_group_hits(*itemcf_parts(spark, long_groups)).collect()}
    assert {r[at[0]]: r[at[1]] for r in got} != first
