import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import recommend as R


def _random_seqs(seed=1, groups=60, items=25):
    rnd = random.Random(seed)
    rows = []
    for pid in range(groups):
        n = rnd.randint(2, 70)
        for pos in range(n):
            rows.append((pid, pos, rnd.randint(0, items)))
    return rows


def test_cooccurrence_and_itemcf_match_brute_force(spark):
    rows = _random_seqs()
    df = spark.createDataFrame(rows, "pid long, pos long, track_idx int")
    seqs = defaultdict(list)
    for pid, pos, it in sorted(rows):
        seqs[pid].append(it)
    cnt = Counter()
    for s in seqs.values():
        u = list(dict.fromkeys(s[:50]))
        for a, b in itertools.combinations(u, 2):
            cnt[(a, b)] += 1
            cnt[(b, a)] += 1
    exp = {k: v for k, v in cnt.items() if v >= 3}
    got = {(r["item"], r["neighbour"]): r["cnt"] for r in R.cooccurrence(df, 50, 3).collect()}
    assert got == exp
    nb = R.neighbours(R.cooccurrence(df, 50, 3), 5)
    nlist = defaultdict(list)
    for (a, b), c in exp.items():
        nlist[a].append((-c, b))
    idx = {a: [b for _, b in sorted(v)[:5]] for a, v in nlist.items()}
    seeds = df.where(F.col("pos") < 10)
    recs = R.rec_itemcf(seeds, nb, k=7).collect()
    for pid in range(5):
        seed = seqs[pid][:10]
        sc = Counter()
        for t in seed:
            for x in idx.get(t, []):
                if x not in set(seed):
                    sc[x] += 1
        exp_r = [x for x, _ in sorted(sc.items(), key=lambda kv: (-kv[1], kv[0]))[:7]]
        got_r = [r["item"] for r in sorted((r for r in recs if r["pid"] == pid), key=lambda r: r["rank"])]
        assert got_r == exp_r


@pytest.mark.parametrize("block_items", [4, 30, 1000])
def test_whole_group_pairs_with_a_hot_group(spark, block_items):
    """One group holds a third of all entries; its pairs are dealt to many join keys and counted once."""
    rnd = random.Random(11)
    rows = [(0, p, rnd.randrange(120)) for p in range(260)]
    rows += [(pid, p, rnd.randrange(120)) for pid in range(1, 27) for p in range(20)]
    rows += [(30, 0, 5), (30, 1, None), (31, 0, 7), (31, 1, 7)]
    df = spark.createDataFrame(rows, "pid long, pos long, track_idx int")
    groups = defaultdict(set)
    for pid, _, it in rows:
        if it is not None:
            groups[pid].add(it)
    cnt = Counter(pair for g in groups.values() for pair in itertools.permutations(g, 2))
    kept = {}
    got = R.cooccurrence(df, None, 3, block_items=block_items, stage=lambda d, name: kept.setdefault(name, d))
    assert {(r["item"], r["neighbour"]): r["cnt"] for r in got.collect()} == {k: v for k, v in cnt.items() if v >= 3}
    # Items of fewer than min_count groups are gone before any pair is made.
    assert kept["group_items_often"].groupBy("track_idx").count().where("count < 3").count() == 0


def test_a_hot_group_meets_in_bounded_keys(spark):
    df = spark.createDataFrame([(pid, p, p) for pid in range(3) for p in range(500)], "pid long, pos long, track_idx int")
    pairs = R.whole_group_pairs(df, 3, "track_idx", "pid", 50)
    assert pairs.count() == 3 * 500 * 499 // 2 and pairs.distinct().count() == 500 * 499 // 2


def test_label_recommender_skips_seen_and_unknown(spark):
    pop = spark.createDataFrame([("rock", i + 1, f"t{i}", 100 - i) for i in range(10)],
                                "genre string, rank long, track_uri string, cnt long")
    seeds = spark.createDataFrame([(1, 0, "t0"), (1, 1, "t2"), (2, 0, "x")], "pid long, pos long, track_uri string")
    inferred = spark.createDataFrame([(1, "rock"), (2, "unknown")], "pid long, inferred string")
    recs = R.rec_by_label(seeds, inferred, pop, k=3).collect()
    assert sorted((r["rank"], r["item"]) for r in recs if r["pid"] == 1) == [(1, "t1"), (2, "t3"), (3, "t4")]
    assert not [r for r in recs if r["pid"] == 2]


def test_next_item_lags_exact_with_small_cut(spark):
    rows = _random_seqs(seed=9, groups=40, items=12)
    df = spark.createDataFrame(rows, "pid long, pos long, track_idx int")
    V = 10
    lt = R.lag_transitions(df, 3, V)
    seqs = defaultdict(list)
    for pid, pos, it in sorted(rows):
        seqs[pid].append(it if it < V else V + 1)
    cnt = Counter()
    for s in seqs.values():
        for t in range(len(s)):
            for lag in (1, 2, 3):
                if t + lag < len(s):
                    cnt[(lag, s[t], s[t + lag])] += 1
    tot = Counter()
    for (lag, a, _), c in cnt.items():
        tot[(lag, a)] += c
    seeds = df.where(F.col("pos") < 6).withColumn(
        "track_idx", F.when(F.col("track_idx") < V, F.col("track_idx")).otherwise(V + 1))
    got = R.rec_next_item_lags(seeds, lt, V, k=4, lags=3, vocab_limit=V, cut=1).collect()
    for pid in range(10):
        ctx = [it if it < V else V + 1 for it in seqs[pid][:6]][-3:][::-1]
        sc = Counter()
        for lag, a in enumerate(ctx, 1):
            for (l2, a2, b), c in cnt.items():
                if l2 == lag and a2 == a and b < V:
                    sc[b] += c / tot[(lag, a)] / lag
        ranked = [b for b, _ in sorted(sc.items(), key=lambda kv: (-round(kv[1], 12), kv[0]))][:4]
        ranked += [i for i in range(4) if i not in ranked][: 4 - len(ranked)]
        g = [r["item"] for r in sorted((r for r in got if r["pid"] == pid), key=lambda r: r["rank"])]
        assert g == ranked


def test_label_recommender_with_a_large_group(spark):
    """One group holds 30 % of the entries; block sizes change nothing."""
    pop = spark.createDataFrame([(g, i + 1, f"{g}{i}", 1000 - i) for g in ("rock", "jazz") for i in range(500)],
                                "genre string, rank long, track_uri string, cnt long")
    rows = [(0, p, f"rock{p}") for p in range(300)] + [(pid, p, f"jazz{(pid * p) % 40}") for pid in range(1, 71) for p in range(10)]
    seeds = spark.createDataFrame(rows, "pid long, pos long, track_uri string")
    inferred = spark.createDataFrame([(pid, "rock" if pid == 0 else "jazz") for pid in range(71)], "pid long, inferred string")
    got = [sorted((r["pid"], r["rank"], r["item"]) for r in R.rec_by_label(seeds, inferred, pop, k=5, block=b).collect()) for b in (64, 7)]
    assert got[0] == got[1]
    assert [x for p, _, x in got[0] if p == 0] == [f"rock{i}" for i in range(300, 305)]
    for pid in (1, 7, 70):
        seen = {u for p, _, u in rows if p == pid}
        assert [x for p, _, x in got[0] if p == pid] == [f"jazz{i}" for i in range(500) if f"jazz{i}" not in seen][:5]


def test_transitions_count_whole_sequences(spark):
    """Positions past 50 count like any other, whatever the lag."""
    seq = [i % 7 for i in range(130)]
    df = spark.createDataFrame([(1, p, x) for p, x in enumerate(seq)], "pid long, pos long, track_idx int")
    for lags in (1, 3):
        got = {(r["lag"], r["input"], r["target"]): r["n"] for r in R.adjacent_pairs(df, lags).groupBy("lag", "input", "target").agg(F.count("*").alias("n")).collect()}
        assert got == Counter((k, a, b) for k in range(1, lags + 1) for a, b in zip(seq, seq[k:], strict=False))


def test_next_item_without_seen_items_is_complete(spark):
    seeds = spark.createDataFrame([(1, p, p) for p in range(6)], "pid long, pos long, track_idx int")
    trans = R.transitions(spark.createDataFrame([(5, 0), (5, 1), (5, 9), (5, 9)], "input int, target int"))
    for n, want in ((40, [9, 6, 7, 8, 10]), (10, [9, 6, 7, 8])):
        got = R.rec_next_item(seeds, trans, n, k=5, exclude_seen=True).orderBy("rank").collect()
        assert [r["item"] for r in got] == want
    assert [r["item"] for r in R.rec_next_item(seeds, trans, 40, k=5).orderBy("rank").collect()] == [9, 0, 1, 2, 3]


def test_unseen_successors_with_one_large_seed(spark):
    """A group that has seen nearly everything goes deep by itself; the others stay at their own depth."""
    trans = spark.createDataFrame([(0, t, 100 - t, (100 - t) / 5000) for t in range(1, 99)], "input int, target int, cnt long, prob double")
    rows = [(1, p, p + 1) for p in range(90)] + [(1, 90, 0)] + [(2, 0, 5), (2, 1, 0)] + [(3, 0, 0)] + [(4, 0, 200)]
    seeds = spark.createDataFrame(rows, "pid long, pos long, track_idx int")
    for block in (2, 7, 64):
        got = defaultdict(list)
        for r in R.rec_next_item(seeds, trans, 150, k=5, exclude_seen=True, block=block).orderBy("rank").collect():
            got[r["pid"]].append(r["item"])
        assert got == {1: [91, 92, 93, 94, 95], 2: [1, 2, 3, 4, 6], 3: [1, 2, 3, 4, 5], 4: [0, 1, 2, 3, 4]}


def test_label_from_a_seed_sample(spark):
    rows = [(1, p, "x" if p % 3 else "y") for p in range(300)] + [(2, 0, "y"), (3, 0, "z")]
    seeds = spark.createDataFrame(rows, "pid long, pos long, track_uri string").repartition(6)
    some = R.seed_sample(seeds, 25)
    by = Counter(r["pid"] for r in some.collect())
    assert by == {1: 25, 2: 1, 3: 1}
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, R.seed_sample(seeds.repartition(2), 25).collect()))
    labels = spark.createDataFrame([("x", "rock"), ("y", "jazz")], "track_uri string, genre string")
    groups = seeds.select("pid").distinct()
    votes = Counter({"x": "rock", "y": "jazz"}[r["track_uri"]] for r in some.where("pid = 1").collect())
    got = {r["pid"]: r["inferred"] for r in R.infer_label(seeds, labels, groups, sample_n=25).collect()}
    assert got == {1: min(votes, key=lambda g: (-votes[g], g)), 2: "jazz", 3: "unknown"}


def test_pair_counting_is_dealt_by_its_rows(spark, monkeypatch):
    """Many small tasks count the same pairs as one; no task holds more than its share of them."""
    from cadence.operators import recommend as R
    seqs = spark.createDataFrame([(p, i, (p * 7 + i * i) % 11) for p in range(40) for i in range(8)], "pid long, pos long, track_idx int")
    want = None
    for most in (R.PAIRS_PER_TASK, 50):
        monkeypatch.setattr(R, "PAIRS_PER_TASK", most)
        monkeypatch.setattr(R, "tasks_for", lambda rows, per=most: max(1, -(-int(rows or 0) // per)))
        got = [sorted(map(tuple, R.cooccurrence(seqs, n, 2).collect())) for n in (5, None)]
        recs = sorted(map(tuple, R.rec_itemcf(seqs.where("pos < 4"), R.neighbours(R.cooccurrence(seqs, 5, 2)), 3).collect()))
        want = want or (got, recs)
        assert (got, recs) == want and got[0] and recs
    plan = R.cooccurrence(seqs, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_adjacent_pairs_shuffle_a_row_once(spark):
    """Stretches of any length give the pairs of whole sequences, with positions held twice, gaps and null keys; inputs may be named."""
    rows = [(1, p, p * 5 % 7) for p in range(40)] + [(1, 8, 3), (1, 9, 3), (2, 3, 1), (2, 6, 2), (2, 7, None), (2, 8, 4), (None, 0, 1), (None, 1, 2)]
    df = spark.createDataFrame(rows, "pid long, pos long, track_idx int")
    want = Counter((b - a, x, y) for p, a, x in rows for q, b, y in rows if p is not None and p == q and 1 <= b - a <= 3)

    def got(**kw):
        return Counter(map(tuple, R.adjacent_pairs(df, 3, **kw).collect()))

    assert got() == want and got(stretch=4) == want and got(stretch=1) == want
    inputs = spark.createDataFrame([(3,), (5,), (77,)], "input int")
    assert got(inputs=inputs, stretch=5) == Counter({k: n for k, n in want.items() if k[1] in (3, 5)})
    lists = {tuple(r) for r in R.lag_transitions(df, 3).collect()}
    assert {tuple(r) for r in R.lag_transitions(df, 3, inputs=inputs).collect()} == {r for r in lists if r[1] in (3, 5)}
    assert all(r[1] is not None for r in lists)
    path = R.adjacent_pairs(df, 3)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in path  # rows are not sent to three places to be joined there


def test_hits_do_not_broadcast_holdouts(spark, tmp_path):
    """Holdouts that repeat fill hardly any file; a broadcast table of them would still hold each."""
    from cadence.operators import evaluate as EV
    path = str(tmp_path / "h")
    spark.range(3000).select((F.col("id") % 30).alias("pid"), (F.col("id") % 100).cast("int").alias("track_idx")).distinct().write.parquet(path)
    hold = spark.read.parquet(path)
    recs = hold.select("pid", F.lit(1).alias("rank"), F.col("track_idx").alias("item"))
    ev = hold.groupBy("pid").agg(F.count("*").alias("n_holdout")).withColumn("next_item", F.lit(None).cast("int"))
    per = EV.per_group_hits(recs, hold, ev)
    joins = [x for x in per._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x and "item" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert {r["hits_1"] for r in per.collect()} == {r["n_holdout"] for r in ev.collect()}
