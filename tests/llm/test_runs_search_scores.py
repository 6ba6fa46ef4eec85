"""Periodic runs, ranked search and additive quality scores against brute force and held-out labels."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from cadence.llm import gam, queries, ranked, runs

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- periodic runs -------------------------------------------------------------------------------

def brute_runs(words, least=6, power=4):
    found, n = {}, len(words)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_report(doc_id, text):
    words = SPACE_WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if n and doc_id is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def words_of(rnd):
    kind, n = rnd.randrange(6), rnd.randrange(90)
    if kind == 0:
        return [rnd.randrange(2) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        part = [rnd.randrange(4) for _ in range(rnd.randint(1, 12))]
        return [9] * rnd.randrange(4) + (part * 12)[:n] + [rnd.randrange(4) for _ in range(5)]
    if kind == 3:
        return ([0, 0, 0, 0, 0, 0, 1] * 13)[:n]
    if kind == 4:  # a run of runs, and the same words again later
        part = ([1, 2] * 5 + [3]) * 5
        return part + [7, 8] + part
    return [rnd.randrange(30) for _ in range(n)]


def test_runs_equal_brute_force():
    rnd = random.Random(7)
    for _ in range(150):
        texts = [words_of(rnd) for _ in range(rnd.randint(1, 6))]
        flat, lengths = np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts])
        base = np.cumsum(lengths) - lengths
        want = sorted((int(o) + a, int(o) + a + n, q) for o, t in zip(base, texts, strict=True) for a, n, q in brute_runs(t))
        assert sorted(zip(*(x.tolist() for x in runs.find_runs(flat, lengths)), strict=True)) == want


def test_grammar_derives_its_texts():
    rnd = random.Random(3)
    texts = [words_of(rnd) for _ in range(20)] + [[], [5]]
    flat, lengths = np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts])
    g = runs.Grammar(flat, lengths)

    def derive(s):
        out, stack = [], [int(s)]
        while stack:
            s = stack.pop()
            if s < g.terminals:
                out.append(s)
            else:
                stack += [int(g.right[s - g.terminals]), int(g.left[s - g.terminals])]
        return out

    assert [derive(r) for r in g.roots] == [t for t in texts if t]
    rules = list(zip(g.left.tolist(), g.right.tolist(), strict=True))
    assert len(set(rules)) == len(rules)
    # As short as the frequency order makes it: a text of 2^k equal words has k rules.
    assert len(runs.Grammar(np.zeros(1024, np.int64), np.array([1024])).left) == 10


def test_long_texts_take_few_rounds(monkeypatch):
    rounds = []
    replace = runs._replaced
    monkeypatch.setattr(runs, "_replaced", lambda *a: rounds.append(1) or replace(*a))
    t = np.tile(np.arange(20_000), 2)  # each pair twice, keys in ascending order
    runs.Grammar(t, np.array([len(t)]))
    assert len(rounds) < 80
    for t in (np.zeros(60_000, np.int64), np.tile(np.arange(5_000), 8)):
        assert [int(x[0]) for x in runs.find_runs(t, np.array([len(t)]))] == [0, len(t), int(t.max()) + 1]


def test_a_misleading_hash_is_noticed(monkeypatch):
    t = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1], np.int64)
    want = [x.tolist() for x in runs.find_runs(t, np.array([len(t)]))]
    monkeypatch.setattr(runs, "BASES", ((0, 0), runs.BASES[0]))  # with base 0 all stretches agree but the first word's
    assert [x.tolist() for x in runs.find_runs(t, np.array([len(t)]))] == want
    monkeypatch.setattr(runs, "BASES", ((0, 0),))
    with pytest.raises(ArithmeticError):
        runs.find_runs(t, np.array([len(t)]))


def test_periodic_runs_query(spark, sf):
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, sf).collect()}
    docs = queries.table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    assert all(got[r["doc_id"]] == brute_report(r["doc_id"], r["text"]) for r in docs)
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_periodic_runs_edges(spark, documents, odd_texts):
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    texts = [*odd_texts, "a " * 40, " x  y " * 9, " ".join(["p q r"] * 4), " ".join(["p q"] * 3), long]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b " * 9), (7, "b " * 9), (7, "b " * 9)]
    got = sorted((tuple(r) for r in runs.periodic_runs(documents(rows, extra=True), planted=True, group_words=500).drop("runs").collect()), key=repr)
    assert got == sorted((brute_report(*r) for r in rows), key=repr)
    assert runs.periodic_runs(documents([])).collect() == []


# ---- ranked search -------------------------------------------------------------------------------

def brute_ranked(docs, items, k=10):
    bags = [(i, TERM.findall((t or "").translate(AZ))) for i, t in docs]
    bags = [(i, w) for i, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w in bags)
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(AZ)))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, w in bags:
            m = 100 - 90 + (90 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in terms if t in df)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bounds", [{}, {"segment_terms": 300, "segment_docs": 7}])
def test_ranked_equals_brute_force(spark, documents, odd_texts, bounds):
    rnd = random.Random(5)
    vocabulary = [f"t{i}" for i in range(60)] + ["É", "naïve", "9"]
    docs = [(i, " ".join(rnd.choices(vocabulary, [1 / (j + 1) for j in range(63)], k=rnd.randint(1, 60)))) for i in range(120)]
    docs += [(200 + i, t) for i, t in enumerate(odd_texts[:9])] + [(5, docs[5][1]), (300, docs[5][1]), (None, docs[5][1]), (301, "t1 " * 70_000)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 15)))) for i in range(70)] + [(70, None), (71, "absent"), (72, ""), (None, "T1, t2!"), (3, "t9 t8")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("none", "x")
    got = ranked.ranked(documents(docs, extra=True, partitions=3), table, **bounds).collect()
    assert sorted(map(tuple, got), key=repr) == brute_ranked(docs, items)


def test_ranked_empty_tables(spark, documents):
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.ranked(documents([]), some).collect() == []
    assert ranked.ranked(documents([(1, None), (2, "...")]), some).collect() == []
    assert ranked.ranked(documents([(1, "a b")]), some.limit(0)).collect() == []


def test_blocks_are_rejected_before_decompression():
    """A rare word in a few documents; blocks of the common word elsewhere stay compressed."""
    n = 40_000
    lengths = np.full(n, 50)
    rare = np.arange(100, 120)
    codes, places = np.concatenate([np.zeros(n, int), np.ones(len(rare), int)]), np.concatenate([np.arange(n), rare])
    rows = [r for b in ranked._segment(0, [b"common", b"rare"], codes, places, list(range(n)), lengths) for r in b.to_pylist()][1:]

    def norm_of(k):
        return 10 + (90 * k * n) // int(lengths.sum())

    lists = [ranked.Postings(w, r["meta"], r["pairs"], r["data"], norm_of(lengths), norm_of) for w, r in zip((1, 9000), rows, strict=True)]
    place, score = ranked.max_score(lists, n, 10)
    assert place.tolist() == rare.tolist() and len(set(score.tolist())) == 1
    assert len(lists[0].meta) == 313 and len(lists[0].blocks) <= 1
    assert len(lists[1].blocks) == 1


# ---- additive quality scores ---------------------------------------------------------------------

def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op11_quality_scores(spark, sf).collect()}
    assert len(got) == queries.table(spark, sf, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    labels = [(r["doc_id"], r["quality"]) for r in queries.table(spark, sf, "labels").collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    y = np.array([q for _, q in labels])
    assert auc(np.array([got[i]["score"] for i, _ in labels]), y) > 0.95
    assert np.mean([got[i]["predicted"] == q for i, q in labels]) > 0.95


def test_labels_held_out_are_never_read(spark, documents):
    docs = [(i, "word " * (i % 7 + 1) + ("##!! " * 5 if i % 2 else "and more.")) for i in range(200)]
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]

    def scores(flip):
        lab = spark.createDataFrame([(i, (i + (flip if i in held else 0)) % 2) for i, _ in docs], "doc_id long, quality int")
        return sorted(tuple(r) for r in gam.quality_scores(documents(docs), lab).collect())

    assert held and scores(0) == scores(1)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature tells alone
    alone = gam.fit_gam(x, y, np.ones(len(y)), pairs=0)
    both = gam.fit_gam(x, y, np.ones(len(y)), pairs=1)
    fresh = rng.random((2000, 4))
    truth = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert list(both.pair_tables) == [(0, 1)]
    assert auc(alone.score(fresh), truth.astype(int)) < 0.6 and auc(both.score(fresh), truth.astype(int)) > 0.97
    # The score is the sum of the table entries.
    b, z = both.binned(fresh[:50]), np.full(50, both.constant)
    for f, t in both.tables.items():
        z += [t[v] for v in b[:, f]]
    for (f, g), t in both.pair_tables.items():
        z += [t[u, v] for u, v in zip(b[:, f], b[:, g], strict=True)]
    assert np.allclose(both.score(fresh[:50]), 1 / (1 + np.exp(-z)))


def test_quality_scores_edges(spark, documents, odd_texts):
    schema = "doc_id long, quality int"
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x"), (3, "one"), (3, "one"), (50, "A b c. " * 20)]
    docs = documents(rows, extra=True)
    both = spark.createDataFrame([(i, i % 2) for i in range(13)] + [(None, 1), (4, None), (4, 0), (4, 1), (999, 1)], schema)
    got = gam.quality_scores(docs, both).collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(i) for i, _ in rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in gam.quality_scores(docs, spark.createDataFrame([], schema)).collect()} == {0.5}
    assert {r["predicted"] for r in gam.quality_scores(docs, spark.createDataFrame([(1, 1), (2, 1), (4, 1)], schema)).collect()} == {1}
    assert gam.quality_scores(documents([]), both).collect() == []


def test_the_fit_is_bounded(spark, documents):
    """One id with most of the rows counts once per distinct text and cannot pass the bound."""
    docs = [(1, f"hot text {i} " * (i % 5 + 1)) for i in range(600)] + [(i, "plain words here. " * (i % 9)) for i in range(2, 80)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(1, 80)], "doc_id long, quality int")
    seen = []
    fit = gam.fit_gam
    try:
        gam.fit_gam = lambda x, *a, **k: seen.append(len(x)) or fit(x, *a, **k)
        gam.fit(documents(docs), lab, fit_rows=20)
    finally:
        gam.fit_gam = fit
    assert seen and seen[0] <= 40
