"""Catalogue search: index, early termination, odd requests."""

import random
from collections import defaultdict

from cadence.operators import search as SR
from cadence.session import scratch_path

CAT = "corpus_idx long, track_uri string, track_name string, artist_name string"


def brute(cat, requests, k):
    out = []
    for rid, q in requests:
        q = (q or "").strip().lower()
        hits = [c for c in sorted(cat, key=lambda c: c[0]) if q in (c[2] or "").lower() or q in (c[3] or "").lower()][:k]
        out += [(rid, r, *c) for r, c in enumerate(hits, 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_catalog_search_is_literal_substring(spark):
    names = [("Sicko Mode", "Travis Scott"), ("a.b (remix)", "X"), ("HUMBLE.", "Kendrick Lamar"),
             ("Mode", "Depeche Mode"), ("zz", "q")]
    cat = spark.createDataFrame([(i, f"u{i}", n, a) for i, (n, a) in enumerate(names)],
                                "corpus_idx long, track_uri string, track_name string, artist_name string")
    reqs = spark.createDataFrame([("r1", "mode"), ("r2", "a.b"), ("r3", ""), ("r4", " KEN"), ("r5", "(re"),
                                  ("r6", "nothing")], "request_id string, query string")
    got = defaultdict(list)
    for r in sorted(SR.search(SR.build_index(cat, scratch_path(spark, 'search')), reqs, 3).collect(), key=lambda r: r["rank"]):
        got[r["request_id"]].append(r["corpus_idx"])
    for rid, q in [("r1", "mode"), ("r2", "a.b"), ("r3", ""), ("r4", " KEN"), ("r5", "(re"), ("r6", "nothing")]:
        qq = q.lower().strip()
        exp = [i for i, (n, a) in enumerate(names) if qq in n.lower() or qq in a.lower()][:3]
        assert got.get(rid, []) == exp


def test_empty_request_with_gaps_in_the_catalogue(spark):
    cat = spark.createDataFrame([(i, f"u{i}", "n", "a") for i in (0, 1, 5, 9)], "corpus_idx long, track_uri string, track_name string, artist_name string")
    got = SR.search(SR.build_index(cat, scratch_path(spark, 'search')), spark.createDataFrame([("r", " ")], "request_id string, query string"), 3).orderBy("rank").collect()
    assert [r["corpus_idx"] for r in got] == [0, 1, 5]


def random_catalog(n, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("aabcdeÉ ", k=rnd.randint(1, 8)))
    return [(i, f"u{i}", None if i % 41 == 3 else word(), None if i % 37 == 5 else word().upper()) for i in range(n)]


def test_search_equals_brute_force_for_any_blocks(spark):
    cat = random_catalog(600, 1)
    requests = [(str(i), q) for i, q in enumerate(["a", "b", "E", "é", "ab", " BA ", "abc", "aab", "cde a", "zz", "aaaaaaaa", "", None, "dE", "%", "a b", "  ", "ed"])]
    table, req = spark.createDataFrame(cat, CAT), spark.createDataFrame(requests, "request_id string, query string")
    for first, growth, per_round in ((8, 2, 4), (50, 3, 64), (10_000, 4, 64)):
        index = SR.build_index(table, scratch_path(spark, "search"), first_block=first, growth=growth)
        assert rows(SR.search(index, req, 10, per_round)) == brute(cat, requests, 10)
    again = SR.SearchIndex(index.items, index.postings, index.counts)
    assert rows(SR.search(again, req, 3)) == brute(cat, requests, 3)


def test_frequent_requests_read_the_first_blocks_only(spark):
    cat = [(i, f"u{i}", "song a" if i % 2 else "other", "x") for i in range(5000)] + [(5000, "u5000", "needle", "x")]
    index = SR.build_index(spark.createDataFrame(cat, CAT), scratch_path(spark, "search"), first_block=64, growth=4)
    read, hits = {}, []

    def stage(df, name):
        if name == "search_plan":
            read["blocks"] = sorted((r["request_id"], r["block"]) for r in df.collect() if r["before"] < 64)
        hits.append(name)
        return df

    requests = [("one letter", "a"), ("empty", ""), ("rare", "needle")]
    got = rows(SR.search(index, spark.createDataFrame(requests, "request_id string, query string"), 10, stage=stage))
    assert got == brute(cat, requests, 10)
    blocks = index.items.select("block").distinct().count()
    assert blocks == 5
    # Of the first block, 32 hold an a: the next block is read too, then the round is full; the empty request is done with one.
    assert [b for r, b in read["blocks"] if r == "one letter"] == [0, 1] and [b for r, b in read["blocks"] if r == "empty"] == [0]
    # The rare request finds its block by the counts and reads no other.
    assert [b for r, b in read["blocks"] if r == "rare"] == [4]
    # Requests that are done are left out of the later rounds, and blocks that nobody asks for are not read.
    plan = SR.search(index, spark.createDataFrame(requests[2:], "request_id string, query string"), 10)._jdf.queryExecution().toString()
    assert "block" in plan and "PartitionFilters: [" in plan


def test_an_empty_catalogue_and_no_requests(spark):
    none = SR.build_index(spark.createDataFrame([], CAT), scratch_path(spark, "search"))
    req = spark.createDataFrame([("r", "a"), ("e", "")], "request_id string, query string")
    assert SR.search(none, req).collect() == []
    some = SR.build_index(spark.createDataFrame(random_catalog(20, 2), CAT), scratch_path(spark, "search"))
    assert SR.search(some, req.limit(0)).collect() == []
