"""Gram-matrix correlation and name consistency."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import profile as P
from cadence.operators import quality as Q


def test_gram_corr_with_gaps_offsets_and_constants(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6))
    x[:, 1] = 0.5 * x[:, 0] + 0.1 * x[:, 1]
    x[:, 2] += 1e7  # a large offset
    x[rng.random((500, 6)) < 0.1] = np.nan
    x[:, 4] = 3.0
    x[1:, 5] = np.nan
    cols = [f"c{i}" for i in range(6)]
    rows = [tuple(None if np.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]  # nulls and NaN
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {(r["a"], r["b"]): r["r"] for r in P.gram_corr(df, cols).collect()}
    assert len(got) == 36
    for i in range(6):
        for j in range(6):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 4 in (i, j) or 5 in (i, j):
                assert got[cols[i], cols[j]] is None
            else:
                assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6 if 2 in (i, j) else 2e-9)
    empty = P.gram_corr(df.limit(0), cols[:2]).collect()
    assert all(r["r"] is None for r in empty)


def brute_names(rows):
    out = []
    for kind, uri, name in (("artist", 2, 3), ("album", 4, 5), ("track", 6, 7)):
        first = {}
        for r in sorted(rows, key=lambda r: (r[0], r[1])):
            if r[uri] is not None:
                first.setdefault(r[uri], r[name])
        out += [(f"mismatch_{kind}_name", r[0], r[1], " | ".join(x for x in (r[name], first[r[uri]]) if x is not None))
                for r in rows if r[uri] is not None and r[name] != first[r[uri]]]
    return sorted(out)


def test_name_consistency_equals_brute_force(spark):
    rows = [(pid, pos, f"a{(pid + pos) % 5}", f"n{(pid + pos) % 5}", f"b{pos % 3}", f"m{pos % 3}", f"t{pos}", f"k{pos}") for pid in range(20) for pos in range(12)]
    odd = {(3, 4): (3, "other"), (0, 1): (5, "first is odd"), (7, 2): (7, None), (9, 9): (2, None), (11, 0): (7, "late")}
    rows = [tuple(odd[r[0], r[1]][1] if (r[0], r[1]) in odd and i == odd[r[0], r[1]][0] else v for i, v in enumerate(r)) for r in rows]
    df = spark.createDataFrame(rows, "pid long, pos long, artist_uri string, artist_name string, album_uri string, album_name string, track_uri string, track_name string").repartition(5)
    got = sorted(tuple(r) for r in Q.name_consistency(df).collect())
    assert got == brute_names(rows) and len({r[0] for r in got}) == 3
    clean = df.withColumn("artist_name", F.col("artist_uri")).withColumn("album_name", F.col("album_uri")).withColumn("track_name", F.col("track_uri"))
    assert Q.name_consistency(clean).collect() == []
