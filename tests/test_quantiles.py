"""Exact quantiles from a sketch and one selecting pass."""

import numpy as np
import pytest

from cadence.operators import quantiles as Q
from cadence.operators.profile import describe_exact, trimmed_stats


def table(spark, columns, by=None, partitions=5):
    names = list(columns)
    rows = list(zip(*(c.tolist() if hasattr(c, "tolist") else c for c in columns.values()), strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == by else 'double'}" for n in names)).repartition(partitions)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    n = 6000
    return {"wide": rng.normal(size=n) * 10.0 ** rng.integers(-9, 9, n), "ties": rng.integers(0, 4, n).astype(float), "one": np.full(n, 7.5),
            "ends": np.where(np.arange(n) % 2, -1.7e308, 1.7e308), "skew": np.exp(rng.normal(size=n) * 3)}


PROBS = [0.0, 0.01, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("small", [50_000, 0])
def test_quantiles_are_exact(spark, data, small, monkeypatch):
    """Also with the brackets of the sketch for small columns."""
    monkeypatch.setattr(Q, "SMALL", small)
    monkeypatch.setattr(Q, "ACCURACY", 200)
    got = Q.exact_quantiles(table(spark, data), list(data), PROBS)
    for c, x in data.items():
        if c != "ends":
            assert np.allclose(got[None, c], np.quantile(x, PROBS), rtol=1e-12, atol=0), c
    assert got[None, "ends"][0] == -1.7e308 and got[None, "ends"][-1] == 1.7e308


def test_a_sketch_that_misleads_costs_a_pass_but_no_exactness(spark, data, monkeypatch):
    df, want = table(spark, {"x": data["skew"]}), np.quantile(data["skew"], PROBS)
    monkeypatch.setattr(Q.Sketch, "bracket", lambda self, rank: (0.9, 1.1))
    assert np.allclose(Q.exact_quantiles(df, ["x"], PROBS)[None, "x"], want, rtol=1e-12)


def test_two_passes_and_few_values_shuffled(spark, monkeypatch):
    n = 200_000
    df = spark.range(n, numPartitions=4).selectExpr("cast(pmod(xxhash64(id), 1000003) as double) as x")
    monkeypatch.setattr(Q, "ACCURACY", 2000)
    monkeypatch.setattr(Q, "SMALL", 1000)
    s = Q.sketch(df, ["x"], [0.1, 0.5])
    x = np.sort(df.toPandas()["x"].to_numpy())
    for r in (n // 10, n // 2, 12_345):
        lo, hi = s[None, "x"].bracket(r)
        assert lo <= x[r] <= hi
    for r in (int(0.1 * (n - 1)), int(0.5 * (n - 1))):
        lo, hi = s[None, "x"].bracket(r)
        assert ((x >= lo) & (x <= hi)).sum() <= 8 * n / 2000
    monkeypatch.setattr(Q, "sketch", lambda *a: 1 / 0)
    assert Q.exact_quantiles(df, ["x"], [0.1, 0.5], sketches=s)[None, "x"] == pytest.approx(np.quantile(x, [0.1, 0.5]).tolist(), rel=1e-12)


def test_keys_nulls_nan_and_empty(spark):
    rows = [("a", 1.0, None), ("a", float("nan"), None), ("a", 3.0, None), (None, 5.0, None), (None, 6.0, 2.0), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    assert Q.exact_quantiles(df, ["x", "y"], [0.5], by="k") == {("a", "x"): [2.0], (None, "x"): [5.5], (None, "y"): [2.0]}
    assert Q.exact_quantiles(df, ["x", "y"], [0.0, 1.0]) == {(None, "x"): [1.0, 6.0], (None, "y"): [2.0, 2.0]}
    assert Q.exact_quantiles(df.limit(0), ["x"], [0.5]) == {}
    assert trimmed_stats(df.limit(0), ["x"]).collect() == [] and describe_exact(df.limit(0), ["x"]).collect() == []


def test_trimmed_stats_and_describe(spark, data):
    cols = [c for c in data if c != "ends"]
    df = table(spark, {c: data[c] for c in cols})
    got = {r["variable"]: r for r in trimmed_stats(df, cols, digits=6).collect()}
    desc = {r["variable"]: r for r in describe_exact(df, cols).collect()}
    for c in cols:
        lo, hi = np.quantile(data[c], [0.1, 0.9])
        t = data[c][(data[c] >= lo) & (data[c] <= hi)]
        assert np.allclose([got[c]["trimmed_median"], got[c]["trimmed_mean"], got[c]["trimmed_std"], got[c]["p_lo"], got[c]["p_hi"]],
                           [np.median(t), t.mean(), t.std(ddof=1), lo, hi], rtol=1e-9, atol=1e-6)
        assert desc[c]["count"] == len(data[c]) and np.allclose([desc[c]["p25"], desc[c]["p50"], desc[c]["p75"]], np.quantile(data[c], [0.25, 0.5, 0.75]), rtol=1e-9, atol=1e-9)
