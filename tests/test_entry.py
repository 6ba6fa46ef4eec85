import __spark_entry__ as E


def test_contract(spark):
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 60
    df = E.entry(spark)
    assert df.count() == 1 and "r_at_10" in df.columns


def test_queries_run_small(spark):
    qs = E.queries()
    for n in ("vocabulary", "track_catalog", "top_popular", "genre_label"):
        assert qs[n](spark, "/root/testdata/sf0.001").count() > 0
