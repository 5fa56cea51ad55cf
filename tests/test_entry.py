import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"shard_id", "docs_in", "docs_out"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
