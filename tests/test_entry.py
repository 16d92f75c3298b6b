"""Driver contract: entry runs, registry is consistent, oracle keys are queries."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"product_id", "price_min", "price_max", "price_mean", "offer_count"}


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
