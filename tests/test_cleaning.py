"""Cleaner semantics: anomaly flag, keep-latest dedup, partition invariance."""

import datetime as dt

from pricefold.operators import cleaning

SCHEMA = ("product_name string, price string, currency string, availability string, seller string, "
          "source string, url string, scrape_timestamp timestamp_ntz, category string")


def _ts(d):
    return dt.datetime(2026, 4, d)


def test_anomaly_flags_include_zero_prices(spark):
    rows = [("a", p, "EUR", "in_stock", "s", "src", f"u{i}", _ts(1), "laptops")
            for i, p in enumerate(["0", "100", "100", "100", "400", "30", None])]
    df = spark.createDataFrame(rows, SCHEMA)
    n = cleaning.normalize(df)
    got = {r["url"]: r["is_anomaly"] for r in cleaning.flag_anomalies(n).collect()}
    # median over 0,100,100,100,400,30 = 100; strict > 300 and < 33.33
    assert got == {"u0": True, "u1": False, "u2": False, "u3": False, "u4": True, "u5": True, "u6": False}


def test_median_not_positive_skips(spark):
    rows = [("a", "0", None, None, "s", "src", f"u{i}", _ts(1), "gpus") for i in range(3)] + \
           [("a", "5", None, None, "s", "src", "u9", _ts(1), "gpus")]
    df = cleaning.normalize(spark.createDataFrame(rows, SCHEMA))
    assert all(not r["is_anomaly"] for r in cleaning.flag_anomalies(df).collect())


def test_dedup_latest(spark):
    rows = [
        ("Dell XPS", "100", "EUR", None, "s1", "amazon", "u1", _ts(1), "laptops"),
        ("Dell XPS", "100", "EUR", None, "s1", "amazon", "u2", _ts(3), "laptops"),   # latest wins
        ("Dell XPS", "100", "EUR", None, "s1", "amazon", "u3", None, "laptops"),     # null ts last
        ("Dell XPS", "100", "EUR", None, "s1", "ebay", "u4", _ts(1), "laptops"),     # other source
        (None, "100", "EUR", None, "s1", "amazon", "u5", _ts(1), "laptops"),          # null key kept
        (None, "100", "EUR", None, "s1", "amazon", "u6", _ts(1), "laptops"),          # null key kept
        ("Dell XPS", None, "EUR", None, "s1", "amazon", "u7", _ts(1), "laptops"),     # null price kept
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r["url"] for r in cleaning.clean(df).collect())
    assert got == ["u2", "u4", "u5", "u6", "u7"]


def test_clean_is_partition_invariant(spark):
    from pricefold.plans import pipeline
    from conftest import SF_SMALL
    cols = ["product_name", "url", "seller", "price_clean", "is_anomaly", "availability_clean", "category"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = pipeline.cleaned_listings(spark, SF_SMALL).select(*cols).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    b = pipeline.cleaned_listings(spark, SF_SMALL).select(*cols).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_dedup_shuffles_narrow_rows_and_keeps_the_raw_price(spark):
    """The price that is its key isn't carried beside it, no hash stands before the names, and raw prices come out unchanged."""
    import math
    given = {"a": 5.0, "b": -0.0, "c": 0.0, "d": -1.0, "e": float("nan"), "f": None}
    rows = [(n, p, "s", t, "pc", "In Stock") for n, p in given.items() for t in ("2024-01-01", "2024-01-02")] + [(None, 7.0, "s", None, "pc", None)]
    df = spark.createDataFrame(rows, "product_name string, price double, source string, scrape_timestamp string, category string, availability string")
    out = cleaning.clean(df)
    got = {}
    for r in out.collect():
        got.setdefault(r["product_name"], []).append(r["price"])
    assert got.pop(None) == [7.0]
    for name, price in given.items():
        complete = price is not None and price >= 0
        assert len(got[name]) == (1 if complete else 2)
        assert all(repr(p) == repr(price) for p in got[name]), name
    assert math.copysign(1, got["b"][0]) == -1
    aggregate = next(l for l in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "max(struct(_ts" in l)
    assert "Aggregate [product_name_clean" in aggregate


def test_lines_are_priced_before_the_listing_joins(spark):
    from pricefold.plans import tables
    plan = tables.listings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert all("AS _price" in l or "Relation" in l for l in plan.splitlines() if "l_quantity" in l)
