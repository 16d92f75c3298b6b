"""Unified price records (A2): header and offer rows, nested form; explicit group merge (A3)."""

import datetime as dt

from pyspark.sql import functions as F

from pricefold.operators import merging

SCHEMA = ("product_id long, canonical_name string, product_category string, source string, "
          "price_clean double, currency string, availability_clean string, seller string, url string, "
          "scrape_timestamp timestamp_ntz, is_anomaly boolean, product_name string")


def _matched(spark, n=7):
    rows = [(1, "Dell XPS", "laptop", f"src{i % 3}", 100.0 + i, None if i == 0 else "EUR", "in_stock",
             f"s{i}", f"u{i}", dt.datetime(2026, 4, 1 + i), i == 6, "dell xps") for i in range(n)]
    rows.append((2, "Pixel", "phone", "", None, "", "", "s", "u", None, False, "pixel"))
    return spark.createDataFrame(rows, SCHEMA)


def test_stats_and_offers(spark):
    m = _matched(spark)
    st = {r["product_id"]: r for r in merging.product_stats(m).collect()}
    a = st[1]
    # anomalous offer (i=6) is counted but excluded from min / max / mean
    assert (a["price_min"], a["price_max"], a["price_mean"], a["offer_count"], a["anomaly_count"]) == \
        (100.0, 105.0, 102.5, 7, 1)
    assert st[2]["price_min"] is None and st[2]["offer_count"] == 1
    o = merging.product_offers(m).where("product_id = 1").orderBy("position").collect()
    assert [(r["position"], r["url"]) for r in o] == [(i + 1, f"u{6 - i}") for i in range(7)]   # newest first
    assert {r["currency"] for r in o} == {"EUR"}           # missing currency -> EUR
    u = merging.unified_records(m, merged_at=F.lit("2026-04-07").cast("timestamp"))
    assert u.count() == 2                                  # one record per product, whatever its size
    first = u.where("product_id = 1").collect()[0]
    assert [x["url"] for x in first["prices"]] == [f"u{6 - i}" for i in range(7)] and first["offer_count"] == 7
    p = u.where("product_id = 2").collect()[0]["prices"][0]
    assert (p["source"], p["availability"], p["currency"]) == (None, "unknown", "EUR")


def test_merge_groups(spark):
    rec = spark.createDataFrame([
        (1, 1, "short", "", 10.0), (2, 2, "a much longer name", "USD", 20.0), (3, 3, "same length name!!", None, 30.0),
        (4, 4, "alone", None, 5.0)], "row_id long, pos long, product_name string, currency string, price double")
    rec = rec.withColumn("seller", F.lit("s")).withColumn("source", F.lit("x")).withColumn("url", F.lit(None).cast("string")) \
             .withColumn("availability", F.lit(None).cast("string")).withColumn("scrape_timestamp", F.lit(None).cast("string"))
    groups = spark.createDataFrame([("g1", 1), ("g1", 2), ("g1", 3), ("g2", 3)], "group_id string, row_id long")
    out = {r["group_id"]: r for r in merging.merge_groups(rec, groups, matched_by="test").collect()}
    g1 = out["g1"]
    # longest name, first on ties (rows 2 and 3 both have 18 characters)
    assert g1["product_name"] == "a much longer name" and g1["currency"] == "USD"
    assert (g1["price_min"], g1["price_max"], g1["price_mean"], g1["offer_count"]) == (10.0, 30.0, 20.0, 3)
    assert [o["price"] for o in g1["offers"]] == [10.0, 20.0, 30.0]
    assert out["g2"]["offer_count"] == 1                    # row 3 appears in both groups
    assert out["single-4"]["matched_by"] == "none" and out["single-4"]["currency"] == "EUR"
    assert set(out) == {"g1", "g2", "single-4"}


def test_exact_group_mean_half_up(spark):
    df = spark.createDataFrame([(1, 1.005), (1, 1.005), (2, 2.675), (3, -1.005), (4, None)], "g int, p double")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(merging.exact_mean2(F.col("p")).alias("m")).collect()}
    assert got == {1: 1.01, 2: 2.68, 3: -1.01, 4: None}


def test_text_prices_stay_out_of_group_statistics(spark):
    rec = spark.createDataFrame([(1, 1, "a", "1.299,99 €", None), (2, 2, "b", "10", 10.0)],
                                "row_id long, pos long, product_name string, price string, _price_number double")
    for c in ("currency", "seller", "source", "url", "availability", "scrape_timestamp"):
        rec = rec.withColumn(c, F.lit(None).cast("string"))
    groups = spark.createDataFrame([("g", 1), ("g", 2)], "group_id string, row_id long")
    r = merging.merge_groups(rec, groups).collect()[0]
    assert (r["price_min"], r["price_max"], r["price_mean"], r["offer_count"]) == (10.0, 10.0, 10.0, 2)
    assert [o["price"] for o in r["offers"]] == [None, 10.0]
    text = merging.merge_groups(rec.drop("_price_number"), groups).collect()[0]
    assert text["price_mean"] is None and text["offer_count"] == 2
