"""Configuration tables, work list, catalog scan, run-report sink, threshold scaling."""

import os

import yaml
from pyspark.sql import functions as F

from pricefold.operators import fuzzy
from pricefold.sources import catalog, config, sinks
from test_reports import _runs


def test_config_and_work_list(spark, tmpdir_fresh):
    products = {"laptops": [{"name": "Dell XPS 15 9530", "search_query": "Dell XPS 15*", "brand": "Dell"},
                            {"name": "No query"}],
                "gpus": [{"name": "RX 7800 XT", "search_query": "RX 7800 XT Grafikkarte"}],
                "tablets": [{"name": "Unknown category"}]}
    sources = {"amazon_de": {"display_name": "Amazon DE", "base_url": "https://a", "enabled": True,
                             "search_url_template": "https://a/s?k={query}&x=1"},
               "off": {"enabled": False, "search_url_template": "https://o/{query}"}}
    pth = os.path.join(tmpdir_fresh, "products.yaml")
    with open(pth, "w") as fh:
        yaml.safe_dump(products, fh)
    p = config.products_table(spark, config.load_yaml(pth))
    s = config.sources_table(spark, sources)
    cov = config.default_coverage(spark, sources, config.load_yaml(pth))
    wl = config.work_list(p, s, cov, categories=["laptops", "gpus"]).collect()
    got = sorted((r["source_key"], r["name"], r["search_url"]) for r in wl)
    assert got == [("amazon_de", "Dell XPS 15 9530", "https://a/s?k=Dell+XPS+15%2A&x=1"),
                   ("amazon_de", "No query", "https://a/s?k=No+query&x=1"),
                   ("amazon_de", "RX 7800 XT", "https://a/s?k=RX+7800+XT+Grafikkarte&x=1")]


def test_catalog_csv_keeps_leading_zeros(spark, tmpdir_fresh):
    header = catalog.CATALOG_SCHEMA.replace(" string", "").replace(" double", "").replace(" date", "")
    header = ",".join(x.split()[0] for x in catalog.CATALOG_SCHEMA.split(", "))
    with open(os.path.join(tmpdir_fresh, "c.csv"), "w") as fh:
        fh.write(header + "\n")
        fh.write("p2,Beta,b,m,v,gpu,s,0001234,1.5,2.5,2026-01-01" + "," * 12 + "\n")
        fh.write("p1,Alpha,b,m,v,laptop,s,0009,1,2,2026-01-02" + "," * 12 + "\n")
    df = catalog.read_catalog_csv(spark, os.path.join(tmpdir_fresh, "c.csv"))
    rows = sorted((r["ord"], r["product_id"], r["ean"]) for r in df.collect())
    assert rows == [(1, "p2", "0001234"), (2, "p1", "0009")]      # file order, single file -> rank 0


def test_run_report_sink(spark, tmpdir_fresh):
    sinks.write_run_report(_runs(spark), tmpdir_fresh, run_date=__import__("datetime").date(2026, 4, 7))
    base = os.path.join(tmpdir_fresh, "benchmark", "run_date=2026-04-07")
    assert spark.read.json(base + "/detail").count() == 14
    t = spark.read.json(base + "/totals").collect()[0]
    assert (t["total_cost_usd"], t["total_runs"]) == (0.026, 14)


def test_fuzzy_threshold_fraction_is_scaled(spark):
    cat = spark.createDataFrame([(1, "thinkpad x1 carbon", "laptop", 1)],
                                "product_id long, canonical_name string, category string, ord long")
    q = spark.createDataFrame([("thinkpad x1 yoga", "laptop")], "product_name_clean string, category string")
    a = fuzzy.match_queries(q, cat, threshold=0.8).collect()[0]     # 0.8 -> 80
    b = fuzzy.match_queries(q, cat, threshold=85).collect()[0]
    assert a["match_method"] == "token_set_ratio" and b["match_method"] == "below_threshold"
    assert round(a["raw_score"], 2) == 81.48


def test_written_keeps_rows_and_types(spark):
    from pricefold.session import ensure_checkpoint_dir, written
    df = spark.sql("select * from values (1L, null, timestamp_ntz'2024-01-02 03:04:05', 1.5D), (2L, 'ä', null, null) t(id, name, at, price)")
    back = written(df, "kept")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert all(f.startswith(("file:" + ensure_checkpoint_dir(spark), ensure_checkpoint_dir(spark))) or "/kept-" in f for f in back.inputFiles())
