"""Incremental ingest: two availableNow runs, the second merging by URL."""

import json
import os

import pytest

from pricefold.sources import raw
from pricefold.streaming import ingest


def _write(path, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(recs, fh)


def _rec(name, url, price):
    return {"product_name": name, "price": price, "url": url, "source": "amazon_de", "category": "laptops"}


def test_ingest_available_now(spark, tmpdir_fresh):
    root, table, ck = tmpdir_fresh + "/raw", tmpdir_fresh + "/table", tmpdir_fresh + "/ck"
    _write(f"{root}/amazon_de/laptops/2026/04/06/products.json", [_rec("a", "u1", 1), _rec("b", "", 2)])
    _write(f"{root}/ebay_de/laptops/2026/04/06/products.json", [_rec("c", "u3", 3)])
    _write(f"{root}/ebay_de/laptops/2026/02/31/products.json", [_rec("bad", "u9", 9)])
    q = ingest.start_ingest(spark, root, table, ck)
    q.awaitTermination(120)
    t = spark.read.parquet(table)
    assert sorted(r["product_name"] for r in t.collect()) == ["a", "b", "c"]
    # second run: a new file for another day, plus nothing re-read from the first run
    _write(f"{root}/amazon_de/laptops/2026/04/07/products.json", [_rec("a2", "u1", 5), _rec("a3", "u1", 6)])
    q = ingest.start_ingest(spark, root, table, ck)
    q.awaitTermination(120)
    rows = sorted((str(r["run_date"]), r["product_name"]) for r in spark.read.parquet(table).collect())
    assert rows == [("2026-04-06", "a"), ("2026-04-06", "b"), ("2026-04-06", "c"), ("2026-04-07", "a3")]


def _files(spark, rows):
    return spark.createDataFrame([(f"file:/r/amazon_de/laptops/2026/04/0{d}/products.json", json.dumps(r)) for d, r in rows],
                                 "path string, value string")


def test_replayed_batch_changes_nothing(spark, tmpdir_fresh):
    table = tmpdir_fresh + "/t"
    ingest.merge_batch(spark, _files(spark, [(6, [_rec("a", "u1", 1), _rec("blank", "", 2)])]), table, 0)
    second = _files(spark, [(6, [_rec("b", "u1", 3), _rec("blank2", "", 4)])])
    for _ in range(2):
        ingest.merge_batch(spark, second, table, 1)
        rows = spark.read.parquet(table).orderBy("_pos").collect()
        assert [r["product_name"] for r in rows] == ["b", "blank", "blank2"]


def test_unreadable_table_fails_the_batch(spark, tmpdir_fresh):
    table = tmpdir_fresh + "/t"
    os.makedirs(table)
    with open(table + "/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        ingest.merge_batch(spark, _files(spark, [(6, [_rec("a", "u1", 1)])]), table, 0)
    assert os.listdir(table) == ["part-0.parquet"]


def test_batch_save_merges_and_keeps_null_keys(spark, tmpdir_fresh):
    table = tmpdir_fresh + "/t"
    schema = "product_name string, url string, source_key string, category_key string, run_date date, _file string, _i int"
    raw.save(spark, spark.createDataFrame([("a", "u1", None, "laptops", None, "f", 0), ("x", "u1", "s", "laptops", None, "f", 1)], schema), table)
    raw.save(spark, spark.createDataFrame([("b", "u1", None, "laptops", None, "g", 0), ("c", "u2", None, "laptops", None, "g", 1)], schema), table)
    rows = spark.read.parquet(table).collect()
    assert sorted((r["source_key"] or "", r["product_name"]) for r in rows) == [("", "b"), ("", "c"), ("s", "x")]
