"""File sources and sinks in fresh temp folders: raw tree scan, latest
partition, URL upsert, publish, unified sink, search results, model output."""

import json
import os

from pyspark.sql import functions as F

from pricefold.sources import model, raw, search, sinks


def _write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False))


def _rec(name, url="", price=1.0, **kw):
    d = {"product_name": name, "price": price, "currency": "EUR", "availability": "in_stock",
         "seller": "s", "source": "amazon_de", "url": url, "scrape_timestamp": "2026-04-07T10:00:00+00:00",
         "category": "laptops"}
    d.update(kw)
    return d


def _tree(root):
    _write(f"{root}/amazon_de/laptops/2026/04/06/products.json", [_rec("a1", "u1")])
    _write(f"{root}/amazon_de/laptops/2026/04/07/products.json",
           [_rec("a2", "u2", price="1.299,99 €"), _rec("a3", "", _source="explicit")])
    _write(f"{root}/amazon_de/gpus/2026/04/07/products.json", "{not json")           # undecodable
    _write(f"{root}/ebay_de/laptops/2026/04/07/products.json", {"product_name": "obj"})  # not a list
    _write(f"{root}/ebay_de/laptops/2026/02/31/products.json", [_rec("bad-date")])     # impossible date
    _write(f"{root}/ebay_de/phones/2026/04/05/products.json", [_rec("e1", "u9")])
    _write(f"{root}/idealo_de/phones/2026/04/05/products.json", [_rec("i1")])          # not a default source


def test_iter_records(spark, tmpdir_fresh):
    root = tmpdir_fresh + "/raw"
    _tree(root)
    df = raw.iter_records(spark, root)
    got = sorted((r["product_name"], r["_source"], r["_category"], r["_run_date"]) for r in df.collect())
    assert got == [("a1", "amazon_de", "laptops", "2026-04-06"), ("a2", "amazon_de", "laptops", "2026-04-07"),
                   ("a3", "explicit", "laptops", "2026-04-07"), ("e1", "ebay_de", "phones", "2026-04-05")]
    d = raw.iter_records(spark, root, source="amazon_de", start_date=__import__("datetime").date(2026, 4, 7),
                         end_date=__import__("datetime").date(2026, 4, 7))
    assert sorted(r["product_name"] for r in d.collect()) == ["a2", "a3"]
    assert [r["price"] for r in d.where(F.col("product_name") == "a2").collect()] == ["1.299,99 €"]
    assert raw.iter_records(spark, root, source="idealo_de").count() == 1


def test_load_latest_no_fallback(spark, tmpdir_fresh):
    root = tmpdir_fresh + "/raw"
    _tree(root)
    got = sorted((r["_source"], r["_category"], r["product_name"]) for r in raw.load_latest(spark, root).collect())
    # amazon gpus latest file is undecodable and ebay laptops latest is an object: nothing, no fallback
    assert got == sorted([("amazon_de", "laptops", "a2"), ("explicit", "laptops", "a3"),
                          ("ebay_de", "phones", "e1"), ("idealo_de", "phones", "i1")])


def test_upsert(spark):
    cols = "url string, price double, _pos long"
    existing = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1), ("a", 3.0, 2), ("", 4.0, 3)], cols)
    incoming = spark.createDataFrame([("a ", 10.0, 0), ("c", 11.0, 1), ("c", 12.0, 2), (None, 13.0, 3)], cols)
    got = sorted((r["_seq"], r["_pos"], r["url"], r["price"]) for r in raw.upsert(existing, incoming).collect())
    assert got == [(0, 0, "a", 1.0),      # earlier duplicate stays
                   (0, 1, "b", 2.0),
                   (0, 2, "a ", 10.0),    # last existing occurrence replaced by incoming
                   (0, 3, "", 4.0),       # blank url kept
                   (1, 1, "c", 12.0),     # new url: first incoming slot, last incoming wins
                   (1, 3, None, 13.0)]    # missing url appended


def test_publish_and_unified_sink(spark, tmpdir_fresh):
    root = tmpdir_fresh + "/raw"
    _tree(root)
    recs = raw.iter_records(spark, root)
    targets = sorted(r["target"] for r in raw.publish(recs, tmpdir_fresh + "/pub", dry_run=True).collect())
    assert any(t.endswith("source_key=amazon_de/category_key=laptops/year=2026/month=04/day=07") for t in targets)
    raw.publish(recs, tmpdir_fresh + "/pub")
    back = spark.read.json(tmpdir_fresh + "/pub")
    assert back.count() == recs.count()
    uni = spark.createDataFrame([("1", "x", "laptop", [(float("nan"), "s")], 1.0)],
                                "product_id string, canonical_name string, category string, "
                                "prices array<struct<price:double, source:string>>, price_min double")
    import datetime as dt
    sinks.write_unified(uni, tmpdir_fresh + "/out", run_date=dt.date(2026, 4, 7))
    u = spark.read.json(tmpdir_fresh + "/out/unified")
    r = u.collect()[0]
    assert r["category_key"] == "laptop" and r["prices"][0]["price"] is None
    assert os.path.isdir(tmpdir_fresh + "/out/unified/category_key=laptop/year=2026/month=04/day=07")
    sinks.write_flat(uni.select("product_id", "price_min"), tmpdir_fresh + "/out", "prices", fmt="csv",
                     run_date=dt.date(2026, 4, 7))
    assert os.path.isdir(tmpdir_fresh + "/out/processed/prices/run_date=2026-04-07")


def test_search_results(spark, tmpdir_fresh):
    shop = {"search_metadata": {"status": "Success"}, "shopping_results": [
        {"position": 1, "title": " Laptop A ", "link": "https://x/a", "source": "Shop A",
         "price": "1.299,00 €", "extracted_price": 1299.0},
        {"position": 2, "title": "Laptop B", "link": "https://x/b", "source": "", "price": "ab 1.949,00 €"},
        {"position": 3, "title": "", "link": "https://x/c", "price": "1 €"},
        {"position": 4, "title": "Laptop D", "link": "https://x/d", "price": "", "in_stock": True}]}
    org = {"search_metadata": {"status": "Success"}, "organic_results": [
        {"position": 1, "title": "Dell XPS 15 | Preisvergleich bei idealo", "link": "https://www.idealo.de/p/1",
         "snippet": "Preise ab 1.899,00 € bei 12 Shops"},
        {"position": 2, "title": "Other", "link": "https://other.example/x", "snippet": "99 €"},
        {"position": 3, "title": "No price", "link": "https://www.idealo.de/p/3", "snippet": "nothing"}]}
    _write(tmpdir_fresh + "/s/shop.json", json.dumps(shop, indent=2))
    _write(tmpdir_fresh + "/s/org.json", json.dumps(org, indent=2))
    docs = search.read_search_docs(spark, tmpdir_fresh + "/s")
    ts = F.lit("2026-04-07 12:00:00").cast("timestamp_ntz")
    s = search.shopping_rows(search.explode_results(docs, "shopping_results"), F.lit("laptops"), ts).collect()
    assert sorted((r["product_name"], r["price"], r["seller"], r["availability"]) for r in s) == [
        ("Laptop A", 1299.0, "Shop A", "in_stock"), ("Laptop B", 1949.0, "Google Shopping", "in_stock"),
        ("Laptop D", 0.0, "Google Shopping", "unknown")]
    o = search.organic_rows(search.explode_results(docs, "organic_results"), F.lit("laptops"), ts).collect()
    assert sorted((r["product_name"], r["price"], r["availability"]) for r in o) == [
        ("Dell XPS 15", 1899.0, "in_stock"), ("No price", 0.0, "unknown")]


def test_model_rows(spark):
    df = spark.createDataFrame([
        ("amazon_de", '```json\n[{"product_name": "A", "price": "1.299,00 €", "availability": "IN_STOCK"}]\n```'),
        ("ebay_de", '[{"product_name": " ", "price": 1}, {"product_name": "B", "price": 5, "currency": "USD",'
                    ' "availability": "maybe", "url": " https://b "}]'),
        ("x", '{"product_name": "object, not a list"}'), ("y", "not json at all")],
        "source string, response string")
    got = sorted((r["product_name"], r["price"], r["currency"], r["availability"], r["seller"], r["url"])
                 for r in model.model_rows(df, F.lit("laptops")).collect())
    assert got == [("A", 1299.0, "EUR", "in_stock", "Amazon De", ""),
                   ("B", 5.0, "USD", "unknown", "Ebay De", "https://b")]


def test_trailing_text_skips_the_file(spark, tmpdir_fresh):
    root = tmpdir_fresh + "/raw"
    for day, text in enumerate(['[{"product_name": "ok", "price": 49.999}] trailing', '[{"product_name": "ok"}]}', '[{"product_name": "cut"',
                                '  [{"product_name": "good", "price": 49.999}, {"product_name": "text", "price": "-123"}]\n', '[]'], 1):
        _write(f"{root}/amazon_de/laptops/2026/04/0{day}/products.json", text)
    rows = {r["product_name"]: r for r in raw.iter_records(spark, root).collect()}
    assert set(rows) == {"good", "text"}
    assert (rows["good"]["price"], rows["good"]["_price_number"]) == ("49.999", 49.999)
    assert (rows["text"]["price"], rows["text"]["_price_number"]) == ("-123", None)
    from pricefold.operators import cleaning
    cleaned = {r["product_name"]: r["price_clean"] for r in cleaning.clean(raw.iter_records(spark, root)).collect()}
    assert cleaned == {"good": 49.999, "text": 123.0}


def test_dates_list_only_their_folders(spark, tmpdir_fresh):
    import datetime as dt

    from pricefold.sources.tree import Tree
    root = tmpdir_fresh + "/raw"
    for y in (2023, 2024):
        for m in (1, 2, 12):
            for d in (1, 15, 28):
                _write(f"{root}/amazon_de/laptops/{y}/{m:02}/{d:02}/products.json", [_rec(f"{y}-{m}-{d}")])
    _write(f"{root}/amazon_de/laptops/2024/02/xx/products.json", [_rec("no date")])
    _write(f"{root}/amazon_de/laptops/2024/02/30/products.json", [_rec("no such day")])
    _write(f"{root}/amazon_de/laptops/2024/02/15/deeper/products.json", [_rec("too deep")])
    os.makedirs(f"{root}/amazon_de/laptops/2024/12/31")      # the latest day has no file
    tree = Tree(spark, root)
    start, end = dt.date(2024, 2, 10), dt.date(2024, 2, 29)
    days = [str(d) for d, _ in tree.days("amazon_de", "laptops", start, end)]
    at = f"{root}/amazon_de/laptops"
    assert days == ["2024-02-28", "2024-02-15"] and tree.listed == [at, f"{at}/2024", f"{at}/2024/02"]
    names = lambda df: sorted(r["product_name"] for r in df.collect())
    assert names(raw.iter_records(spark, root, start_date=start, end_date=end)) == ["2024-2-15", "2024-2-28"]
    assert names(raw.iter_records(spark, root, end_date=dt.date(2023, 1, 20))) == ["2023-1-1", "2023-1-15"]
    assert len(names(raw.iter_records(spark, root))) == 18 and names(raw.iter_records(spark, root, start_date=dt.date(2030, 1, 1))) == []
    assert names(raw.load_latest(spark, root)) == ["2024-12-28"]
    again = Tree(spark, root)
    assert again.latest_file("amazon_de", "laptops") == f"{at}/2024/12/28/products.json"
    assert again.listed == [at, f"{at}/2024", f"{at}/2024/12"]
    assert raw.iter_records(spark, tmpdir_fresh + "/none").collect() == [] and raw.load_latest(spark, tmpdir_fresh + "/none").collect() == []


def test_positions_have_no_bounds(spark, tmpdir_fresh):
    table = f"{tmpdir_fresh}/table"
    big = 1 << 40                 # places, files and batches far beyond what one packed number would hold
    rows = [("a", None, 1 + big), ("b", None, 2 + big), ("c", None, 1)]
    cols = "product_name string, url string, _i long"
    part = [F.lit("s").alias("source_key"), F.lit("c").alias("category_key"), F.lit("2024-01-01").cast("date").alias("run_date")]
    first = spark.createDataFrame(rows, cols).select("*", *part, F.lit("f1").alias("_file"))
    raw.save(spark, first, table, batch=big)
    second = spark.createDataFrame([("d", None, 0), ("e", "u", 5), ("f", "u", 6)], cols).select("*", *part, F.lit("f0").alias("_file"))
    raw.save(spark, second, table, batch=big + 1)
    got = spark.read.parquet(table).orderBy("_pos").collect()
    assert [r["product_name"] for r in got] == ["c", "a", "b", "d", "f"]
    assert (got[1]["_pos"]["batch"], got[1]["_pos"]["place"]) == (big, 1 + big)
