"""What steps leave on disk: shuffle files go with their step, rows are shuffled once, large text files are packed."""

import contextlib
import glob
import time

import pytest
from pyspark.sql import functions as F

from pricefold.llm import common
from pricefold.operators import cleaning, joins, merging, ranking
from pricefold.session import FREE_SHUFFLES, cut_lineage, written
from pricefold.sources import raw, sinks


@contextlib.contextmanager
def conf(spark, key, value):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffle_files(spark):
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in top for f in glob.glob(f"{d}/*/shuffle_*.data")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", [cut_lineage, lambda df: written(df, "x"), lambda df: common.written(df, "x")])
def test_steps_leave_no_shuffle_files(spark, step):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    got = step(spark.range(10_000).withColumn("k", F.col("id") % 1000).groupBy("k").agg(F.count("id").alias("n")))
    assert got.count() == 1000 and got.agg(F.sum("n")).first()[0] == 10_000
    # what counting made is not the step's: at most its own few rows' files, one a map task
    end = time.time() + 20
    while (left := {f for f in shuffle_files(spark) - before if len(open(f, "rb").read()) > 2000}) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES, None) == setting


def test_few_rows_of_a_key_are_shuffled_once(spark):
    df = spark.createDataFrame([(k % 7, k % 3, k) for k in range(100)], "key int, part int, ord int")
    got = ranking.with_position(df, "key", F.col("part"), [F.col("ord")])
    assert plan(got).count("Exchange") == 1 and "Join" not in plan(got)
    assert got.agg(F.sum("position")).first()[0] == sum(n * (n + 1) // 2 for n in [15, 15, 14, 14, 14, 14, 14])


def test_shared_is_measured(spark):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("name"))
    with conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), conf(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"):
        rows = spark.range(1000)
        assert "BroadcastHashJoin" in plan(rows.join(joins.shared(df), "id"))
        assert "BroadcastHashJoin" not in plan(rows.join(joins.shared(df, 5_000), "id"))
        assert rows.join(joins.shared(df), "id").count() == rows.join(joins.shared(df, 5_000), "id").count() == 100


def test_cleaned_rows_are_not_shuffled_to_meet_the_medians(spark):
    rows = [(f"Name {k % 40}", float(k % 9 + 1) if k % 8 else None, "EUR", "In Stock", "s", f"src{k % 3}", f"u{k}", f"2026-01-0{k % 9 + 1}", ["a", "b", None][k % 3])
            for k in range(300)]
    df = spark.createDataFrame(rows, "product_name string, price double, currency string, availability string, seller string, source string, "
                               "url string, scrape_timestamp string, category string")
    with conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), conf(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"):
        got = cleaning.clean(df)
        assert "SortMergeJoin" not in plan(got) and plan(got).count("Exchange hashpartitioning") == 1
    medians = {r["category"]: r["category_median"] for r in cleaning.category_medians(cleaning.normalize_keys(df)).collect()}
    prices = {}
    for r in rows:
        prices.setdefault(r[8] or "", []).append(r[1])
    for category, found in prices.items():
        found = sorted(p for p in found if p is not None)
        assert medians[category] == (found[(len(found) - 1) // 2] + found[len(found) // 2]) / 2


def test_packed_files_hold_the_same_rows(spark, tmpdir_fresh):
    rows = [(f"n{k}", float(k), "EUR", f"u{k}", f"s{k % 2}", "c", "2026-04-07", "f") for k in range(50)]
    df = spark.createDataFrame(rows, "product_name string, price double, currency string, url string, _source string, _category string, _run_date string, _file string")
    for to, codec in (("plain", None), ("packed", "gzip")):
        raw.publish(df, f"{tmpdir_fresh}/{to}", compression=codec)
        sinks.write_flat(df, f"{tmpdir_fresh}/{to}-flat", "x", compression=codec)
    plain, packed = (sorted(map(str, spark.read.json(f"{tmpdir_fresh}/{to}").collect())) for to in ("plain", "packed"))
    assert plain == packed and len(plain) == 50
    assert spark.read.json(f"{tmpdir_fresh}/packed-flat/processed/x").count() == 50
    files = {to: glob.glob(f"{tmpdir_fresh}/{to}*/**/part-*", recursive=True) for to in ("plain", "packed")}
    assert all(f.endswith(".json") for f in files["plain"]) and all(f.endswith(".json.gz") for f in files["packed"])


def test_packed_unified_records(spark, tmpdir_fresh):
    rows = [(p, f"p{p}", "c", "src", float(k), "EUR", "in_stock", "s", f"u{k}", f"2026-01-0{k % 9 + 1}", False) for p in range(5) for k in range(20)]
    m = spark.createDataFrame(rows, "product_id long, canonical_name string, product_category string, source string, price_clean double, "
                              "currency string, availability_clean string, seller string, url string, scrape_timestamp string, is_anomaly boolean")
    assert m.columns == merging.TAKEN
    sinks.write_unified(merging.unified_records(m), tmpdir_fresh, compression="gzip")
    back = spark.read.json(f"{tmpdir_fresh}/unified")
    assert {(r["product_id"], len(r["prices"]), r["offer_count"]) for r in back.collect()} == {(p, 20, 20) for p in range(5)}
    assert glob.glob(f"{tmpdir_fresh}/unified/**/*.json.gz", recursive=True)
