"""Stored medians: equal to those over all rows after each day, from a few folders only."""

import os
import random

from pyspark.sql import functions as F

from pricefold.operators import cleaning, median_store


def day_rows(rng, n):
    return [(rng.choice(["a", "b", "c", None]), rng.choice([None, 0.0, -5.0, 9.99, round(rng.lognormvariate(5, 1.5), 2), float(rng.randrange(1, 900))])) for _ in range(n)]


def medians(df):
    return {r["category"]: r["category_median"] for r in df.collect()}


def test_days_added_one_by_one(spark, tmpdir_fresh):
    rng, rows = random.Random(3), []
    for k, n in enumerate([1, 2, 150, 40, 0, 301]):
        today = day_rows(rng, n)
        rows += today
        df = spark.createDataFrame(today, "category string, price_clean double")
        median_store.add_day(df, tmpdir_fresh, f"2026-04-0{k + 1}")
        everything = spark.createDataFrame(rows, "category string, price_clean double")
        want = medians(cleaning.category_medians(everything))
        got = medians(median_store.stored_medians(spark, tmpdir_fresh))
        assert got == want
        flags = lambda m: sorted(map(str, cleaning.flag_anomalies(everything, medians=m).collect()))
        assert flags(median_store.stored_medians(spark, tmpdir_fresh)) == flags(None)
    median_store.add_day(df, tmpdir_fresh, "2026-04-06")       # the same day again changes nothing
    assert medians(median_store.stored_medians(spark, tmpdir_fresh)) == want
    # what is read again: the folders of the middle cells
    folders = {f for d in os.listdir(f"{tmpdir_fresh}/values") if "=" in d for f in os.listdir(f"{tmpdir_fresh}/values/{d}") if "=" in f}
    middle = {f"folder={r['folder']}" for r in median_store.middle_cells(spark, tmpdir_fresh).collect()}
    assert middle <= folders and len(middle) <= 8 < len(folders) / 3


def test_cells_are_monotone(spark):
    prices = sorted([-3.0, 0.0, 1e-9, 1e-7, 0.01, 0.5, 1.0, 1.02, 9.99, 10.0, 1e4, 1e12])
    got = [r[0] for r in spark.createDataFrame([(p,) for p in prices], "p double").select(median_store.cell(F.col("p"))).collect()]
    assert got == sorted(got)
