"""Positions within keys: equal to a sort, also where one (key, part) is cut into stretches."""

import random

import pytest
from pyspark.sql import functions as F

from pricefold.operators import ranking


def expected(rows):
    """(row, position) by key: part descending (None last), then order (None last)."""
    out, by = {}, {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for group in by.values():
        group.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[3] is None, r[3] or ""))
        out |= {r[0]: k + 1 for k, r in enumerate(group)}
    return out


@pytest.mark.parametrize("most", [1_000_000, 30, 1])
def test_positions_equal_a_sort(spark, monkeypatch, most):
    monkeypatch.setattr(ranking, "STRETCH", 40)
    rng = random.Random(most)
    rows = [(k, rng.choice(["hot", "hot", "hot", "cold", None, f"k{k % 20}"]), rng.choice([None, 5, 5, 5, rng.randrange(9)]), f"o{k * 7919 % 10_007}") for k in range(900)]
    df = spark.createDataFrame(rows, "row long, key string, part int, ord string")
    got = ranking.with_position(df, "key", F.col("part"), [F.col("ord").asc_nulls_last()], most)
    assert got.columns == ["row", "key", "part", "ord", "position"]
    assert {r["row"]: r["position"] for r in got.collect()} == expected(rows)


def test_equal_rows_and_no_rows(spark):
    df = spark.createDataFrame([("k", 1, "same")] * 500, "key string, part int, ord string")
    got = ranking.with_position(df, "key", F.col("part"), [F.col("ord")], 10)
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 501))
    assert ranking.with_position(df.limit(0), "key", F.col("part"), [F.col("ord")]).collect() == []


def test_one_hot_key_and_day_is_spread(spark, monkeypatch):
    monkeypatch.setattr(ranking, "STRETCH", 2_500)
    df = spark.range(20_000).select(F.lit("product").alias("key"), F.lit(1).alias("_part"), F.md5(F.col("id").cast("string")).alias("ord"),
                                    F.lit(0.0).alias("_salt"))
    rows = ranking._in_stretches(df, "key", [F.col("ord")], 20_000)
    # stretches are the partitions that are ordered: none is beyond twice the median
    sizes = sorted(r["count"] for r in df.repartitionByRange(8, "key", "_part", "ord").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) >= 7 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    got = rows.select("ord", "_i").orderBy("_i").collect()
    assert [r["_i"] for r in got] == list(range(1, 20_001)) and [r["ord"] for r in got] == sorted(r["ord"] for r in got)
