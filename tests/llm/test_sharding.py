import itertools
import os
import zlib

import pytest
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import sharding

SF = "/root/testdata/sf0.001"


def test_flow_is_cheapest():
    supply, cap = [4, 1, 3], [3, 3, 2]
    cost = [[0, 2, 5], [4, 0, 1], [1, 3, 0]]
    flow = sharding.min_cost_flow(supply, cap, cost)
    assert [sum(f) for f in flow] == supply
    assert all(sum(f[j] for f in flow) <= cap[j] for j in range(3))
    got = sum(flow[i][j] * cost[i][j] for i in range(3) for j in range(3))
    best = min(
        sum(a[i][j] * cost[i][j] for i in range(3) for j in range(3))
        for a in itertools.product(*[[r for r in itertools.product(range(s + 1), repeat=3) if sum(r) == s] for s in supply])
        if all(sum(x[j] for x in a) <= cap[j] for j in range(3)))
    assert got == best


def test_too_small_capacities_raise():
    with pytest.raises(ValueError):
        sharding.min_cost_flow([3], [1, 1], [[0, 1]])


def test_query_on_whole_table(spark):
    rows = [r.asDict() for r in sharding.op3_query(spark, SF).collect()]
    want = {d["doc_id"]: d["text"] for d in table(SF, "documents")}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        k: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in want.items()}
    load = {}
    for shard in range(8):
        mine = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        load[shard] = sum(r["size"] for r in mine)
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8


def test_moves_little_more_than_it_must(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.reshard(d).select("old_shard", "shard", "size").collect()
    old = [sum(r["size"] for r in rows if r["old_shard"] == k) for k in range(8)]
    least = sum(max(0, x - sum(old) / 8) for x in old)
    moved = sum(r["size"] for r in rows if r["old_shard"] != r["shard"])
    assert least * 0.99 - 8 <= moved <= least * 1.1


def test_nulls_repeats_empty_and_clashes(spark):
    d = docs(spark, [(1, None), (None, "a"), (None, "a"), (2, ""), (2, ""), (3, "é" * 9, None, None)])
    d = d.withColumn("shard", F.lit("old")).withColumn("slot", F.lit(9)).withColumn("size", F.lit("x"))
    rows = sharding.reshard(d, 2).collect()
    assert sorted(r["size"] for r in rows) == [1, 1, 1, 2, 2, 19]
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.reshard(docs(spark, []), 3).collect() == []


def balanced(rows, n, tolerance=0.05):
    load = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(n)]
    assert max(load) - min(load) <= tolerance * sum(load) / n
    for k in range(n):
        mine = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert mine == list(range(len(mine)))


@pytest.mark.parametrize("ids,texts", [([None], 20_000), ([7], 20_000), ([None], 1), ([7, None], 2), (range(300), 3)])
def test_null_and_repeated_ids_are_spread(spark, ids, texts):
    # 20,000 rows: one id for all of them, or even one row 20,000 times
    d = docs(spark, [(list(ids)[k % len(ids)], f"text {k % texts}", "en", "s") for k in range(20_000)])
    rows = sharding.reshard(d).select("size", "shard", "slot").collect()
    assert len(rows) == 20_000
    balanced(rows, 8)


def test_old_shards_that_are_none_of_the_new_are_one_for_the_flow(spark):
    d = docs(spark, [(k, "x" * (k % 50), "en", "s") for k in range(9000)]).withColumn("at", F.col("doc_id").cast("int") - 3000)
    rows = sharding.reshard(d, 4, F.col("at")).collect()  # 9,000 old shards
    assert sorted(r["doc_id"] for r in rows) == list(range(9000)) and all(r["old_shard"] == r["doc_id"] - 3000 for r in rows)
    balanced(rows, 4)


def test_only_affected_files_are_rewritten(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/layout"
    d = docs(spark, [(k, "x" * 20, "en", "s") for k in range(4000)]).repartition(8)
    # shards 0 and 1 are as large as they shall be; 2 gives half of its rows to 3
    at = F.when(F.col("doc_id") < 1000, 0).when(F.col("doc_id") < 2000, 1).when(F.col("doc_id") < 3500, 2).otherwise(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # several files to a shard
    sharding.lay_out(d, path, 4, at)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = lambda: {f"{s}/{f}" for s in os.listdir(path) if "=" in s for f in os.listdir(f"{path}/{s}") if f.endswith(".parquet")}
    before = names()
    moves, went = sharding.rewrite(spark, path, 4)
    gone = {"/".join(w.split("/")[-2:]) for w in went}
    assert gone < before and not any(f.startswith(("shard=0/", "shard=1/", "shard=3/")) for f in gone)
    assert before - names() == gone and len([f for f in before if f.startswith("shard=2/")]) > len(gone) > 0
    rows = [r.asDict() | {"size": 21} for r in sharding.read_layout(spark, path, moves).collect()]
    assert sorted(r["doc_id"] for r in rows) == list(range(4000))
    balanced(rows, 4, 0.1)
    assert all(r["shard"] == r["doc_id"] // 1000 for r in rows if r["doc_id"] < 2000) and {r["shard"] for r in rows if r["doc_id"] >= 3500} == {3}
    # a second time nothing moves, and stale rows of another writing are no part of the layout
    again, went = sharding.rewrite(spark, path, 4, [21_000 + 2000] * 4)
    assert went == [] and sharding.read_layout(spark, path, again).count() == 4000
    spark.read.parquet(path).limit(50).withColumn("written", F.lit(9)).write.partitionBy("shard").mode("append").parquet(path)
    assert sharding.read_layout(spark, path, again).count() == 4000


def test_layouts_of_nothing(spark, tmpdir_fresh):
    sharding.lay_out(docs(spark, []), f"{tmpdir_fresh}/e")
    moves, went = sharding.rewrite(spark, f"{tmpdir_fresh}/e")
    assert went == [] and sharding.read_layout(spark, f"{tmpdir_fresh}/e", moves).collect() == []


def test_only_affected_shards_are_rewritten(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "shards")
    rows = [(i, "x" * 10, "en", "s") for i in range(90)]
    old = docs(spark, rows).withColumn("at", (F.col("doc_id") % 3).cast("int"))
    # shard 0 keeps its 30 rows; 1 gives all it holds beyond 20 to 2
    first = sharding.reshard(old, 3, F.col("at"), [330, 330, 330])
    sharding.write_shards(first, path)
    before = {f: sorted(os.listdir(f"{path}/shard={f}")) for f in (0, 1, 2)}
    again = sharding.reshard(spark.read.parquet(path).drop("slot"), 3, F.col("shard"), [330, 220, 440])
    sharding.write_shards(again, path, only_affected=True)
    after = {f: sorted(os.listdir(f"{path}/shard={f}")) for f in (0, 1, 2)}
    assert before[0] == after[0] and before[1] != after[1] and before[2] != after[2]
    got = spark.read.parquet(path).groupBy("shard").count().orderBy("shard").collect()
    assert [tuple(r) for r in got] == [(0, 30), (1, 20), (2, 40)]
    assert spark.read.parquet(path).select("doc_id").distinct().count() == 90
