import numpy as np
from pyspark.sql import functions as F

from brute import table
from pricefold.llm import ann

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, queries, k=ann.K):
    out = []
    for i, q in rows:
        if i in queries:
            best = sorted(((-float((np.float64(q) * np.float64(x)).sum()), j) for j, x in rows if j != i))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


def test_query_recall(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], dtype=np.float32)) for r in table(SF, "embeddings")]
    got = [tuple(r) for r in ann.op2_query(spark, SF).collect()]
    want = exact(rows, {i for i, _ in rows if i % 20 == 0})
    assert len(got) == len(want) and {(q, n) for q, n, _, _ in got} == {(q, n) for q, n, _, _ in want}
    assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) >= 0.93 * len(want)
    at = dict(rows)
    assert all(s == (np.float64(at[q]) * np.float64(at[v])).sum() for q, _, v, s in got)
    for q in {g[0] for g in got}:
        mine = sorted(g for g in got if g[0] == q)
        assert [(-g[3], g[2]) for g in mine] == sorted((-g[3], g[2]) for g in mine)


def test_more_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATES", 64)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 40)).astype(np.float32) * rng.uniform(0.5, 3, size=(1200, 1)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], SCHEMA)
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(df, F.col("vec_id") % 40 == 0).collect()}
    want = {(q, v) for q, _, v, _ in exact(rows, {i for i, _ in rows if i % 40 == 0})}
    assert len(got & want) >= 0.93 * len(want) and len(got) == len(want)


def test_scan_without_test_is_exact(monkeypatch):
    monkeypatch.setattr(ann, "EPSILON", 1e9)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 21))
    index = ann.Index(x, float(np.sqrt((x ** 2).sum(axis=1).max())), len(x))
    q, v, s = ann.scan(index, np.arange(300), x, np.arange(0, 300, 30), x[::30], np.full(10, np.inf))
    want = exact([(i, r) for i, r in enumerate(x)], set(range(0, 300, 30)))
    assert sorted(zip(q, v)) == sorted((a, c) for a, _, c, _ in want)


def test_a_large_group_of_equal_vectors_and_ties(spark):
    rows = [(i, np.array([1, 0, 0, 0], np.float32)) for i in range(400)] + [(400 + i, np.array([0, 1, 0, i], np.float32)) for i in range(30)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in ann.search(df, F.col("vec_id").isin(0, 100, 399, 420)).collect())
    assert got == sorted(exact(rows, {0, 100, 399, 420}))


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [3.0, 1.0]), (40, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("vector", F.lit("clash")).withColumn("list", F.lit(1))
    got = sorted(tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 5.0), (0, 2, 40, -3.0), (20, 1, 0, 5.0), (20, 2, 40, -4.0), (40, 1, 0, -3.0), (40, 2, 20, -4.0)]
    assert ann.search(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert ann.search(spark.createDataFrame([(1, [1.0])], SCHEMA), F.lit(True)).collect() == []
