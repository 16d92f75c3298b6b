import hashlib
import math
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from brute import docs
from pricefold.llm import mixing

SF = "/root/testdata/sf0.001"


def copies(rate, doc_id, seed=mixing.SEED):
    u = int(hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 16 ** 13
    n, total = 0, 0.0
    for k in range(1000):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate else 1.0
        if total > u:
            return n
        n += 1


def test_counts_equal_inverse_poisson(spark):
    d = docs(spark, [(i, "x" * (9 + i % 3), "en", f"s{i % 3 if i % 2 else 0}") for i in range(400)])
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(d).collect()}
    got = Counter(r["doc_id"] for r in mixing.mix(d).collect())
    assert got == Counter({r["doc_id"]: n for r in d.collect() if (n := copies(rates[r["source"]], r["doc_id"]))})


def test_weights_are_met_and_order_is_mixed(spark):
    d = docs(spark, [(i, "x" * 99, "en", "big" if i % 4 else "small") for i in range(8000)])
    rows = mixing.mix(d, {"big": 1, "small": 1}).collect()
    share = sum(r["source"] == "small" for r in rows) / len(rows)
    assert abs(share - 0.5) < 0.02 and abs(len(rows) - 8000) < 400
    assert Counter(r["source"] for r in mixing.mix(d, {"small": 2}).collect()).keys() == {"small"}
    first = [r["source"] for r in rows[:200]]
    assert 60 < first.count("small") < 140


def test_large_rates_do_not_underflow(spark):
    cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(2000.0)).alias("c")).first()["c"]
    assert abs(cdf[-1] - 1) < 1e-9 and abs(next(k for k, c in enumerate(cdf) if c > 0.5) - 2000) <= 1


def test_a_rate_beyond_one_draw_is_met(spark):
    d = docs(spark, [(i, "x" * 99, "en", "small" if i < 20 else "big") for i in range(4000)])
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(d, {"big": 1, "small": 1}).collect()}
    assert abs(rates["small"] - 100) < 1e-9
    rows = mixing.mix(d, {"big": 1, "small": 1}).select("doc_id", "source", "n_copies", "copy").collect()
    assert abs(sum(r["source"] == "small" for r in rows) / len(rows) - 0.5) < 0.03 and abs(len(rows) - 4000) < 200
    numbers = {}
    for r in rows:
        numbers.setdefault((r["doc_id"], r["n_copies"]), []).append(r["copy"])
    assert all(sorted(c) == list(range(1, n + 1)) for (_, n), c in numbers.items())
    alone = docs(spark, [(1, "x", "en", "tiny")] + [(i, "x" * 9999, "en", "big") for i in range(2, 4)])
    n = mixing.mix(alone, {"big": 1, "tiny": 1}).where("doc_id = 1").count()
    assert abs(n - 5000) < 5 * 5000 ** 0.5


def test_sql_meets_rates_beyond_one_draw(spark, tmpdir_fresh):
    # 20 MB in one source, 2 to 40 bytes in the others: rates from 1 to some 3,000
    rows = [(i, "x" * 1_000_000, "en", "big") for i in range(20)] + [(100, "a", "de", "tiny"), (101, "b" * 9, None, None), (102, None, "en", "none"),
                                                                    (103, "c" * 40, "fr", "small"), (None, "d", "fr", "small")]
    d = docs(spark, rows)
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(d).collect()}
    assert rates["big"] < 1 and rates["tiny"] > 10 * mixing.MAX_RATE
    d.write.parquet(f"{tmpdir_fresh}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmpdir_fresh}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT doc_id, source, n_copies, copy, shuffle_key FROM ({mixing.OP9_SQL}) WHERE source IS DISTINCT FROM 'big'").fetchall()
    got = mixing.op9_query(spark, tmpdir_fresh).where("source is null or source <> 'big'")
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select("doc_id", "source", "n_copies", "copy", "shuffle_key").collect())


def test_nulls_repeats_empty_and_clashes(spark):
    d = docs(spark, [(None, None, None, None), (1, "", None, None), (1, "", None, None), (2, "b", "en", "s")])
    d = d.withColumn("rate", F.lit("x")).withColumn("copy", F.lit("y")).withColumn("size", F.lit("z"))
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(d).collect()}
    got = Counter(r["doc_id"] for r in mixing.mix(d).collect())
    want = Counter()
    for r in d.collect():
        want[r["doc_id"]] += copies(rates[r["source"]], r["doc_id"])
    assert got == +want
    assert mixing.mix(docs(spark, [])).collect() == []


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    d = docs(spark, [(i, "x" * 20, "en", f"s{i % 5}") for i in range(100)])
    want = Counter(r["doc_id"] for r in mixing.mix(d).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 2)
    assert Counter(r["doc_id"] for r in mixing.mix(d).collect()) == want
