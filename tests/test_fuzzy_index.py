"""Fuzzy candidates with a proven bound: equal to a scan of every choice, and the bounds themselves."""

import random

import pytest
from pyspark.sql import functions as F

from pricefold.operators import fuzzy, fuzzy_index

WORDS = [f"{a}{b}" for a in ("gal", "pix", "think", "mac", "sure", "note", "idea", "air", "pro", "max") for b in ("axy", "el", "pad", "book", "pods", "line", "tab")]
BRANDS = ["samsung", "apple", "lenovo"]


def catalog_names(rng, n):
    return sorted({" ".join([rng.choice(BRANDS), *rng.sample(WORDS, rng.randint(1, 4)), str(rng.randrange(60))]) for _ in range(n)})


def garbled(rng, name):
    kind = rng.randrange(6)
    words = name.split()
    if kind == 0:
        return name + rng.choice([" neu", " kaufen 128 gb", " schwarz online shop"])
    if kind == 1:
        rng.shuffle(words)
        return " ".join(words)
    if kind == 2:
        at = rng.randrange(len(name))
        return " ".join((name[:at] + rng.choice("xyz") + name[at + 1:]).split())
    if kind == 3:
        return " ".join(w[:-1] if len(w) > 3 and rng.random() < 0.3 else w for w in words)
    if kind == 4:
        return " ".join(rng.sample(WORDS, 2))
    return words[0]


def frames(spark, n, q, seed):
    rng = random.Random(seed)
    names = catalog_names(rng, n)
    rows = [(k, name, "phones" if k % 3 else "laptops", k) for k, name in enumerate(names)]
    cat = spark.createDataFrame(rows, "product_id long, canonical_name string, category string, ord long")
    asked = {(garbled(rng, rng.choice(names)), rng.choice(["phones", "laptops", "", "toys"])) for _ in range(q)} | {("", "phones"), ("zzz", "phones")}
    lst = spark.createDataFrame(sorted(asked), "product_name_clean string, category string")
    return lst, cat


def rows(df):
    return {(r["qproc"], r["qcat"]): (r["product_id"], r["raw_score"], r["match_method"]) for r in df.collect()}


@pytest.mark.parametrize("hot", [500, 25, 3])
def test_index_plan_equals_a_scan(spark, monkeypatch, hot):
    monkeypatch.setattr(fuzzy_index, "HOT", hot)
    monkeypatch.setattr(fuzzy, "best_indexed", lambda q, ch, kind: fuzzy_index.best_indexed(q, ch, kind, hot))
    lst, cat = frames(spark, 260, 220, seed=hot)
    assert rows(fuzzy.match_queries(lst, cat, plan="index")) == rows(fuzzy.match_queries(lst, cat, plan="broadcast"))


def test_most_queries_are_settled_and_settled_ones_are_best(spark):
    lst, cat = frames(spark, 300, 300, seed=1)
    q = lst.select(F.col("product_name_clean").alias("qproc"), F.col("category").alias("qcat")).where("qcat <> 'toys' and qproc <> ''")
    found = fuzzy_index.best_indexed(q, fuzzy.choices(cat), "bigint").collect()
    pools = fuzzy._prepare_pool([r.asDict() for r in fuzzy.choices(cat).collect()])
    settled = [r for r in found if r["settled"]]
    for r in settled:
        score, at = fuzzy.best_in_pool(r["qproc"], pools[r["qcat"]])
        assert (r["raw_score"], r["best_product_id"]) == (score, pools[r["qcat"]]["rows"][at][0])
    assert len(settled) > 0.6 * q.count()


def test_index_plan_reads_no_whole_category(spark):
    lst, cat = frames(spark, 60, 40, seed=2)
    q = lst.select(F.col("product_name_clean").alias("qproc"), F.col("category").alias("qcat"))
    plan = fuzzy_index.best_indexed(q, fuzzy.choices(cat), "bigint")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "CoGroup" not in plan


def grams(name):
    return {f"  {t}"[i:i + 3] for t in set(name.split()) for i in range(len(t))}


def test_bounds_hold_on_random_names():
    rng = random.Random(5)
    names = ["".join(rng.choice("ab ") for _ in range(rng.randint(3, 18))) for _ in range(120)] + catalog_names(rng, 40)
    names = [" ".join(dict.fromkeys(n.split())) for n in names if n.split()]
    for x in names:
        tokens = sorted(set(x.split()), key=lambda t: (len(t), t))
        length, mine = fuzzy_index._joined(tokens), grams(x)
        for y in names:
            a, b = " ".join(sorted(set(x.split()))), " ".join(sorted(set(y.split())))
            # r1 alone: the normalised insertions and deletions of the sorted names with their shared tokens first
            shared = sorted(set(x.split()) & set(y.split()))
            first = [" ".join(shared + sorted(set(n.split()) - set(shared))) for n in (x, y)]
            d = len(first[0]) + len(first[1]) - 2 * fuzzy.lcs_length(*first)
            r1 = 100 * (1 - d / (len(a) + len(b)))
            absent = len(mine - grams(y))
            for s in (70, 85, 90, 97, 100):
                if absent >= fuzzy_index.grams_needed(length, s):
                    assert r1 < s
                lead = tokens[:fuzzy_index.rarest_needed(tokens, s)]
                if not set(lead) & set(y.split()) and shared:
                    own = " ".join(shared)
                    rest = length - len(own) - 1
                    assert 100 - 100 * (1 + rest) / (2 * len(own) + 1 + rest) < s
