"""Matchers: brute-force equivalence, tie rules, plan equivalence."""

import re

import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pricefold.operators import fuzzy, matching, vector
from pricefold.plans import pipeline, tables

TOKEN = re.compile(r"[a-z0-9]+")


def brute_rule(queries, catalog, threshold=0.65, accessory=lambda q: False):
    """Per-query loop over the catalog in order, strictly-greater argmax."""
    by_cat = {}
    for p in catalog:
        by_cat.setdefault(p["category"], []).append(p)
    out = {}
    for name, cat in queries:
        q = name.lower() if name else ""
        if accessory(q):
            out[(q, cat or "")] = (None, 0.0, "accessory_filter")
            continue
        qt = set(TOKEN.findall(q))
        cands = by_cat.get(cat, []) if cat else [p for ps in by_cat.values() for p in ps]
        best, bp = 0.0, None
        for p in cands:
            sig = set(TOKEN.findall(p["canonical_name"].lower()))
            if not sig:
                continue
            s = len(sig & qt) / len(sig)
            if s > best:
                best, bp = s, p
        ok = bp is not None and best >= threshold
        out[(q, cat or "")] = (bp["product_id"] if ok else None, best,
                               "token_overlap" if ok else "below_threshold")
    return out


def _catalog_rows(spark, catalog_df):
    return [r.asDict() for r in catalog_df.orderBy("ord").collect()]


def test_rule_matcher_equals_brute_force(spark):
    cleaned = pipeline.cleaned_listings(spark, SF_SMALL).cache()
    cat = tables.catalog(spark, SF_SMALL)
    catalog = _catalog_rows(spark, cat)
    res = {}
    for plan, hot in (("broadcast", None), ("join", 10_000), ("join_hot", 3)):
        kw = {"hot_postings": hot} if hot else {}
        m = matching.match_queries(cleaned, cat, plan=plan.split("_")[0], **kw).collect()
        res[plan] = {(r["qname"], r["qcat"]): (r["product_id"], r["match_score"], r["match_method"]) for r in m}
    assert res["broadcast"] == res["join"]
    assert res["join_hot"] == res["join"]     # hot tokens via profiles: still exact
    accessory = {k for k, v in res["join"].items() if v[2] == "accessory_filter"}
    exp = brute_rule([(q, c) for q, c in res["join"]], catalog, accessory=lambda q: False)
    for k, v in res["join"].items():
        if k in accessory:
            continue
        assert v == exp[k], (k, v, exp[k])
    # row-level attach: both plans give the same rows
    a = matching.match_rule(cleaned, cat, plan="broadcast").select("product_name", "url", "product_id",
                                                                 "match_method")
    b = matching.match_rule(cleaned, cat, plan="join").select("product_name", "url", "product_id", "match_method")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rule_ties_and_pooling(spark):
    cat = spark.createDataFrame([
        (1, "Alpha Beta", "x", 1), (2, "Alpha Beta", "x", 2), (3, "Alpha Gamma", "y", 3),
        (4, "Beta Delta", "x", 4), (5, "", "x", 5)], "product_id long, canonical_name string, category string, ord long")
    lst = spark.createDataFrame([("alpha beta", "x"), ("alpha gamma", None), ("alpha gamma", "z"),
                                 ("beta", "x"), ("alpha", "")], "product_name_clean string, category string")
    for plan in ("broadcast", "join"):
        m = {(r["qname"], r["qcat"]): r for r in matching.match_queries(lst, cat, plan=plan).collect()}
        assert m[("alpha beta", "x")]["product_id"] == 1            # first in catalog order
        assert m[("alpha gamma", "")]["product_id"] == 3            # no category: all categories
        assert m[("alpha gamma", "z")]["match_method"] == "below_threshold"   # unknown category
        assert m[("alpha gamma", "z")]["match_score"] == 0.0
        assert m[("beta", "x")]["match_score"] == 0.5 and m[("beta", "x")]["product_id"] is None
        # pooled order: category x (first ord 1) before y; 'alpha' scores 0.5 on 1 and 3 -> 1
        assert m[("alpha", "")]["match_score"] == 0.5


@pytest.mark.parametrize("a,b,expected", [
    ("thinkpad x1 yoga", "thinkpad x1 carbon", 100 * (1 - 5 / 27)),
    ("apple macbook air", "apple macbook air m3 16gb", 100.0),
    ("", "x", 0.0),
    ("abc", "xyz", 0.0),
    ("abcd", "abce", 75.0),
])
def test_token_set_ratio_values(a, b, expected):
    assert fuzzy.token_set_ratio(a, b) == pytest.approx(expected)


def test_lcs():
    assert fuzzy.lcs_length("yoga", "carbon") == 1
    assert fuzzy.lcs_length("abcbdab", "bdcaba") == 4
    assert fuzzy.lcs_length("", "abc") == 0


def test_fuzzy_plans_equal_and_brute_force(spark):
    cleaned = pipeline.cleaned_listings(spark, SF_SMALL).cache()
    cat = tables.catalog(spark, SF_SMALL)
    a = {(r["qproc"], r["qcat"]): (r["product_id"], round(r["raw_score"], 9), r["match_method"])
         for r in fuzzy.match_queries(cleaned, cat, plan="broadcast").collect()}
    b = {(r["qproc"], r["qcat"]): (r["product_id"], round(r["raw_score"], 9), r["match_method"])
         for r in fuzzy.match_queries(cleaned, cat, plan="join").collect()}
    assert a == b
    # tiny blocks: many pool chunks and query salts per category, same answer
    c = {(r["qproc"], r["qcat"]): (r["product_id"], round(r["raw_score"], 9), r["match_method"])
         for r in fuzzy.match_queries(cleaned, cat, plan="join", pool_block=7, query_block=50).collect()}
    assert a == c
    # brute force over the deduplicated per-category choices
    catalog = _catalog_rows(spark, cat)

    def proc(s):
        return "".join(ch if ch.isalnum() else " " for ch in s).strip().lower()
    choices = {}
    for p in catalog:
        choices.setdefault(p["category"], {}).setdefault(proc(p["canonical_name"]), p)
    pooled = {k: p for d in choices.values() for k, p in d.items()}
    for (qp, qc), (pid, raw, method) in a.items():
        if method in ("accessory_filter", "no_candidates"):
            continue
        pool = choices.get(qc, {}) if qc else pooled
        best = None
        for k, p in pool.items():
            s = fuzzy.token_set_ratio(qp, k)
            if best is None or s > best[0]:
                best = (s, p)
        assert raw == round(best[0], 9)
        assert pid == (best[1]["product_id"] if best[0] >= 85 else None)


def test_vector_plans_agree(spark):
    q = tables.vector_queries(spark, SF_SMALL)
    c = tables.vector_catalog(spark, SF_SMALL)
    a = {r["query_id"]: (r["product_id"], round(r["match_score"], 9))
         for r in vector.match_vectors(q, c, threshold=0.2, plan="broadcast").collect()}
    b = {r["query_id"]: (r["product_id"], round(r["match_score"], 9))
         for r in vector.match_vectors(q, c, threshold=0.2, plan="join").collect()}
    assert a == b and len(a) == q.count()
    small = {r["query_id"]: (r["product_id"], round(r["match_score"], 9))
             for r in vector.match_vectors(q, tables.vector_catalog(spark, SF_SMALL), threshold=0.2,
                                           plan="join", block=3).collect()}
    assert small == a


def test_embedding_increment(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "product_id long, canonical_name string")
    st = spark.createDataFrame([(1, "a"), (2, "renamed")], "product_id long, canonical_name string")
    got = sorted(r["product_id"] for r in vector.embedding_increment(cur, st).collect())
    assert got == [2, 3]


CATALOG = [(1, "Dell XPS 15 9530", "laptop", 1), (2, "Apple iPhone 15 Pro", "phone", 2), (3, "Apple iPhone 15 Pro", "phone", 3),
           (4, "Odd thing", None, 4), (5, "Samsung Galaxy S24", "phone", 5)]
QUERIES = [("Dell XPS 15 9530 16GB RAM 512GB SSD", "laptop"), ("apple iphone 15 pro", "phone"), ("samsung galaxy s24", ""),
           ("odd thing", None), ("Netzteil kompatibel mit Dell XPS 15", "laptop"), ("dell xps 15 9530", "tablet"), (None, "laptop"),
           ("completely different words", "laptop")]


def _catalog(spark):
    return spark.createDataFrame(CATALOG, "product_id long, canonical_name string, category string, ord long")


def test_matchers_by_name(spark):
    import pytest
    from pricefold.plans.pipeline import match_catalog
    lst = spark.createDataFrame(QUERIES, "product_name_clean string, category string")
    none = {"rule": "below_threshold", "fuzzy": "no_candidates", "vector": "no_candidates"}
    for method in ("rule", "fuzzy", "vector"):
        for plan in ("auto", "join"):
            m = {r["product_name_clean"]: r for r in match_catalog(lst, _catalog(spark), method, plan=plan).collect()}
            assert len(m) == len(QUERIES)
            assert m["Dell XPS 15 9530 16GB RAM 512GB SSD"]["product_id"] == 1
            assert m["apple iphone 15 pro"]["product_id"] == 2                       # the first of the same name
            assert m["samsung galaxy s24"]["product_id"] == 5                        # pooled without a category
            assert m["odd thing"]["product_id"] == 4                                 # a product without a category
            assert m["Netzteil kompatibel mit Dell XPS 15"]["match_method"] == "accessory_filter"
            assert m["dell xps 15 9530"]["match_method"] == none[method]             # unknown category
            assert m[None]["product_id"] is None and m[None]["match_method"] == "below_threshold"
            assert m["completely different words"]["match_method"] == "below_threshold"
    with pytest.raises(ValueError):
        match_catalog(lst, _catalog(spark), "other")


def test_vector_listings_equal_brute_force(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from pricefold.functions import text as TX
    from pricefold.operators.encoder import hashed_ngrams
    cat = _catalog(spark)
    encoder = hashed_ngrams(cat.select(F.col("canonical_name").alias("text")))
    lst = spark.createDataFrame(QUERIES, "name string, category string")
    q = encoder(lst.select("name", F.coalesce("category", F.lit("")).alias("cat"), TX.encoder_text(F.col("name"), F.coalesce("category", F.lit(""))).alias("text")))
    c = encoder(cat.select("*", F.col("canonical_name").alias("text"))).collect()
    got = {r["name"]: r for r in vector.match_listings(lst, cat, 0.3, encoder, name_col="name").collect()}
    for r in q.collect():
        if got[r["name"]]["match_method"] == "accessory_filter":
            continue
        pool = sorted((p for p in c if not r["cat"] or p["category"] == r["cat"]), key=lambda p: (p["category"] or "", p["canonical_name"], p["ord"]))
        if not pool:
            assert got[r["name"]]["match_method"] == "no_candidates"
            continue
        sims = [float(np.dot(np.float64(p["embedding"]), np.float64(r["embedding"]))) for p in pool]
        assert abs(got[r["name"]]["match_score"] - max(sims)) < 1e-6
        if max(sims) >= 0.3:
            assert got[r["name"]]["product_id"] == pool[sims.index(max(sims))]["product_id"]


def test_vector_labels(spark):
    q = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "zz", [1.0, 0.0]), (3, None, [0.0, 1.0])], "query_id long, category string, embedding array<double>")
    c = spark.createDataFrame([(10, "a", 1, [0.0, 1.0]), (11, "b", 2, [0.0, 1.0])], "product_id long, category string, ord long, embedding array<double>")
    for plan in ("broadcast", "join"):
        got = {r["query_id"]: (r["product_id"], r["match_method"]) for r in vector.match_vectors(q, c, plan=plan).collect()}
        assert got == {1: (None, "below_threshold"), 2: (None, "no_candidates"), 3: (10, "cosine_similarity")}


@pytest.mark.parametrize("threshold", [0.3, 0.65, 0.8, 1.0])
def test_prefix_plan_equals_the_join_for_accepted_rows(spark, threshold):
    cleaned = pipeline.cleaned_listings(spark, SF_SMALL)
    cat = tables.catalog(spark, SF_SMALL)
    accepted = lambda plan: {(r["qname"], r["qcat"]): (r["product_id"], r["match_score"])
                             for r in matching.match_queries(cleaned, cat, threshold, plan=plan).where("match_method = 'token_overlap'").collect()}
    want = accepted("join")
    assert accepted("prefix") == want and want
    # postings: n - ceil(t n) + 1 of a signature's n tokens
    idx = matching.indexed_catalog(cat)
    n = idx.agg(F.sum("sig_size")).first()[0]
    read = matching.prefix_postings(idx, threshold).count()
    assert read == sum(max(1, r[0] - max(1, -(-r[0] * int(threshold * 100) // 100)) + 1) for r in idx.select("sig_size").collect())
    assert read < n if threshold > 0.3 else read <= n


def test_prefix_plan_on_random_names(spark):
    import random
    rng = random.Random(8)
    words = [f"w{k}" for k in range(25)]
    cat = spark.createDataFrame([(k, " ".join(rng.sample(words, rng.randint(1, 7))), rng.choice("xy"), k) for k in range(150)] + [(900, "", "x", 900)],
                                "product_id long, canonical_name string, category string, ord long")
    lst = spark.createDataFrame([(" ".join(rng.sample(words, rng.randint(1, 9))), rng.choice(["x", "y", None, "z"])) for _ in range(200)] + [("", "x"), (None, None)],
                                "product_name_clean string, category string")
    for t in (0.5, 2 / 3, 0.75):
        rows = {p: {(r["qname"], r["qcat"]): (r["product_id"], r["match_score"]) for r in
                    matching.match_queries(lst, cat, t, plan=p).where("product_id is not null").collect()} for p in ("join", "prefix")}
        assert rows["prefix"] == rows["join"]


def test_tokens_without_postings_are_not_scored_again():
    idx = pd.DataFrame([("c", ["lamp", "red"], 2, 0, 0, 1, "Red lamp", "c"), ("c", ["chair", "red"], 2, 0, 1, 2, "Red chair", "c")],
                       columns=["key", "sig", "sig_size", "cat_first", "ord", "product_id", "canonical_name", "category"])
    memo = {}
    hits = matching._score_rows(matching._build_index(idx), ["c"] * 5, [["red", "chair"], ["new", "chair", "red"], ["chair", "red", "16gb"], ["new"], None], memo)
    assert [h[1] for h in hits] == [2, 2, 2, None, None] and [h[0] for h in hits] == [1.0, 1.0, 1.0, 0.0, 0.0]
    assert len(memo) == 1
    names = matching._score_names(matching._build_index(idx), pd.Series(["c", "x", "c"]), pd.Series(["red chair (new)", "red chair", ""]), memo)
    assert names["product_id"].tolist() == [2, None, None] and names["score"].tolist() == [1.0, 0.0, 0.0]
