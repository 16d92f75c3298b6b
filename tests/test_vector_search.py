"""Pruned cosine search, the learned encoder and its threshold."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pricefold.operators import latent, quality, vector, vector_pruned
from pricefold.plans import registry, tables


def vectors(spark, n, dims, clusters, spread, seed, first=0):
    rng = np.random.default_rng(seed)
    heads = np.random.default_rng(99).standard_normal((clusters, dims)) if clusters else np.zeros((1, dims))
    m = heads[rng.integers(0, max(1, clusters), n)] + spread * rng.standard_normal((n, dims))
    m /= np.linalg.norm(m, axis=1)[:, None]
    return [(first + k, "ab"[int(rng.integers(0, 2))], first + k, [float(x) for x in v]) for k, v in enumerate(m)]


PRODUCT, QUERY = "product_id long, category string, ord long, embedding array<double>", "query_id long, category string, embedding array<double>"


@pytest.mark.parametrize("clusters,spread", [(30, 0.05), (0, 1.0)])
def test_pruned_search_equals_a_scan(spark, clusters, spread):
    dims = 16
    catalog = vectors(spark, 1500, dims, clusters, spread, 1) + [(9000, "a", 9000, [0.0] * dims), (9001, "a", -1, [2.0] + [0.0] * (dims - 1)), (9002, None, 5, [1.0] + [0.0] * (dims - 1))]
    catalog += [(9100 + k, "b", 9100 + k, catalog[3][3]) for k in range(3)]    # ties: the first in catalog order
    queries = [(k, c, v) for k, c, _, v in vectors(spark, 300, dims, clusters, spread, 2)]
    queries += [(5000, "a", [0.0] * dims), (5001, None, queries[0][2]), (5002, "none", queries[1][2]), (5003, "b", catalog[3][3]), (5004, "a", [0.5] * dims)]
    q, c = spark.createDataFrame(queries, QUERY), spark.createDataFrame(catalog, PRODUCT)
    want = {r["query_id"]: (r["product_id"], round(r["match_score"], 9)) for r in vector.match_vectors(q, c, -2.0, plan="broadcast").collect()}
    best, counts = vector_pruned.best_pruned(q.withColumn("category", F.coalesce("category", F.lit(vector.POOL_KEY))), vector.with_pool(c), cluster=60)
    got = {r["query_id"]: (r["best_product_id"], round(r["best_score"], 9)) for r in best.collect()}
    assert {k: v for k, v in want.items() if v[0] is not None} == got
    if clusters:
        assert counts["visited"] < 0.35 * counts["pairs"]
    whole = {r["query_id"]: (r["product_id"], r["match_method"]) for r in vector.match_vectors(q, c, 0.9, plan="pruned").collect()}
    assert whole == {r["query_id"]: (r["product_id"], r["match_method"]) for r in vector.match_vectors(q, c, 0.9, plan="join").collect()}


def test_directions_are_the_leading_singular_vectors(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    names = [" ".join(rng.choice(words, 3)) for _ in range(80)]
    texts = spark.createDataFrame([(n,) for n in names] + [(None,), ("",)], "text string")
    df, n = latent._document_frequencies(texts)
    assert n == 82 and df.max() <= 80
    encoder = latent.latent_ngrams(texts, rank=4)
    found = np.array([r["embedding"] for r in encoder(texts).select("embedding").collect()])
    idf = np.where(df > 0, np.log((n + 1) / (df + 1)) + 1, 0.0)
    a = np.zeros((82, latent.FEATURES))
    for k, t in enumerate(names + [None, ""]):
        at, w = latent.weighted(t, idf)
        a[k, at] = w
    v = np.linalg.svd(a, full_matrices=False)[2][:4].T
    want = a @ v
    want /= np.maximum(np.linalg.norm(want, axis=1), 1e-12)[:, None]
    assert np.abs(found @ found.T - want @ want.T).max() < 1e-3    # the same up to a rotation
    assert (found[-2:] == 0).all()
    unseen = encoder(spark.createDataFrame([("zzzz qqqq",)], "text string")).first()["embedding"]
    assert np.abs(unseen).max() < 1.01


def test_an_empty_catalog_gives_zero_vectors(spark):
    none = spark.createDataFrame([], "text string")
    encoder = latent.latent_ngrams(none)
    assert encoder(none).collect() == []
    assert list(encoder(spark.createDataFrame([("x",)], "text string")).first()["embedding"]) == []


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_quality_of_the_vector_matcher_has_a_floor(spark, sf):
    r = registry.QUERIES["match_quality_vector"](spark, sf).first()
    assert r["recall"] >= 0.9 and r["precision"] >= 0.9 and r["fp_accessory"] == 0


def test_near_misses_are_no_products(spark):
    catalog = tables.catalog(spark, SF_SMALL)
    cases = quality.near_miss_cases(catalog).collect()
    names = {(r["canonical_name"], r["category"]) for r in catalog.collect()}
    assert cases and not any((r["query"], r["category"]) in names for r in cases)
