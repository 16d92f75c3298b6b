import pytest

from conftest import SF_SMALL
from pricefold.operators import fuzzy, vector
from pricefold.plans import pipeline, registry, tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("method", ["fuzzy", "vector"])
def test_unified_prices_clean_the_listings_once(spark, method):
    got = pipeline.unified_prices(spark, SF_SMALL, method)
    assert "l_orderkey" not in plan(got) and got.count() > 0


def test_vector_outcomes_clean_the_listings_once(spark, monkeypatch):
    given = []
    monkeypatch.setattr(vector, "match_listings", lambda listings, catalog: given.append(listings) or match(listings, catalog))
    match = fuzzy.match_fuzzy
    registry.QUERIES["match_vector_outcomes"](spark, SF_SMALL)
    assert "l_orderkey" not in plan(given[0])


def test_fuzzy_matches_of_raw_names_are_those_of_the_listings(spark):
    cat = tables.catalog(spark, SF_SMALL)
    name, category = cat.select("canonical_name", "category").first()
    rows = [(1, name, category), (2, name.upper() + "!", category), (3, name, None), (4, None, category), (5, None, None), (6, "", ""),
            (7, name, "elsewhere"), (8, name, category), (8, name, category), (9, "case for " + name, category), (10, " -- ", category)]
    listings = spark.createDataFrame(rows, "k int, product_name_clean string, category string")
    got = fuzzy.match_fuzzy(listings, cat)
    want = fuzzy.attach(listings, fuzzy.match_queries(listings, cat))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == len(rows)
