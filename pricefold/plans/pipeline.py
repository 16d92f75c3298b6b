"""The flagship plan: clean -> match -> merge (reference ``full`` command)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, fuzzy, matching, merging, vector
from ..session import written
from . import tables

METHODS = ("rule", "fuzzy", "vector")


def match_catalog(listings: DataFrame, catalog: DataFrame, method: str = "vector", threshold: float | None = None,
                  **options) -> DataFrame:
    """Listings with their MatchResult columns by the matcher of that name, at its own or the given threshold.

    A fuzzy threshold of at most 1 is a fraction of 100.  ``options`` go to the
    matcher (``plan``; ``encoder`` for vectors)."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: one of {', '.join(METHODS)}")
    if threshold is not None:
        options["threshold"] = threshold
    if method == "rule":
        return matching.match_rule(listings, catalog, **options)
    if method == "fuzzy":
        return fuzzy.match_fuzzy(listings, catalog, **options).drop("raw_score")
    return vector.match_listings(listings, catalog, **options)


def cleaned_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(tables.listings(spark, sf_dir), category_map=tables.LISTING_CATEGORY_MAP)


def matched_listings(spark: SparkSession, sf_dir: str, method: str = "rule", **options) -> DataFrame:
    return match_catalog(cleaned_listings(spark, sf_dir), tables.catalog(spark, sf_dir), method, **options)


def unified_prices(spark: SparkSession, sf_dir: str, method: str = "rule", **options) -> DataFrame:
    """Scalar part of the unified price records (A2) for every matched product."""
    listings = cleaned_listings(spark, sf_dir).select("product_name_clean", "category", "price_clean", "is_anomaly")
    if method != "rule":
        # these matchers read the listings twice, for the different names and for the result; cleaning is done once
        listings = written(listings, "cleaned")
    m = matching.matched_only(match_catalog(listings, tables.catalog(spark, sf_dir), method, **options))
    return merging.product_stats(m, matched_by=method).select(
        "product_id", "canonical_name", "category", "price_min", "price_max", "price_mean",
        "offer_count", "anomaly_count", "matched_by")
