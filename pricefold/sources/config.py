"""Configuration tables (S14) and the collection work list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX

PRODUCT_SCHEMA = "category string, name string, search_query string, brand string, model string"
SOURCE_SCHEMA = ("source_key string, display_name string, base_url string, scraper_class string, "
                 "enabled boolean, search_url_template string, currency string, "
                 "rate_limit_delay int, use_playwright boolean")


def products_table(spark: SparkSession, config: dict) -> DataFrame:
    """products.yaml shape: {category: [{name, search_query, brand, model}]}."""
    rows = [(cat, p.get("name"), p.get("search_query"), p.get("brand"), p.get("model"))
            for cat, items in (config or {}).items() for p in (items or [])]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def sources_table(spark: SparkSession, config: dict) -> DataFrame:
    """sources.yaml shape: {source_key: {display_name, base_url, ...}}."""
    rows = [(k, v.get("display_name"), v.get("base_url"), v.get("scraper_class"),
             bool(v.get("enabled", True)), v.get("search_url_template"), v.get("currency", "EUR"),
             int(v.get("rate_limit_delay", 2)), bool(v.get("use_playwright", False)))
            for k, v in (config or {}).items()]
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def load_yaml(path: str) -> dict:
    import yaml
    with open(path, encoding="utf-8") as fh:
        return yaml.safe_load(fh) or {}


def default_coverage(spark: SparkSession, sources_cfg: dict, products_cfg: dict) -> DataFrame:
    """(source_key, category) pairs the reference collects: every configured
    source for every configured category.  Expanded from the two
    configuration documents themselves (a handful of entries), not from data."""
    rows = [(k, c) for k in (sources_cfg or {}) for c in (products_cfg or {})]
    return spark.createDataFrame(rows, "source_key string, category string")


def work_list(products: DataFrame, sources: DataFrame, coverage: DataFrame, categories=None) -> DataFrame:
    """Enabled sources x products of known categories, as equi-joins on
    the coverage table, with the filled search URL (P19)."""
    p = products if categories is None else products.where(F.col("category").isin(*categories))
    s = sources.where(F.col("enabled"))
    pairs = s.join(coverage, "source_key").join(p, "category")
    return pairs.select("source_key", "category", "name", "search_query",
                        TX.search_url(F.col("search_url_template"), F.col("search_query"), F.col("name"))
                         .alias("search_url"))
