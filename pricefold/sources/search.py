"""Saved search-API results: document scan (S12) and row projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import prices as PR
from ..functions import text as TX

SHOPPING_ITEM = T.StructType([
    T.StructField("position", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("price", T.VariantType()), T.StructField("extracted_price", T.DoubleType()),
    T.StructField("currency", T.StringType()), T.StructField("rating", T.DoubleType()),
    T.StructField("reviews", T.IntegerType()), T.StructField("thumbnail", T.StringType()),
    T.StructField("in_stock", T.BooleanType())])
ORGANIC_ITEM = T.StructType([
    T.StructField("position", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()), T.StructField("snippet", T.StringType()),
    T.StructField("displayed_link", T.StringType())])
SEARCH_DOC = T.StructType([
    T.StructField("search_metadata", T.StructType([
        T.StructField("status", T.StringType()), T.StructField("engine", T.StringType()),
        T.StructField("total_time_taken", T.DoubleType())])),
    T.StructField("search_parameters", T.StructType([
        T.StructField("engine", T.StringType()), T.StructField("q", T.StringType()),
        T.StructField("gl", T.StringType()), T.StructField("hl", T.StringType())])),
    T.StructField("shopping_results", T.ArrayType(SHOPPING_ITEM)),
    T.StructField("organic_results", T.ArrayType(ORGANIC_ITEM))])


def read_search_docs(spark: SparkSession, path) -> DataFrame:
    """One row per saved response document (JSON object per file)."""
    return spark.read.schema(SEARCH_DOC).option("multiLine", True).json(path)


def explode_results(docs: DataFrame, field: str) -> DataFrame:
    """One row per result element; a missing array gives no rows."""
    return docs.select(F.explode(F.coalesce(F.col(field), F.array())).alias("r")).select("r.*")


def record_shape(name: Column, price: Column, availability: Column, seller: Column, url: Column,
                 category: Column, source_key: str, currency: Column | None = None,
                 default_currency: str = K.DEFAULT_CURRENCY, scraped_at: Column | None = None) -> list:
    """P10: the nine-field raw record with source defaults."""
    return [name.alias("product_name"), price.alias("price"),
            F.coalesce(currency if currency is not None else F.lit(None).cast("string"),
                       F.lit(default_currency)).alias("currency"),
            availability.alias("availability"), seller.alias("seller"),
            F.lit(source_key).alias("source"), url.alias("url"),
            (scraped_at if scraped_at is not None else F.current_timestamp()).alias("scrape_timestamp"),
            category.alias("category")]


def _truthy_str(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def shopping_rows(items: DataFrame, category: Column, scraped_at: Column | None = None,
                  source_key: str = "google_shopping") -> DataFrame:
    """Blank titles dropped; price = extracted_price, else the price text
    (API dialect), else 0; seller default; in stock iff flag (default true)
    and price > 0."""
    name = F.trim(F.coalesce(F.col("title"), F.lit("")))
    ep = F.col("extracted_price")
    kind = items.schema["price"].dataType
    price = (F.when(ep.isNotNull() & (ep != 0), ep)
              .when(PR.price_given("price", kind), PR.parse_price_api("price", kind))
              .otherwise(F.lit(0.0)))
    seller = F.trim(F.when(_truthy_str(F.col("source")), F.col("source"))
                     .otherwise(F.lit(K.SHOPPING_DEFAULT_SELLER)))
    url = F.trim(F.coalesce(F.col("link"), F.lit("")))
    in_stock = F.coalesce(F.col("in_stock"), F.lit(True)) if "in_stock" in items.columns else F.lit(True)
    avail = F.when(in_stock & (price > 0), F.lit("in_stock")).otherwise(F.lit("unknown"))
    return items.where(name != "").select(
        *record_shape(name, price, avail, seller, url, category, source_key, scraped_at=scraped_at))


def organic_rows(items: DataFrame, category: Column, scraped_at: Column | None = None,
                 source_key: str = "idealo_de_serpapi", domain: str = K.ORGANIC_DOMAIN) -> DataFrame:
    """Domain filter (P9), title suffix strip (P8), snippet price."""
    title = F.trim(F.coalesce(F.col("title"), F.lit("")))
    url = F.trim(F.coalesce(F.col("link"), F.lit("")))
    snippet = F.trim(F.coalesce(F.col("snippet"), F.lit("")))
    name = TX.strip_title_suffix(title)
    price = PR.price_from_snippet(snippet)
    avail = F.when(price > 0, F.lit("in_stock")).otherwise(F.lit("unknown"))
    kept = items.where(TX.domain_filter(title, url, domain)).where(name != "")
    return kept.select(*record_shape(name, price, avail, F.lit(K.ORGANIC_SELLER), url, category, source_key,
                                     scraped_at=scraped_at))
