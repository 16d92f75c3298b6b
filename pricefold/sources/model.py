"""Saved language-model extraction responses -> listing rows.

Input: (source, response[, input_tokens, output_tokens]).  The response text
is parsed as a JSON array of listings; code fences are stripped first; a
response that is not an array yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import prices as PR
from ..functions import text as TX

MODEL_ITEM = T.ArrayType(T.StructType([
    T.StructField("product_name", T.StringType()), T.StructField("price", T.VariantType()),
    T.StructField("currency", T.StringType()), T.StructField("availability", T.StringType()),
    T.StructField("url", T.StringType())]))


def parse_response(c: Column) -> Column:
    """Fence-stripped text parsed as array<struct>; null unless it is a JSON array and nothing else."""
    t = F.regexp_replace(F.regexp_replace(c, K.CODE_FENCE_PATTERN, ""), r"^(?U)\s+|(?U)\s+$", "")
    # a closing field behind the text: where the text ends early or goes on, that field can't be read
    schema = T.StructType([T.StructField("rows", MODEL_ITEM), T.StructField("_end", T.IntegerType())])
    doc = F.from_json(F.concat(F.lit('{"rows":'), t, F.lit(',"_end":1}')), schema)
    return F.when(t.startswith("[") & (doc["_end"] == 1), doc["rows"])


def model_rows(responses: DataFrame, category: Column, scraped_at: Column | None = None) -> DataFrame:
    """One row per extracted item; blank names dropped; availability
    validated against the canonical set; currency default EUR; seller is the
    display form of the source key (P30)."""
    items = responses.select("source", F.explode(F.coalesce(parse_response(F.col("response")),
                                                          F.array())).alias("it"), *(
        [category.alias("_cat")]))
    name = F.trim(F.coalesce(F.col("it.product_name"), F.lit("")))
    a = F.lower(F.coalesce(F.col("it.availability"), F.lit("unknown")))
    avail = F.when(a.isin(*K.CANONICAL_AVAILABILITY), a).otherwise(F.lit("unknown"))
    cur = F.when(F.coalesce(F.col("it.currency"), F.lit("")) != "", F.col("it.currency"))
    url = F.trim(F.coalesce(F.col("it.url"), F.lit("")))
    kind = T.VariantType()
    price = F.when(PR.price_given(F.col("it.price"), kind), PR.parse_price_api(F.col("it.price"), kind)).otherwise(F.lit(0.0))
    ts = scraped_at if scraped_at is not None else F.current_timestamp()
    return items.where(name != "").select(
        name.alias("product_name"), price.alias("price"),
        F.coalesce(cur, F.lit(K.DEFAULT_CURRENCY)).alias("currency"), avail.alias("availability"),
        TX.display_name(F.col("source")).alias("seller"), F.col("source"), url.alias("url"),
        ts.alias("scrape_timestamp"), F.col("_cat").alias("category"))


def window_text(df: DataFrame, col: str = "markdown") -> DataFrame:
    """P16 relevance window on a text column."""
    return df.withColumn("window", TX.relevance_window(F.col(col)))


def call_cost(df: DataFrame) -> DataFrame:
    """P18 per response."""
    return df.withColumn("cost_usd", PR.token_cost("input_tokens", "output_tokens"))
