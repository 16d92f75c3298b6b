"""Role views over the driver tables (listings, catalog, vectors, run metrics).

Each view exists twice: as a DataFrame (what runs) and as DuckDB SQL (what
the oracle runs).  Both are built from the same fixed variant rules below.

* listings = lineitem ⋈ part ⋈ supplier ⋈ nation, raw listing shape (F1)
* catalog  = part (product_id = p_partkey, which is also the catalog order)
* vectors  = embeddings (odd vec_id = queries, even = catalog, label = category)
* runs     = events (approach = event_type, source bucket = user_id)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.joins import shared
from ..session import table_path

# FIXED VALUES for the listing view: the name variant per l_linenumber mirrors
# the clean / noisy-en / noisy-de / markup / accessory / partial cases.
BLANK_NAME_MOD = 97        # l_orderkey % 97 = 0 -> missing name
NULL_CATEGORY_MOD = 89     # l_orderkey % 89 = 0 -> missing category
BLANK_URL_MOD = 53         # l_orderkey % 53 = 0 -> blank url
NULL_CURRENCY_MOD = 7      # l_suppkey % 7 = 0 -> missing currency
URL_PREFIX = "https://shop.example/item/"
PART_TYPES = ("standard", "economy", "medium", "promo", "large", "small")
# Category map for the listing view: the reference map plus plural forms.
LISTING_CATEGORY_MAP = dict(K.CATEGORY_MAP, **{t + "s": t for t in PART_TYPES})


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what depends on the line alone is worked out before the joins, so that few and narrow columns are shuffled
    ln = F.col("l_linenumber")
    price = (F.when(F.col("l_discount") == 0, F.lit(0.0))
              .when(ln == 6, F.col("l_extendedprice"))
              .otherwise(F.col("l_extendedprice") / F.col("l_quantity")))
    avail = (F.when(F.col("l_returnflag") == "A", F.lit(1)).when(F.col("l_returnflag") == "N", F.lit(2))
              .when(F.col("l_linestatus") == "F", F.lit(3)).otherwise(F.lit(0)))
    plural, no_category = F.coalesce(ln.isin(2, 4), F.lit(False)), F.coalesce(F.col("l_orderkey") % NULL_CATEGORY_MOD == 0, F.lit(False))
    l = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", price.alias("_price"), avail.cast("byte").alias("_avail"),
        F.when(no_category, F.lit(2)).when(plural, F.lit(1)).otherwise(F.lit(0)).cast("byte").alias("_cat"))
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # sellers with their countries are few to the lines: with them sent whole, lines are shuffled once, for their parts
    s = shared(s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "s_name", "n_name"))
    j = l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey)
    bn = F.concat_ws(" ", "p_brand", "p_name")
    name = (F.when(ln == 1, bn)
             .when(ln == 2, F.concat(F.upper("p_brand"), F.lit(" "), F.col("p_name"), F.lit(K.NOISY_EN_SUFFIX)))
             .when(ln == 3, F.concat(F.lit(K.NOISY_DE_PREFIX), bn, F.lit(K.NOISY_DE_SUFFIX)))
             .when(ln == 4, F.concat(F.lit("<b>"), F.col("p_brand"), F.lit("</b> "), F.col("p_name"), F.lit(" – Neu")))
             .when(ln == 5, F.concat(F.lit("Netzteil kompatibel mit "), bn))
             .when(ln == 6, F.col("p_name"))
             .otherwise(F.concat(bn, F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))))
    name = F.when(F.col("l_orderkey") % BLANK_NAME_MOD == 0, F.lit(None).cast("string")).otherwise(name)
    currency = F.when(F.col("l_suppkey") % NULL_CURRENCY_MOD == 0, F.lit(None).cast("string"))\
                .otherwise(F.lit(K.DEFAULT_CURRENCY))
    avail = (F.when(F.col("_avail") == 1, F.lit("In Stock"))
              .when(F.col("_avail") == 2, F.lit("nicht verfügbar"))
              .when(F.col("_avail") == 3, F.lit("Ausverkauft")))
    url = F.when(F.col("l_orderkey") % BLANK_URL_MOD == 0, F.lit(""))\
           .otherwise(F.concat(F.lit(URL_PREFIX), F.col("l_orderkey").cast("string"), F.lit("-"),
                               ln.cast("string")))
    cat = (F.when(F.col("_cat") == 2, F.lit(None).cast("string"))
            .when(F.col("_cat") == 1, F.concat(F.lower("p_type"), F.lit("s")))
            .otherwise(F.col("p_type")))
    return j.select(
        name.alias("product_name"), F.col("_price").alias("price"), currency.alias("currency"),
        avail.alias("availability"), F.col("s_name").alias("seller"), F.col("n_name").alias("source"),
        url.alias("url"), F.col("l_shipdate").alias("scrape_timestamp"), cat.alias("category"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws(" ", "p_brand", "p_name").alias("canonical_name"),
        F.lower("p_type").alias("category"),
        F.col("p_partkey").alias("ord"))


# ----------------------------------------------------------------- SQL forms

LISTINGS_SQL = f"""
SELECT
  CASE WHEN l_orderkey % {BLANK_NAME_MOD} = 0 THEN NULL
       WHEN l_linenumber = 1 THEN p_brand || ' ' || p_name
       WHEN l_linenumber = 2 THEN upper(p_brand) || ' ' || p_name || '{K.NOISY_EN_SUFFIX}'
       WHEN l_linenumber = 3 THEN '{K.NOISY_DE_PREFIX}' || p_brand || ' ' || p_name || '{K.NOISY_DE_SUFFIX}'
       WHEN l_linenumber = 4 THEN '<b>' || p_brand || '</b> ' || p_name || ' – Neu'
       WHEN l_linenumber = 5 THEN 'Netzteil kompatibel mit ' || p_brand || ' ' || p_name
       WHEN l_linenumber = 6 THEN p_name
       ELSE p_brand || ' ' || p_name || ' (' || CAST(p_size AS VARCHAR) || ')' END AS product_name,
  CASE WHEN l_discount = 0 THEN 0.0
       WHEN l_linenumber = 6 THEN l_extendedprice
       ELSE l_extendedprice / l_quantity END AS price,
  CASE WHEN l_suppkey % {NULL_CURRENCY_MOD} = 0 THEN NULL ELSE '{K.DEFAULT_CURRENCY}' END AS currency,
  CASE WHEN l_returnflag = 'A' THEN 'In Stock'
       WHEN l_returnflag = 'N' THEN 'nicht verfügbar'
       WHEN l_linestatus = 'F' THEN 'Ausverkauft' END AS availability,
  s_name AS seller, n_name AS source,
  CASE WHEN l_orderkey % {BLANK_URL_MOD} = 0 THEN ''
       ELSE '{URL_PREFIX}' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS url,
  l_shipdate AS scrape_timestamp,
  CASE WHEN l_orderkey % {NULL_CATEGORY_MOD} = 0 THEN NULL
       WHEN l_linenumber IN (2, 4) THEN lower(p_type) || 's'
       ELSE p_type END AS category
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
"""

CATALOG_SQL = """
SELECT p_partkey AS product_id, p_brand || ' ' || p_name AS canonical_name,
       lower(p_type) AS category, p_partkey AS ord
FROM part
"""


def re2(pattern: str) -> str:
    """Java-regex pattern -> RE2 (DuckDB) pattern for the oracle: Java-only
    inline flags are dropped (RE2's ``U`` would mean ungreedy)."""
    for java, r in (("(?iusU)", "(?is)"), ("(?iuU)", "(?i)"), ("(?iU)", "(?i)"), ("(?U)", ""),
                    ("(?iu)", "(?i)")):
        pattern = pattern.replace(java, r)
    # RE2's \w is ASCII-only; Java's (?U)\w covers all letters and digits.
    return pattern.replace("\\w", "[\\p{L}\\p{N}_]")


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def category_case_sql(col: str, mapping: dict) -> str:
    low = f"lower(coalesce({col}, ''))"
    whens = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in mapping.items())
    return f"(CASE {low} {whens} ELSE {low} END)"


def clean_name_sql(col: str, nfc: bool = False) -> str:
    """DuckDB form of the name normaliser for NFKC-stable text (the oracle)."""
    s = f"regexp_replace({col}, '<[^>]+>', ' ', 'g')"
    if nfc:
        s = f"nfc_normalize({s})"
    s = f"regexp_replace({s}, '[‐-―−]', '-', 'g')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s\\-.,\"/''()]', ' ', 'g')"
    s = f"lower({s})"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    s = f"trim({s})"
    return f"(CASE WHEN {col} IS NULL OR regexp_matches({col}, '^\\s*$') THEN '' ELSE {s} END)"


def availability_sql(col: str) -> str:
    t = f"coalesce(CAST({col} AS VARCHAR), '')"
    return (f"(CASE WHEN regexp_matches({t}, {sql_str(re2(K.IN_STOCK_PATTERN))}) THEN 'in_stock' "
            f"WHEN regexp_matches({t}, {sql_str(re2(K.OUT_OF_STOCK_PATTERN))}) THEN 'out_of_stock' "
            f"WHEN lower({t}) IN ('in_stock', 'out_of_stock', 'unknown') THEN lower({t}) "
            f"ELSE 'unknown' END)")


def normalized_sql(src: str = "listings_raw") -> str:
    return f"""
SELECT product_name, price, currency, availability, seller, source, url, scrape_timestamp,
       {category_case_sql('category', LISTING_CATEGORY_MAP)} AS category,
       nullif({clean_name_sql('product_name')}, '') AS product_name_clean,
       CASE WHEN NOT isnan(price) AND price >= 0 THEN price END AS price_clean,
       {availability_sql('availability')} AS availability_clean
FROM {src}
"""


def with_views(body: str) -> str:
    """Prefix an oracle query with the listings / catalog CTEs."""
    return f"WITH listings_raw AS ({LISTINGS_SQL}),\ncatalog AS ({CATALOG_SQL}),\n{body}"


# ----------------------------------------------------------- run metrics
RUN_SOURCES = 4
RUN_CATEGORIES = ("laptops", "gpus", "phones")
FAIL_MOD = 7


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-metric rows (F7) from ``events``: approach = event_type, source =
    user bucket, seconds = value, products = props.k (0 on failure)."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    ok = (k % FAIL_MOD) != 0
    cats = F.array(*[F.lit(c) for c in RUN_CATEGORIES])
    return e.select(
        F.col("event_type").alias("scraper_name"),
        F.concat(F.lit("source_"), (F.col("user_id") % RUN_SOURCES).cast("string")).alias("source"),
        F.element_at(cats, (F.col("user_id") % len(RUN_CATEGORIES) + 1).cast("int")).alias("category"),
        F.when(ok, k).otherwise(F.lit(0)).alias("products_found"),
        F.col("value").alias("time_seconds"),
        ok.alias("success"),
        F.when(ok, F.lit("")).otherwise(F.concat(
            F.lit("HTTP 503 Service Unavailable while fetching page "), F.col("event_id").cast("string")))
         .alias("error_message"),
        F.when(F.col("event_type").isin("purchase", "view"), F.col("value") / 1000.0).otherwise(F.lit(0.0))
         .alias("cost_usd"),
        F.when(F.col("event_type") == "view", k * 100).otherwise(F.lit(0)).alias("tokens_used"),
        F.col("ts").alias("timestamp"))


RUNS_SQL = f"""
SELECT event_type AS scraper_name, 'source_' || CAST(user_id % {RUN_SOURCES} AS VARCHAR) AS source,
       (['laptops', 'gpus', 'phones'])[CAST(user_id % 3 AS INTEGER) + 1] AS category,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % {FAIL_MOD} <> 0
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) ELSE 0 END AS products_found,
       value AS time_seconds,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % {FAIL_MOD} <> 0 AS success,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % {FAIL_MOD} <> 0 THEN ''
            ELSE 'HTTP 503 Service Unavailable while fetching page ' || CAST(event_id AS VARCHAR) END AS error_message,
       CASE WHEN event_type IN ('purchase', 'view') THEN value / 1000.0 ELSE 0.0 END AS cost_usd,
       CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) * 100 ELSE 0 END AS tokens_used,
       ts AS timestamp
FROM events"""


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.where(F.col("vec_id") % 2 == 1).select(
        F.col("vec_id").alias("query_id"), F.col("label").cast("string").alias("category"), "embedding")


def vector_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.where(F.col("vec_id") % 2 == 0).select(
        F.col("vec_id").alias("product_id"), F.col("label").cast("string").alias("category"),
        F.col("vec_id").alias("ord"), "embedding")
