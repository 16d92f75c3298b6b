"""Registered queries (one per operator family) and their DuckDB oracle SQL.

Every query reads the driver tables (or frames Spark derives from them) in
full; outputs are aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import cleaning as C
from ..functions import prices as PR
from ..functions import text as TX
from ..operators import cleaning, matching, merging
from . import pipeline, tables
from .tables import re2, sql_str, with_views

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ====================================================================== SQL
def acc_sql(x: str) -> str:
    return (f"(regexp_matches(coalesce({x}, ''), {sql_str(re2(K.ACCESSORY_PATTERN))}) OR "
            f"regexp_matches(coalesce({x}, ''), {sql_str(re2(K.DISPLAY_PART_PATTERN))}))")


_TIE = ["product_name", "price", "currency", "availability", "seller", "url", "category",
        "availability_clean", "is_anomaly"]

CLEANED_CTES = f"""
norm AS ({tables.normalized_sql()}),
med AS (SELECT category, median(price_clean) AS m FROM norm WHERE price_clean IS NOT NULL GROUP BY category),
flagged AS (
  SELECT norm.*, CASE WHEN price_clean IS NULL OR m IS NULL OR m <= 0 THEN false
                      ELSE (price_clean > 3.0 * m OR price_clean < {K.ANOMALY_LOW_FACTOR!r} * m) END AS is_anomaly
  FROM norm LEFT JOIN med USING (category)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_name_clean, source, price_clean
     ORDER BY (scrape_timestamp IS NOT NULL) DESC, scrape_timestamp DESC,
     {", ".join(c + " DESC NULLS LAST" for c in _TIE)}) AS rn
  FROM flagged WHERE product_name_clean IS NOT NULL AND source IS NOT NULL AND price_clean IS NOT NULL),
cleaned AS (
  SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1
  UNION ALL
  SELECT * FROM flagged WHERE product_name_clean IS NULL OR source IS NULL OR price_clean IS NULL)"""

RULE_CTES = f"""
q AS (SELECT DISTINCT lower(coalesce(product_name_clean, '')) AS qname, coalesce(category, '') AS qcat FROM cleaned),
qa AS (SELECT qname, qcat, {acc_sql('qname')} AS acc,
              list_distinct(regexp_extract_all(qname, '([a-z0-9]+)', 1)) AS qt FROM q),
cf AS (SELECT category, min(ord) AS cat_first FROM catalog GROUP BY category),
cs AS (SELECT c.product_id, c.canonical_name, c.category AS pcat, c.ord, cf.cat_first,
              list_distinct(regexp_extract_all(lower(c.canonical_name), '([a-z0-9]+)', 1)) AS sig
       FROM catalog c JOIN cf USING (category)),
pairs AS (SELECT qa.qname, qa.qcat, cs.*,
                 len(list_filter(cs.sig, lambda x: list_contains(qa.qt, x)))::DOUBLE / len(cs.sig) AS score
          FROM qa JOIN cs ON (cs.pcat = qa.qcat OR qa.qcat = '')
          WHERE NOT qa.acc AND len(cs.sig) > 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qname, qcat
                                   ORDER BY score DESC, cat_first, ord) AS rn
                        FROM pairs WHERE score > 0) WHERE rn = 1),
res AS (SELECT qa.qname, qa.qcat,
          CASE WHEN NOT qa.acc AND best.score >= {K.RULE_THRESHOLD} THEN best.product_id END AS product_id,
          CASE WHEN NOT qa.acc AND best.score >= {K.RULE_THRESHOLD} THEN best.canonical_name END AS canonical_name,
          CASE WHEN NOT qa.acc AND best.score >= {K.RULE_THRESHOLD} THEN best.pcat END AS product_category,
          CASE WHEN qa.acc THEN 0.0 ELSE coalesce(best.score, 0.0) END AS match_score,
          CASE WHEN qa.acc THEN 'accessory_filter'
               WHEN best.score >= {K.RULE_THRESHOLD} THEN 'token_overlap'
               ELSE 'below_threshold' END AS match_method
        FROM qa LEFT JOIN best USING (qname, qcat)),
matched AS (SELECT cleaned.*, res.product_id, res.canonical_name, res.product_category,
                   res.match_score, res.match_method
            FROM cleaned JOIN res ON lower(coalesce(cleaned.product_name_clean, '')) = res.qname
                                 AND coalesce(cleaned.category, '') = res.qcat)"""

# Mean rounded half up to cents, from integers of 1e-9, so that no summation order decides.
MEAN2 = """CASE WHEN count({x}) FILTER (WHERE {w}) > 0 THEN
         sign(sum(CAST({x} AS DECIMAL(38,9))) FILTER (WHERE {w})) *
         ((abs(CAST(sum(CAST({x} AS DECIMAL(38,9))) FILTER (WHERE {w}) * 1000000000 AS HUGEINT)) * 2
           + count({x}) FILTER (WHERE {w}) * 10000000) // (count({x}) FILTER (WHERE {w}) * 20000000))::DOUBLE / 100.0 END"""


# ============================================================== flagship
@register("flagship_unified_prices", with_views(CLEANED_CTES + "," + RULE_CTES + f"""
SELECT product_id, min(canonical_name) AS canonical_name, min(product_category) AS category,
       min(price_clean) FILTER (WHERE NOT is_anomaly) AS price_min,
       max(price_clean) FILTER (WHERE NOT is_anomaly) AS price_max,
       {MEAN2.format(x="price_clean", w="NOT is_anomaly")} AS price_mean,
       count(*) AS offer_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       'rule' AS matched_by
FROM matched WHERE product_id IS NOT NULL GROUP BY product_id"""))
def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.unified_prices(spark, sf)


# ============================================================== cleaning
@register("clean_category", with_views(f"""
x AS (SELECT category AS raw_category,
             {tables.category_case_sql('category', tables.LISTING_CATEGORY_MAP)} AS category
      FROM listings_raw)
SELECT raw_category, category, count(*) AS n FROM x GROUP BY raw_category, category"""))
def q_clean_category(spark, sf):
    l = tables.listings(spark, sf)
    return (l.select(F.col("category").alias("raw_category"),
                     C.normalize_category("category", tables.LISTING_CATEGORY_MAP).alias("category"))
             .groupBy("raw_category", "category").agg(F.count(F.lit(1)).alias("n")))


@register("clean_name", with_views(f"""
x AS (SELECT DISTINCT product_name FROM listings_raw)
SELECT product_name, nullif({tables.clean_name_sql('product_name')}, '') AS product_name_clean FROM x"""))
def q_clean_name(spark, sf):
    l = tables.listings(spark, sf).select("product_name").distinct()
    return l.select("product_name", C.blank_to_null(C.clean_name("product_name")).alias("product_name_clean"))


# Price texts in several locales, built from integer parts of lineitem.
PRICE_TEXT_SQL = """
CASE l_linenumber
  WHEN 1 THEN CAST(floor(l_extendedprice / 1000) AS BIGINT)::STRING || '.'
              || lpad((CAST(floor(l_extendedprice) AS BIGINT) % 1000)::STRING, 3, '0') || ','
              || lpad((CAST(floor(l_extendedprice * 100) AS BIGINT) % 100)::STRING, 2, '0') || ' €'
  WHEN 2 THEN CAST(floor(l_extendedprice / 1000) AS BIGINT)::STRING || ','
              || lpad((CAST(floor(l_extendedprice) AS BIGINT) % 1000)::STRING, 3, '0') || '.'
              || lpad((CAST(floor(l_extendedprice * 100) AS BIGINT) % 100)::STRING, 2, '0')
  WHEN 3 THEN (CAST(floor(l_extendedprice) AS BIGINT) % 1000)::STRING || ','
              || (CAST(floor(l_extendedprice * 10) AS BIGINT) % 10)::STRING
  WHEN 4 THEN 'ca. ' || CAST(floor(l_extendedprice) AS BIGINT)::STRING
  WHEN 5 THEN CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 'ab ' || CAST(floor(l_extendedprice / 1000) AS BIGINT)::STRING || '.'
              || lpad((CAST(floor(l_extendedprice) AS BIGINT) % 1000)::STRING, 3, '0') || ' EUR' END
  WHEN 6 THEN '-' || CAST(floor(l_extendedprice) AS BIGINT)::STRING
  ELSE CAST(floor(l_extendedprice / 1000) AS BIGINT)::STRING || ' ' || '€' || ' '
       || lpad((CAST(floor(l_extendedprice) AS BIGINT) % 1000)::STRING, 3, '0') || ',99'
END"""

def dialect_a_sql(t: str) -> str:
    """Text prices: the first run of digits, dots and commas; ",dd" at its end means German decimals."""
    tok = f"regexp_extract(replace({t}, chr(160), ''), '[0-9.,]+', 0)"
    norm = (f"CASE WHEN regexp_matches({tok}, ',[0-9]{{2}}$') "
            f"THEN replace(replace({tok}, '.', ''), ',', '.') ELSE replace({tok}, ',', '') END")
    v = f"TRY_CAST({norm} AS DOUBLE)"
    return f"(CASE WHEN {tok} <> '' AND {v} >= 0 THEN {v} END)"


def dialect_b_sql(t: str, on_fail: str | None = None, strip_prefix: bool = False) -> str:
    s = f"trim(replace({t}, chr(160), {sql_str(' ' if on_fail is None else '')}))"
    if strip_prefix:
        s = f"regexp_replace({s}, '^(?i)(ab|from)\\s*', '')"
    tok = f"regexp_extract({s}, '[0-9.,]+', 0)"
    nc = f"(length({tok}) - length(replace({tok}, ',', '')))"
    nd = f"(length({tok}) - length(replace({tok}, '.', '')))"
    lc = f"(length({tok}) - strpos(reverse({tok}), ','))"
    ld = f"(length({tok}) - strpos(reverse({tok}), '.'))"
    norm = (f"CASE WHEN strpos({tok}, ',') > 0 AND strpos({tok}, '.') > 0 THEN "
            f"  CASE WHEN {lc} > {ld} THEN replace(replace({tok}, '.', ''), ',', '.') ELSE replace({tok}, ',', '') END "
            f"WHEN strpos({tok}, ',') > 0 THEN CASE WHEN {nc} = 1 AND regexp_matches({tok}, ',[0-9]{{3}}$') "
            f"  THEN replace({tok}, ',', '') ELSE replace({tok}, ',', '.') END "
            f"WHEN strpos({tok}, '.') > 0 THEN CASE WHEN {nd} = 1 AND regexp_matches({tok}, '\\.[0-9]{{3}}$') "
            f"  THEN replace({tok}, '.', '') ELSE {tok} END "
            f"ELSE {tok} END")
    v = f"(CASE WHEN {tok} <> '' THEN TRY_CAST({norm} AS DOUBLE) END)"
    return v if on_fail is None else f"coalesce({v}, {on_fail})"


def _price_texts(spark, sf):
    return tables.read(spark, sf, "lineitem").select(F.expr(PRICE_TEXT_SQL).alias("price_text"))


@register("clean_price", f"""
WITH x AS (SELECT DISTINCT {PRICE_TEXT_SQL} AS price_text FROM lineitem)
SELECT price_text, {dialect_a_sql('price_text')} AS price_clean FROM x""")
def q_clean_price(spark, sf):
    x = _price_texts(spark, sf).distinct()
    return x.select("price_text", C.parse_price_clean("price_text").alias("price_clean"))


@register("price_locale", f"""
WITH x AS (SELECT DISTINCT {PRICE_TEXT_SQL} AS price_text FROM lineitem)
SELECT price_text, {dialect_b_sql('price_text')} AS price_html,
       {dialect_b_sql('price_text', '0.0', True)} AS price_api FROM x""")
def q_price_locale(spark, sf):
    x = _price_texts(spark, sf).distinct()
    return x.select("price_text", PR.parse_price_locale("price_text").alias("price_html"),
                    PR.parse_price_api("price_text").alias("price_api"))


@register("clean_availability", with_views(f"""
x AS (SELECT availability, {tables.availability_sql('availability')} AS availability_clean FROM listings_raw)
SELECT availability, availability_clean, count(*) AS n FROM x GROUP BY ALL"""))
def q_clean_availability(spark, sf):
    l = tables.listings(spark, sf)
    return (l.select("availability", C.map_availability("availability").alias("availability_clean"))
             .groupBy("availability", "availability_clean").agg(F.count(F.lit(1)).alias("n")))


@register("anomaly_flags", with_views(CLEANED_CTES + """
SELECT category, round(min(m), 6) AS category_median, count(*) AS n,
       count(*) FILTER (WHERE is_anomaly) AS n_anomalies
FROM flagged LEFT JOIN med USING (category) GROUP BY category"""))
def q_anomaly_flags(spark, sf):
    n = cleaning.normalize(tables.listings(spark, sf), tables.LISTING_CATEGORY_MAP)
    med = cleaning.category_medians(n)
    f = cleaning.flag_anomalies(n, medians=med)
    return (f.groupBy("category").agg(F.count(F.lit(1)).alias("n"),
                                      F.count_if("is_anomaly").alias("n_anomalies"))
             .join(med.select("category", F.round("category_median", 6).alias("category_median")),
                   "category", "left"))


@register("dedup_latest", with_views(CLEANED_CTES + """
SELECT product_name_clean, source, price_clean, scrape_timestamp, url, seller, category, is_anomaly
FROM cleaned"""))
def q_dedup_latest(spark, sf):
    c = pipeline.cleaned_listings(spark, sf)
    return c.select("product_name_clean", "source", "price_clean", "scrape_timestamp", "url", "seller",
                    "category", "is_anomaly")


# ============================================================== matching
@register("match_rule", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT qname, qcat, product_id, canonical_name, match_score, match_method FROM res"""))
def q_match_rule(spark, sf):
    c = pipeline.cleaned_listings(spark, sf)
    m = matching.match_queries(c, tables.catalog(spark, sf))
    return m.select("qname", "qcat", "product_id", "canonical_name", "match_score", "match_method")


@register("match_rule_join", ORACLE["match_rule"] if "match_rule" in ORACLE else None)
def q_match_rule_join(spark, sf):
    c = pipeline.cleaned_listings(spark, sf)
    m = matching.match_queries(c, tables.catalog(spark, sf), plan="join")
    return m.select("qname", "qcat", "product_id", "canonical_name", "match_score", "match_method")


@register("match_excluded", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT match_method, count(*) AS n FROM matched GROUP BY match_method"""))
def q_match_excluded(spark, sf):
    m = pipeline.matched_listings(spark, sf)
    return m.groupBy("match_method").agg(F.count(F.lit(1)).alias("n"))


@register("match_attached", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT product_name_clean, source, price_clean, url, product_id, match_score
FROM matched WHERE product_id IS NOT NULL"""))
def q_match_attached(spark, sf):
    m = matching.matched_only(pipeline.matched_listings(spark, sf))
    return m.select("product_name_clean", "source", "price_clean", "url", "product_id", "match_score")


# ============================================================== reports
@register("funnel", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT (SELECT count(*) FROM listings_raw) AS raw,
       (SELECT count(*) FROM cleaned) AS cleaned,
       (SELECT count(*) FROM listings_raw) - (SELECT count(*) FROM cleaned) AS dropped,
       (SELECT count(*) FROM cleaned WHERE is_anomaly) AS anomalies,
       (SELECT count(*) FROM matched WHERE product_id IS NOT NULL) AS matched,
       (SELECT count(*) FROM matched WHERE match_method = 'accessory_filter') AS accessories,
       (SELECT count(*) FROM matched WHERE product_id IS NULL AND match_method <> 'accessory_filter') AS below"""))
def q_funnel(spark, sf):
    raw = tables.listings(spark, sf).select(F.lit(True).alias("is_raw"))
    m = pipeline.matched_listings(spark, sf).select(F.lit(False).alias("is_raw"), "is_anomaly", "product_id",
                                                    "match_method")
    u = raw.unionByName(m, allowMissingColumns=True)
    c = ~F.col("is_raw")
    return u.agg(F.count_if("is_raw").alias("raw"), F.count_if(c).alias("cleaned"),
                 (F.count_if("is_raw") - F.count_if(c)).alias("dropped"),
                 F.count_if(c & F.col("is_anomaly")).alias("anomalies"),
                 F.count_if(c & F.col("product_id").isNotNull()).alias("matched"),
                 F.count_if(c & (F.col("match_method") == "accessory_filter")).alias("accessories"),
                 F.count_if(c & F.col("product_id").isNull() & (F.col("match_method") != "accessory_filter"))
                  .alias("below"))


@register("category_counts", with_views(CLEANED_CTES + """
SELECT category, count(*) AS n FROM cleaned GROUP BY category"""))
def q_category_counts(spark, sf):
    return pipeline.cleaned_listings(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@register("observations", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT product_category AS category, count(DISTINCT product_id) AS products, count(*) AS observations
FROM matched WHERE product_id IS NOT NULL GROUP BY product_category"""))
def q_observations(spark, sf):
    u = pipeline.unified_prices(spark, sf)
    return u.groupBy("category").agg(F.count(F.lit(1)).alias("products"),
                                     F.sum("offer_count").alias("observations"))


# ============================================================== run reports
from ..operators import quality, reporting, vector  # noqa: E402

RUNS_CTE = f"WITH runs AS ({tables.RUNS_SQL})\n"
DR = "round(CAST({x} AS DECIMAL(38,12)), {p})::DOUBLE"


@register("run_stats", RUNS_CTE + f"""
SELECT scraper_name, count(*) AS runs, count(*) FILTER (WHERE success) AS successes,
       {DR.format(x="(count(*) FILTER (WHERE success))::DOUBLE / count(*)", p=3)} AS success_rate,
       {DR.format(x="avg(products_found)", p=1)} AS avg_products_found,
       {DR.format(x="avg(time_seconds)", p=2)} AS avg_time_seconds,
       {DR.format(x="sum(cost_usd)", p=6)} AS total_cost_usd
FROM runs GROUP BY scraper_name""")
def q_run_stats(spark, sf):
    return reporting.approach_stats(tables.runs(spark, sf))


@register("source_winners", RUNS_CTE + """,
f AS (SELECT source, scraper_name, row_number() OVER (PARTITION BY source ORDER BY time_seconds, scraper_name) AS rn FROM runs),
m AS (SELECT source, scraper_name, row_number() OVER (PARTITION BY source ORDER BY products_found DESC, scraper_name) AS rn FROM runs)
SELECT f.source, f.scraper_name AS fastest_scraper, m.scraper_name AS most_products_scraper,
       (SELECT max(products_found) FROM runs r WHERE r.source = f.source) AS max_products_found
FROM f JOIN m ON f.source = m.source AND m.rn = 1 WHERE f.rn = 1""")
def q_source_winners(spark, sf):
    return reporting.source_winners(tables.runs(spark, sf))


@register("report_winners", RUNS_CTE + """,
s AS (SELECT *, CASE WHEN products_found = 0 THEN 0.0 ELSE round(CAST(cost_usd / products_found AS DECIMAL(38,12)), 6)::DOUBLE END AS cpp FROM runs WHERE success),
f AS (SELECT source, scraper_name, row_number() OVER (PARTITION BY source ORDER BY time_seconds, scraper_name) AS rn FROM s),
m AS (SELECT source, scraper_name, row_number() OVER (PARTITION BY source ORDER BY products_found DESC, scraper_name) AS rn FROM s),
c AS (SELECT source, scraper_name, row_number() OVER (PARTITION BY source ORDER BY cpp, scraper_name) AS rn FROM s WHERE products_found > 0),
src AS (SELECT DISTINCT source FROM runs)
SELECT src.source, coalesce(f.scraper_name, 'all failed') AS fastest_scraper,
       m.scraper_name AS most_products_scraper, c.scraper_name AS cheapest_scraper
FROM src LEFT JOIN f ON f.source = src.source AND f.rn = 1
         LEFT JOIN m ON m.source = src.source AND m.rn = 1
         LEFT JOIN c ON c.source = src.source AND c.rn = 1""")
def q_report_winners(spark, sf):
    return reporting.report_winners(tables.runs(spark, sf))


@register("success_text", RUNS_CTE + """
SELECT scraper_name, CAST(count(*) FILTER (WHERE success) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR)
       || ' (' || CAST(floor(count(*) FILTER (WHERE success) * 100 / count(*)) AS BIGINT)::VARCHAR || '%)' AS success_rate_text
FROM runs GROUP BY scraper_name""")
def q_success_text(spark, sf):
    return reporting.success_text(tables.runs(spark, sf))


@register("run_totals", RUNS_CTE + f"""
SELECT {DR.format(x="sum(cost_usd)", p=6)} AS total_cost_usd, count(*) AS total_runs FROM runs""")
def q_run_totals(spark, sf):
    return reporting.run_totals(tables.runs(spark, sf))


@register("run_rows", RUNS_CTE + """
SELECT scraper_name, source, category, products_found, time_seconds, success, timestamp,
       CASE WHEN products_found = 0 THEN 0.0 ELSE round(CAST(cost_usd / products_found AS DECIMAL(38,12)), 6)::DOUBLE END AS cost_per_product,
       CASE WHEN NOT success THEN 'FAIL ' || CASE WHEN length(error_message) > 40
                 THEN substr(error_message, 1, 40) || '…' ELSE error_message END
            WHEN products_found = 0 THEN 'OK / 0 results' ELSE 'OK' END AS status
FROM runs""")
def q_run_rows(spark, sf):
    d = reporting.with_derived(tables.runs(spark, sf))
    return d.select("scraper_name", "source", "category", "products_found", "time_seconds", "success",
                    "timestamp", "cost_per_product", "status")


# ============================================================== quality
TEST_SET_SQL = f"""
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5('{K.TEST_SET_SEED}:' || product_id), product_id) AS rn
                     FROM catalog) WHERE rn <= {K.TEST_SET_PER_CATEGORY}),
pos AS (SELECT canonical_name AS query, category, CAST(product_id AS VARCHAR) AS expected_product_id, 'clean' AS test_type FROM s
        UNION ALL SELECT canonical_name || '{K.NOISY_EN_SUFFIX}', category, CAST(product_id AS VARCHAR), 'noisy_en' FROM s
        UNION ALL SELECT '{K.NOISY_DE_PREFIX}' || canonical_name || '{K.NOISY_DE_SUFFIX}', category, CAST(product_id AS VARCHAR), 'noisy_de' FROM s),
neg AS (SELECT * FROM (VALUES {", ".join(f"({sql_str(q)}, {sql_str(c)})" for q, c in K.ACCESSORY_NEGATIVES)}) AS t(query, category)),
cases AS (SELECT * FROM pos UNION ALL SELECT query, category, NULL, 'accessory' FROM neg)"""


@register("test_breakdown", with_views(TEST_SET_SQL + """
SELECT test_type, count(*) AS n FROM cases GROUP BY test_type"""))
def q_test_breakdown(spark, sf):
    return quality.test_breakdown(quality.build_test_set(tables.catalog(spark, sf)))


@register("test_set", with_views(TEST_SET_SQL + """
SELECT query, category, expected_product_id, test_type FROM cases"""))
def q_test_set(spark, sf):
    return quality.build_test_set(tables.catalog(spark, sf)).drop("case_id")


def _rule_results(spark, sf):
    cases = quality.build_test_set(tables.catalog(spark, sf))
    m = matching.match_queries(cases, tables.catalog(spark, sf), name_col="query", category_col="category")
    keyed = cases.select("*", *matching.query_key("query", "category"))
    return keyed.join(m, ["qname", "qcat"], "left").select(
        "query", "category", "expected_product_id", "test_type", "product_id",
        F.col("product_id").isNotNull().alias("matched"), "match_score", "match_method")


QUALITY_RULE_SQL = with_views(TEST_SET_SQL + """,
cleaned AS (SELECT query AS product_name_clean, category FROM cases),""" + RULE_CTES.split("matched AS")[0].rstrip().rstrip(",") + """,
r AS (SELECT cases.*, res.product_id, res.product_id IS NOT NULL AS matched FROM cases
      JOIN res ON lower(coalesce(cases.query, '')) = res.qname AND coalesce(cases.category, '') = res.qcat)
SELECT count(*) FILTER (WHERE test_type <> 'accessory' AND matched AND CAST(product_id AS VARCHAR) = expected_product_id) AS tp,
       count(*) FILTER (WHERE (test_type <> 'accessory' AND matched AND CAST(product_id AS VARCHAR) <> expected_product_id)
                           OR (test_type = 'accessory' AND matched)) AS fp,
       count(*) FILTER (WHERE test_type <> 'accessory' AND NOT matched) AS fn,
       count(*) FILTER (WHERE test_type = 'accessory' AND matched) AS fp_accessory,
       count(*) FILTER (WHERE test_type = 'accessory' AND NOT matched) AS tn_accessory
FROM r""")


@register("match_quality", f"""
WITH base AS ({QUALITY_RULE_SQL}),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 1.0 END AS p,
                CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS r FROM base)
SELECT tp, fp, fn, fp_accessory, tn_accessory, tp + fn AS n_positives, fp_accessory + tn_accessory AS n_negatives,
       {DR.format(x="p", p=4)} AS precision, {DR.format(x="r", p=4)} AS recall,
       {DR.format(x="CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END", p=4)} AS f1,
       {DR.format(x="CASE WHEN fp_accessory + tn_accessory > 0 THEN fp_accessory::DOUBLE / (fp_accessory + tn_accessory) ELSE 0.0 END", p=4)} AS fp_rate
FROM m""")
def q_match_quality(spark, sf):
    return quality.quality_metrics(_rule_results(spark, sf))


# ============================================================== vectors
VEC_SQL = """
WITH q AS (SELECT vec_id AS query_id, CAST(label AS VARCHAR) AS category, embedding FROM embeddings WHERE vec_id % 2 = 1),
c AS (SELECT vec_id AS product_id, CAST(label AS VARCHAR) AS category, vec_id AS ord, embedding FROM embeddings WHERE vec_id % 2 = 0),
p AS (SELECT q.query_id, c.product_id, c.ord,
             list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS s
      FROM q JOIN c USING (category)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ord) AS rn FROM p) WHERE rn = 1)
SELECT q.query_id, CASE WHEN b.s >= {t} THEN b.product_id END AS product_id,
       round(coalesce(b.s, 0.0), 6) AS match_score,
       CASE WHEN b.s IS NULL THEN 'no_candidates' WHEN b.s >= {t} THEN 'cosine_similarity' ELSE 'below_threshold' END AS match_method
FROM q LEFT JOIN b USING (query_id)"""

# A lower threshold than the default also exercises the accepting branch on
# random unit vectors; both are registered.
VEC_LOW_THRESHOLD = 0.25


def _vec(spark, sf, plan, threshold):
    m = vector.match_vectors(tables.vector_queries(spark, sf), tables.vector_catalog(spark, sf),
                             threshold=threshold, plan=plan)
    return m.withColumn("match_score", F.round("match_score", 6))


register("match_vector", VEC_SQL.format(t=K.VECTOR_THRESHOLD))(
    lambda spark, sf: _vec(spark, sf, "auto", K.VECTOR_THRESHOLD))
register("match_vector_low", VEC_SQL.format(t=VEC_LOW_THRESHOLD))(
    lambda spark, sf: _vec(spark, sf, "auto", VEC_LOW_THRESHOLD))
register("match_vector_join", VEC_SQL.format(t=VEC_LOW_THRESHOLD))(
    lambda spark, sf: _vec(spark, sf, "join", VEC_LOW_THRESHOLD))


@register("embed_increment", """
WITH c AS (SELECT vec_id AS product_id, CAST(vec_id AS VARCHAR) AS canonical_name, label FROM embeddings),
st AS (SELECT product_id, CASE WHEN label % 2 = 0 THEN canonical_name ELSE 'renamed ' || canonical_name END AS canonical_name
       FROM c WHERE label % 3 <> 0),
inc AS (SELECT * FROM c ANTI JOIN st USING (product_id, canonical_name))
SELECT label, count(*) AS to_embed FROM inc GROUP BY label""")
def q_embed_increment(spark, sf):
    """J9 over all vectors: those of some labels are stored, some of them under another name."""
    c = tables.read(spark, sf, "embeddings").select(F.col("vec_id").alias("product_id"),
                                                   F.col("vec_id").cast("string").alias("canonical_name"), "label")
    name = F.when(F.col("label") % 2 == 0, F.col("canonical_name")).otherwise(F.concat(F.lit("renamed "), "canonical_name"))
    stored = c.where(F.col("label") % 3 != 0).select("product_id", name.alias("canonical_name"))
    return vector.embedding_increment(c, stored).groupBy("label").agg(F.count(F.lit(1)).alias("to_embed"))


# ============================================================== collection side
from ..sources import model as MODEL  # noqa: E402
from ..sources import search as SEARCH  # noqa: E402

FIXED_TS = "TIMESTAMP '2026-04-07 12:00:00'"


def _fixed_ts():
    return F.lit("2026-04-07 12:00:00").cast("timestamp_ntz")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
GERMAN_SQL = ("CAST(floor(value) AS BIGINT)::STRING || ','"
              " || lpad((CAST(floor(value * 100) AS BIGINT) % 100)::STRING, 2, '0')")


def shopping_items(spark, sf):
    """Shopping-result items derived from events (F4 element shape)."""
    e = tables.read(spark, sf, "events")
    k = _k()
    german = F.expr(GERMAN_SQL)
    return e.select(
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(
            F.concat(F.initcap("event_type"), F.lit(" item "), F.col("event_id").cast("string"))).alias("title"),
        F.concat(F.lit("https://shop.example/p/"), F.col("event_id").cast("string")).alias("link"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Shop "), F.col("user_id").cast("string")))
         .alias("source"),
        F.when(k % 2 == 0, F.concat(F.lit("ab "), german, F.lit(" €"))).otherwise(german).alias("price"),
        F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("extracted_price"),
        (k % 4 != 0).alias("in_stock"))


SHOPPING_ITEMS_SQL = f"""
items AS (SELECT CASE WHEN event_type = 'error' THEN '' ELSE upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2))
                      || ' item ' || CAST(event_id AS VARCHAR) END AS title,
                 'https://shop.example/p/' || CAST(event_id AS VARCHAR) AS link,
                 CASE WHEN {K_SQL} % 5 = 0 THEN '' ELSE 'Shop ' || CAST(user_id AS VARCHAR) END AS source,
                 CASE WHEN {K_SQL} % 2 = 0 THEN 'ab ' || {GERMAN_SQL} || ' €' ELSE {GERMAN_SQL} END AS price,
                 CASE WHEN {K_SQL} % 3 = 0 THEN NULL ELSE value END AS extracted_price,
                 {K_SQL} % 4 <> 0 AS in_stock
          FROM events)"""


@register("shopping_rows", f"""WITH {SHOPPING_ITEMS_SQL},
p AS (SELECT *, CASE WHEN extracted_price IS NOT NULL AND extracted_price <> 0 THEN extracted_price
                     WHEN coalesce(price, '') <> '' THEN {dialect_b_sql('price', '0.0', True)} ELSE 0.0 END AS pr
      FROM items)
SELECT trim(title) AS product_name, pr AS price, 'EUR' AS currency,
       CASE WHEN coalesce(in_stock, true) AND pr > 0 THEN 'in_stock' ELSE 'unknown' END AS availability,
       trim(CASE WHEN coalesce(source, '') <> '' THEN source ELSE 'Google Shopping' END) AS seller,
       'google_shopping' AS source, trim(coalesce(link, '')) AS url, {FIXED_TS} AS scrape_timestamp,
       'laptops' AS category
FROM p WHERE trim(coalesce(title, '')) <> ''""")
def q_shopping_rows(spark, sf):
    return SEARCH.shopping_rows(shopping_items(spark, sf), F.lit("laptops"), _fixed_ts())


def organic_items(spark, sf):
    e = tables.read(spark, sf, "events")
    k = _k()
    german = F.expr(GERMAN_SQL)
    return e.select(
        F.concat(F.lit("Item "), F.col("event_id").cast("string"),
                 F.when(k % 2 == 0, F.lit(" | Preisvergleich bei idealo")).otherwise(F.lit(""))).alias("title"),
        F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("https://www.idealo.de/preisvergleich/"),
                                                   F.col("event_id").cast("string")))
         .otherwise(F.concat(F.lit("https://other.example/"), F.col("event_id").cast("string"))).alias("link"),
        F.when(k % 3 == 0, F.concat(F.lit("ab "), german, F.lit(" € bei 12 Shops")))
         .when(k % 3 == 1, F.concat(F.lit("Preis: "), F.floor("value").cast("string"), F.lit(" EUR")))
         .otherwise(F.lit("kein Preis")).alias("snippet"))


@register("organic_rows", f"""WITH items AS (
  SELECT 'Item ' || CAST(event_id AS VARCHAR) || CASE WHEN {K_SQL} % 2 = 0 THEN ' | Preisvergleich bei idealo' ELSE '' END AS title,
         CASE WHEN user_id % 3 = 0 THEN 'https://www.idealo.de/preisvergleich/' || CAST(event_id AS VARCHAR)
              ELSE 'https://other.example/' || CAST(event_id AS VARCHAR) END AS link,
         CASE WHEN {K_SQL} % 3 = 0 THEN 'ab ' || {GERMAN_SQL} || ' € bei 12 Shops'
              WHEN {K_SQL} % 3 = 1 THEN 'Preis: ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' EUR'
              ELSE 'kein Preis' END AS snippet
  FROM events),
p AS (SELECT *, trim(regexp_replace(trim(title), '\\s*\\|.*$', '')) AS name,
             regexp_extract(trim(snippet), '(?:ab\\s*)?([0-9.,]+)\\s*(?:€|EUR)', 1) AS m FROM items),
q AS (SELECT *, CASE WHEN m <> '' THEN {dialect_b_sql('m', '0.0', True)} ELSE 0.0 END AS pr FROM p)
SELECT name AS product_name, pr AS price, 'EUR' AS currency,
       CASE WHEN pr > 0 THEN 'in_stock' ELSE 'unknown' END AS availability,
       'Idealo DE (via Google)' AS seller, 'idealo_de_serpapi' AS source, trim(link) AS url,
       {FIXED_TS} AS scrape_timestamp, 'gpus' AS category
FROM q WHERE trim(title) <> '' AND strpos(lower(trim(link)), 'idealo') > 0 AND name <> ''""")
def q_organic_rows(spark, sf):
    return SEARCH.organic_rows(organic_items(spark, sf), F.lit("gpus"), _fixed_ts())


def model_responses(spark, sf):
    c = tables.read(spark, sf, "conversations")
    letters = F.trim(F.regexp_replace(F.col("text"), "[^A-Za-z ]", ""))
    item = F.concat(F.lit('{"product_name": "'), letters, F.lit('", "price": "'),
                    F.length("text").cast("string"), F.lit(',99 €", "availability": "'),
                    F.when(F.col("turn") % 2 == 0, F.lit("in_stock")).otherwise(F.lit("Auf Lager")),
                    F.lit('", "url": "https://m.example/'), F.col("conv_id").cast("string"), F.lit('"}'))
    tail = F.when(F.col("conv_id") % 5 == 0, F.lit(" and some words")).otherwise(F.lit(""))   # no JSON any more
    resp = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("["), item, F.lit("]"), tail))
             .when(F.col("turn") % 3 == 1, F.concat(F.lit("```json\n["), item, F.lit("]\n```")))
             .otherwise(F.col("text")))
    return c.select(F.concat(F.lit("shop_"), (F.col("conv_id") % 3).cast("string")).alias("source"),
                    resp.alias("response"), F.length("text").alias("input_tokens"),
                    (F.col("turn") * 10).alias("output_tokens"), "conv_id", "turn")


MODEL_RESP_SQL = """
resp AS (SELECT 'shop_' || CAST(conv_id % 3 AS VARCHAR) AS source,
  CASE WHEN turn % 3 = 0 THEN '[' || item || ']' || CASE WHEN conv_id % 5 = 0 THEN ' and some words' ELSE '' END WHEN turn % 3 = 1 THEN '```json' || chr(10) || '[' || item || ']' || chr(10) || '```'
       ELSE text END AS response, length(text) AS input_tokens, turn * 10 AS output_tokens, conv_id, turn
  FROM (SELECT *, '{"product_name": "' || trim(regexp_replace(text, '[^A-Za-z ]', '', 'g'))
              || '", "price": "' || CAST(length(text) AS VARCHAR) || ',99 €", "availability": "'
              || CASE WHEN turn % 2 = 0 THEN 'in_stock' ELSE 'Auf Lager' END
              || '", "url": "https://m.example/' || CAST(conv_id AS VARCHAR) || '"}' AS item
        FROM conversations))"""


@register("model_rows", f"""WITH {MODEL_RESP_SQL},
t AS (SELECT source, regexp_replace(regexp_replace(response, '```(?:json)?|```', '', 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM resp),
j AS (SELECT source, unnest(from_json(t, '[{{"product_name":"VARCHAR","price":"VARCHAR","currency":"VARCHAR","availability":"VARCHAR","url":"VARCHAR"}}]')) AS it
      FROM t WHERE starts_with(t, '[') AND json_valid(t)),
x AS (SELECT source, trim(coalesce(it.product_name, '')) AS name, it.price AS price,
             lower(coalesce(it.availability, 'unknown')) AS a, it.currency AS cur, trim(coalesce(it.url, '')) AS url FROM j)
SELECT name AS product_name, CASE WHEN coalesce(price, '') <> '' THEN {dialect_b_sql('price', '0.0', True)} ELSE 0.0 END AS price,
       CASE WHEN coalesce(cur, '') <> '' THEN cur ELSE 'EUR' END AS currency,
       CASE WHEN a IN ('in_stock', 'out_of_stock', 'unknown') THEN a ELSE 'unknown' END AS availability,
       upper(substr(replace(source, '_', ' '), 1, 1)) || lower(substr(replace(source, '_', ' '), 2)) AS seller,
       source, url, {FIXED_TS} AS scrape_timestamp, 'phones' AS category
FROM x WHERE name <> ''""")
def q_model_rows(spark, sf):
    return MODEL.model_rows(model_responses(spark, sf), F.lit("phones"), _fixed_ts())


@register("token_cost", f"""WITH {MODEL_RESP_SQL}
SELECT conv_id, turn, (input_tokens * 0.59::DOUBLE + output_tokens * 0.79::DOUBLE) / 1000000.0::DOUBLE AS cost_usd FROM resp""")
def q_token_cost(spark, sf):
    r = MODEL.call_cost(model_responses(spark, sf))
    return r.select("conv_id", "turn", "cost_usd")


@register("text_window", """
WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS x FROM conversations),
w AS (SELECT conv_id, turn, x,
        CASE WHEN strpos(x, '€') > 0 THEN strpos(x, '€') WHEN strpos(x, 'EUR') > 0 THEN strpos(x, 'EUR')
             WHEN strpos(x, ' CHF') > 0 THEN strpos(x, ' CHF') WHEN strpos(x, 'Price') > 0 THEN strpos(x, 'Price') END AS pos FROM t)
SELECT conv_id, turn, CASE WHEN pos IS NULL THEN substr(x, 1, 5000)
                           ELSE substr(x, greatest(pos - 1 - 200, 0) + 1, 5000) END AS window FROM w""")
def q_text_window(spark, sf):
    c = tables.read(spark, sf, "conversations")
    return MODEL.window_text(c, "text").select("conv_id", "turn", "window")


@register("page_blocked", """
SELECT length(html) < 10000 AND strpos(html, 'Something has gone wrong') > 0 AS blocked, count(*) AS n
FROM pages GROUP BY ALL""")
def q_page_blocked(spark, sf):
    p = tables.read(spark, sf, "pages")
    return p.groupBy(TX.is_blocked_page("html").alias("blocked")).agg(F.count(F.lit(1)).alias("n"))


@register("search_urls", """
SELECT p_partkey, replace('https://www.amazon.de/s?k={query}&language=de_DE', '{query}',
       replace(url_encode(coalesce(p_brand || ' ' || p_name, p_name, '')), '%20', '+')) AS search_url
FROM part""")
def q_search_urls(spark, sf):
    p = tables.read(spark, sf, "part")
    return p.select("p_partkey", TX.search_url(F.lit("https://www.amazon.de/s?k={query}&language=de_DE"),
                                               F.concat_ws(" ", "p_brand", "p_name"), F.col("p_name"))
                    .alias("search_url"))


@register("accessory_flag", with_views(f"""
x AS (SELECT DISTINCT lower(coalesce(product_name, '')) AS name FROM listings_raw)
SELECT name, {acc_sql('name')} AS is_accessory FROM x"""))
def q_accessory_flag(spark, sf):
    l = tables.listings(spark, sf).select(F.lower(F.coalesce("product_name", F.lit(""))).alias("name")).distinct()
    return l.select("name", TX.is_accessory(F.col("name")).alias("is_accessory"))


@register("token_signature", with_views("""
x AS (SELECT DISTINCT product_name FROM listings_raw)
SELECT product_name, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(coalesce(product_name, '')), '([a-z0-9]+)', 1))), ' ') AS signature
FROM x"""))
def q_token_signature(spark, sf):
    l = tables.listings(spark, sf).select("product_name").distinct()
    return l.select("product_name", F.array_join(F.array_sort(TX.token_signature("product_name")), " ")
                    .alias("signature"))


FUZZY_NORM_SQL = "lower(trim(regexp_replace(coalesce({x}, ''), '[^\\p{{L}}\\p{{N}}]', ' ', 'g')))"


@register("fuzzy_normalise", with_views(f"""
x AS (SELECT DISTINCT product_name FROM listings_raw)
SELECT product_name, {FUZZY_NORM_SQL.format(x='product_name')} AS processed FROM x"""))
def q_fuzzy_normalise(spark, sf):
    l = tables.listings(spark, sf).select("product_name").distinct()
    return l.select("product_name", TX.fuzzy_normalize("product_name").alias("processed"))


@register("fuzzy_normalise_documents", f"""
SELECT doc_id, {FUZZY_NORM_SQL.format(x='text')} AS processed FROM documents""")
def q_fuzzy_normalise_documents(spark, sf):
    d = tables.read(spark, sf, "documents")
    return d.select("doc_id", TX.fuzzy_normalize("text").alias("processed"))


def noise_strip_sql(name: str, cat: str) -> str:
    s1 = f"regexp_replace(coalesce({name}, ''), {sql_str(re2(K.SPEC_NOISE_PATTERN))}, ' ', 'g')"
    s2 = (f"CASE WHEN {cat} IN ('laptop', 'phone') THEN "
          f"regexp_replace({s1}, {sql_str(re2(K.COMPONENT_NOISE_PATTERN))}, ' ', 'g') ELSE {s1} END")
    s3 = f"trim(regexp_replace({s2}, '\\s{{2,}}', ' ', 'g'))"
    toks = f"list_filter(regexp_split_to_array({s3}, '\\s+'), lambda t: t <> '')"
    dedup = (f"array_to_string(list_filter({toks}, lambda t, i: "
             f"list_position(list_transform({toks}, lambda u: lower(u)), lower(t)) = i), ' ')")
    return f"coalesce(nullif({dedup}, ''), coalesce({name}, ''))"


@register("noise_strip", with_views(f"""
x AS (SELECT DISTINCT product_name, {tables.category_case_sql('category', tables.LISTING_CATEGORY_MAP)} AS category
      FROM listings_raw),
y AS (SELECT product_name, CASE WHEN category = 'standard' THEN 'laptop' WHEN category = 'small' THEN 'phone'
                                ELSE category END AS category FROM x)
SELECT product_name, category, {noise_strip_sql('product_name', 'category')} AS encoder_text FROM y"""))
def q_noise_strip(spark, sf):
    l = tables.listings(spark, sf)
    x = l.select("product_name", C.normalize_category("category", tables.LISTING_CATEGORY_MAP).alias("category"))\
         .distinct()
    # two part types stand in for the categories that get the component-noise pass
    y = x.select("product_name", F.when(F.col("category") == "standard", F.lit("laptop"))
                 .when(F.col("category") == "small", F.lit("phone")).otherwise(F.col("category")).alias("category"))
    return y.select("product_name", "category", TX.encoder_text(F.col("product_name"), F.col("category"))
                    .alias("encoder_text"))


@register("offer_defaults", with_views(CLEANED_CTES + """
SELECT CASE WHEN source <> '' THEN source END AS source, price_clean AS price,
       coalesce(nullif(currency, ''), 'EUR') AS currency,
       coalesce(nullif(availability_clean, ''), 'unknown') AS availability,
       seller, url, strftime(scrape_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS scrape_timestamp,
       coalesce(is_anomaly, false) AS is_anomaly,
       CASE WHEN price_clean IS NOT NULL AND price_clean <> 0 THEN 'in_stock' ELSE 'out_of_stock' END AS availability_from_price,
       strpos(lower(coalesce(seller, '')), 'supplier#00000001') > 0 OR strpos(lower(coalesce(url, '')), 'supplier#00000001') > 0 AS covered
FROM cleaned"""))
def q_offer_defaults(spark, sf):
    c = pipeline.cleaned_listings(spark, sf)
    o = c.select(merging.offer_struct().alias("o"),
                 TX.availability_from_price(F.col("price_clean")).alias("availability_from_price"),
                 TX.coverage_filter(F.col("seller"), F.col("url"), "Supplier#00000001").alias("covered"))
    return TX.sanitize_frame(o.select("o.*", "availability_from_price", "covered"))


@register("null_sanitise", """
WITH x AS (SELECT CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE WHEN l_tax = 0 THEN 'nan'::DOUBLE
                       ELSE l_extendedprice END AS v, l_shipdate AS ts FROM lineitem)
SELECT CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS v,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM x""")
def q_null_sanitise(spark, sf):
    l = tables.read(spark, sf, "lineitem")
    x = l.select(F.when(F.col("l_discount") == 0, F.lit(float("inf")))
                  .when(F.col("l_tax") == 0, F.lit(float("nan")))
                  .otherwise(F.col("l_extendedprice")).alias("v"), F.col("l_shipdate").alias("ts"))
    return TX.sanitize_frame(x)


@register("category_fallback", with_views(f"""
x AS (SELECT {tables.category_case_sql('category', tables.LISTING_CATEGORY_MAP)} AS category FROM listings_raw)
SELECT category, count(*) AS n FROM x GROUP BY category"""))
def q_category_fallback(spark, sf):
    l = tables.listings(spark, sf).withColumnRenamed("category", "_category")
    f = C.category_fallback(l)
    return (f.select(C.normalize_category("category", tables.LISTING_CATEGORY_MAP).alias("category"))
             .groupBy("category").agg(F.count(F.lit(1)).alias("n")))


@register("display_names", """
SELECT DISTINCT n_name, upper(substr(replace(lower(n_name), '_', ' '), 1, 1))
       || substr(replace(lower(n_name), '_', ' '), 2) AS display_name FROM nation""")
def q_display_names(spark, sf):
    n = tables.read(spark, sf, "nation")
    return n.select("n_name", TX.display_name(F.col("n_name")).alias("display_name")).distinct()


# ============================================================== fuzzy / W4 / A11
from ..operators import fuzzy as FZ  # noqa: E402
from ..operators import partitions as PARTS  # noqa: E402
from ..sources import raw as RAW  # noqa: E402


@register("match_fuzzy")
def q_match_fuzzy(spark, sf):
    c = pipeline.cleaned_listings(spark, sf)
    return FZ.match_queries(c, tables.catalog(spark, sf))


@register("catalog_first", f"""
WITH c AS (SELECT *, {FUZZY_NORM_SQL.format(x='canonical_name')} AS choice FROM ({tables.CATALOG_SQL}))
SELECT category, choice, product_id, canonical_name FROM (
  SELECT *, row_number() OVER (PARTITION BY category, choice ORDER BY ord) AS rn FROM c) WHERE rn = 1""")
def q_catalog_first(spark, sf):
    ch = FZ.choices(tables.catalog(spark, sf)).where(F.col("key") != matching.POOL_KEY)
    return ch.select(F.col("key").alias("category"), "choice", "product_id", "canonical_name")


def _fuzzy_cases(spark, sf):
    cases = quality.build_test_set(tables.catalog(spark, sf))
    m = FZ.match_queries(cases, tables.catalog(spark, sf), threshold=0.0, name_col="query")
    keyed = cases.select("*", TX.fuzzy_normalize(F.col("query")).alias("qproc"),
                         F.coalesce(F.col("category"), F.lit("")).alias("qcat"))
    return keyed.join(m, ["qproc", "qcat"], "left")


@register("threshold_sweep")
def q_threshold_sweep(spark, sf):
    """Fuzzy scores computed once (threshold 0): the labelled positives against
    products asked for in a category that doesn't sell them and names that miss a product by a word,
    thresholds 60..95."""
    catalog = tables.catalog(spark, sf)
    pos = quality.build_test_set(catalog).where("test_type <> 'accessory'").select("query", "category", F.lit(True).alias("is_positive"))
    neg = quality.wrong_category_cases(catalog).unionByName(quality.near_miss_cases(catalog))
    cases = pos.unionByName(neg.withColumn("is_positive", F.lit(False)))
    m = FZ.match_queries(cases, catalog, threshold=0.0, name_col="query")
    keyed = cases.select("is_positive", TX.fuzzy_normalize(F.col("query")).alias("qproc"),
                         F.coalesce(F.col("category"), F.lit("")).alias("qcat"))
    return quality.threshold_sweep(keyed.join(m, ["qproc", "qcat"], "left").select("is_positive", "raw_score"))


@register("match_quality_fuzzy")
def q_match_quality_fuzzy(spark, sf):
    r = _fuzzy_cases(spark, sf)
    res = r.select("test_type", "expected_product_id", "product_id",
                   (F.col("raw_score") >= K.FUZZY_THRESHOLD).alias("matched"))
    return quality.quality_metrics(res.withColumn(
        "product_id", F.when(F.col("matched"), F.col("product_id"))))


@register("match_quality_vector")
def q_match_quality_vector(spark, sf):
    """A10 for the vector matcher over the labelled test set."""
    catalog = tables.catalog(spark, sf)
    cases = quality.build_test_set(catalog)
    m = vector.match_listings(cases, catalog, name_col="query")
    return quality.quality_metrics(m.withColumn("matched", F.col("product_id").isNotNull()))


@register("unified_prices_fuzzy")
def q_unified_prices_fuzzy(spark, sf):
    """The full pipeline with the fuzzy matcher."""
    return pipeline.unified_prices(spark, sf, "fuzzy")


@register("unified_prices_vector")
def q_unified_prices_vector(spark, sf):
    """The full pipeline with the vector matcher (encoder and threshold learned from the catalog)."""
    return pipeline.unified_prices(spark, sf, "vector")


@register("match_vector_outcomes", with_views(CLEANED_CTES + """,
q AS (SELECT DISTINCT coalesce(product_name_clean, '') AS name, coalesce(category, '') AS category FROM cleaned),
a AS (SELECT *, """ + acc_sql("lower(name)") + """ AS acc, category <> '' AND category NOT IN (SELECT category FROM catalog) AS unknown FROM q)
SELECT CASE WHEN acc THEN 'accessory_filter' WHEN unknown THEN 'no_candidates' ELSE 'scored' END AS outcome, count(*) AS n
FROM a GROUP BY ALL"""))
def q_match_vector_outcomes(spark, sf):
    """J4's outcomes per different listing: filtered, without candidates, or scored (pooled without a category)."""
    c = pipeline.cleaned_listings(spark, sf).select(F.coalesce("product_name_clean", F.lit("")).alias("product_name_clean"),
                                                    F.coalesce("category", F.lit("")).alias("category")).distinct()
    m = vector.match_listings(written(c, "names"), tables.catalog(spark, sf))
    outcome = F.when(F.col("match_method").isin("accessory_filter", "no_candidates"), F.col("match_method")).otherwise(F.lit("scored"))
    return m.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@register("latest_partition", """
WITH e AS (SELECT 'source_' || CAST(user_id % 4 AS VARCHAR) AS source, event_type AS category,
                  CAST(ts AS DATE) AS run_date FROM events),
m AS (SELECT source, category, max(run_date) AS run_date FROM e GROUP BY ALL)
SELECT source, category, run_date, count(*) AS n FROM e JOIN m USING (source, category, run_date) GROUP BY ALL""")
def q_latest_partition(spark, sf):
    e = tables.read(spark, sf, "events").select(
        F.concat(F.lit("source_"), (F.col("user_id") % 4).cast("string")).alias("source"),
        F.col("event_type").alias("category"), F.to_date("ts").alias("run_date"))
    return (PARTS.latest_partition(e, ["source", "category"], "run_date")
            .groupBy("source", "category", "run_date").agg(F.count(F.lit(1)).alias("n")))


UPSERT_BASE_SQL = f"""
b AS (SELECT CASE WHEN l_orderkey % {tables.BLANK_URL_MOD} = 0 THEN ''
                  ELSE '{tables.URL_PREFIX}' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS url,
             l_extendedprice AS price, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS seller,
             l_orderkey * 8 + l_linenumber AS p, l_shipdate >= TIMESTAMP '1998-01-01' AS is_new FROM lineitem)"""


def _upsert_frames(spark, sf):
    l = tables.read(spark, sf, "lineitem")
    url = F.when(F.col("l_orderkey") % tables.BLANK_URL_MOD == 0, F.lit("")).otherwise(
        F.concat(F.lit(tables.URL_PREFIX), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")))
    b = l.select(url.alias("url"), F.col("l_extendedprice").alias("price"),
                 F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("seller"),
                 (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_pos"),
                 (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("is_new"))
    return b.where(~F.col("is_new")).drop("is_new"), b.where(F.col("is_new")).drop("is_new")


@register("url_upsert", f"""
WITH {UPSERT_BASE_SQL},
u AS (SELECT url, price, seller, p, CASE WHEN is_new THEN 1 ELSE 0 END AS seq, trim(coalesce(url, '')) AS k FROM b),
le AS (SELECT k, max(p) FILTER (WHERE seq = 0) AS last_e FROM u WHERE k <> '' GROUP BY k),
ku AS (SELECT u.*, le.last_e FROM u JOIN le USING (k)),
slot AS (SELECT * FROM ku WHERE seq = 1 OR p = last_e),
win AS (SELECT k, url, price, seller FROM (SELECT *, row_number() OVER (PARTITION BY k
          ORDER BY seq DESC, p DESC, url DESC NULLS LAST, price DESC NULLS LAST, seller DESC NULLS LAST) AS rn FROM slot) WHERE rn = 1),
pos AS (SELECT k, arg_min(seq, seq * 10000000000 + p) AS s, arg_min(p, seq * 10000000000 + p) AS pp FROM slot GROUP BY k)
SELECT url, price, seller, s AS _seq, pp AS _pos FROM win JOIN pos USING (k)
UNION ALL SELECT url, price, seller, seq, p FROM ku WHERE NOT (seq = 1 OR p = last_e)
UNION ALL SELECT url, price, seller, seq, p FROM u WHERE k = ''""")
def q_url_upsert(spark, sf):
    existing, incoming = _upsert_frames(spark, sf)
    return RAW.upsert(existing, incoming).select("url", "price", "seller", "_seq", "_pos")


ORDERS_REC_SQL = """
rec AS (SELECT o_orderkey AS row_id, o_orderkey AS pos,
               'Order ' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN ' (fulfilled)' ELSE '' END AS product_name,
               CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 3 = 1 THEN '' ELSE 'EUR' END AS currency,
               o_totalprice AS price, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders),
grp AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS group_id, row_id FROM rec JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT 'p' || o_orderpriority || '-' || CAST(year(o_orderdate) AS VARCHAR), row_id FROM rec WHERE o_orderstatus = 'P')"""


def _orders_records(spark, sf):
    o = tables.read(spark, sf, "orders")
    cur = (F.when(F.col("o_custkey") % 3 == 0, F.lit(None).cast("string"))
            .when(F.col("o_custkey") % 3 == 1, F.lit("")).otherwise(F.lit("EUR")))
    rec = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_orderkey").alias("pos"),
                   F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"),
                            F.when(F.col("o_orderstatus") == "F", F.lit(" (fulfilled)")).otherwise(F.lit("")))
                    .alias("product_name"),
                   cur.alias("currency"), F.col("o_totalprice").alias("price"),
                   F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("seller"),
                   F.col("o_orderpriority").alias("source"), F.lit(None).cast("string").alias("url"),
                   F.col("o_orderstatus").alias("availability"), F.col("o_orderdate").alias("scrape_timestamp"),
                   "o_custkey", "o_orderdate")
    cust = tables.read(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    g1 = rec.join(cust, rec.o_custkey == cust.c_custkey, "left_semi").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("group_id"), "row_id")
    g2 = rec.where(F.col("availability") == "P").select(
        F.concat(F.lit("p"), F.col("source"), F.lit("-"), F.year("o_orderdate").cast("string")).alias("group_id"),
        "row_id")
    return rec.drop("o_custkey", "o_orderdate"), g1.unionByName(g2)


@register("merged_groups", f"""
WITH {ORDERS_REC_SQL},
g AS (SELECT group_id, rec.* FROM grp JOIN rec USING (row_id)),
s AS (SELECT 'single-' || CAST(row_id AS VARCHAR) AS group_id, * FROM rec WHERE row_id NOT IN (SELECT row_id FROM grp)),
a AS (SELECT *, 'x' AS kind FROM g UNION ALL SELECT *, 'none' FROM s)
SELECT group_id,
       arg_max(product_name, length(product_name) * 100000000 - pos) AS product_name,
       coalesce(arg_min(currency, pos) FILTER (WHERE coalesce(currency, '') <> ''), 'EUR') AS currency,
       min(price) AS price_min, max(price) AS price_max,
       {MEAN2.format(x="price", w="true")} AS price_mean,
       count(*) AS offer_count,
       CASE WHEN min(kind) = 'none' THEN 'none' ELSE 'orders' END AS matched_by
FROM a GROUP BY group_id""")
def q_merged_groups(spark, sf):
    rec, groups = _orders_records(spark, sf)
    m = merging.merge_groups(rec, groups, matched_by="orders", with_offers=False)
    return m.select("group_id", "product_name", "currency", "price_min", "price_max", "price_mean",
                    "offer_count", "matched_by")


# ============================================================== pages
from ..sources import pages as PAGES  # noqa: E402


@register("page_listings")
def q_page_listings(spark, sf):
    """P14 over the saved pages (article layout profile), P15 applied first."""
    p = tables.read(spark, sf, "pages")
    return PAGES.page_listings(p, "article", F.lit("pages"), "pages", _fixed_ts())


def layout_pages(spark, sf):
    """Result pages in the three shop layouts, one per order with a listing per line (at most seven)."""
    l = tables.read(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    amount = F.concat(F.floor(cents / 100).cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    parts = F.concat(F.lit("<span class='a-price-whole'>"), F.floor(cents / 100).cast("string"), F.lit(",</span><span class='a-price-fraction'>"),
                     F.lpad((cents % 100).cast("string"), 2, "0"), F.lit("</span>"))
    k, n = F.col("l_linenumber") % 3, F.concat(F.col("l_orderkey").cast("string"), F.lit("x"), F.col("l_linenumber").cast("string"))
    name = F.concat(F.lit("Item "), F.col("l_partkey").cast("string"), F.lit(" &amp; Co"))
    own = F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string"))
    has_own = F.col("l_suppkey") % 2 == 0
    text = lambda *x: F.concat(*[c if not isinstance(c, str) else F.lit(c) for c in x])
    amazon = text(
        '<div data-component-type="s-search-result"', F.when(F.col("l_linenumber") % 2 == 0, text(' data-asin="', n, '"')).otherwise(F.lit("")),
        "><h2><span> ", name, "</span></h2><p>offer",
        F.when(k == 0, text('<span class="a-price"><span class="a-offscreen">', amount, " €</span></span>"))
         .when(k == 1, text('<span class="a-price"><span class="a-offscreen">Preis folgt</span></span>', parts)).otherwise(F.lit("")),
        '<a href="/sspa/dp/0">ad</a><a href="/gp/dp/', n, '">to it</a>',
        F.when(has_own, text('<span class="s-size-mini s-color-base">', own, "</span>")).otherwise(F.lit("")), "</div>")
    ebay = text(
        '<li class="s-card x"><div class="s-card__title"><span class="su-styled-text">', name, "</span></div>",
        F.when(k == 0, text('<div class="s-card__attribute-row">EUR ', amount, "</div>"))
         .when(k == 1, text('<div class="s-card__attribute-row">', amount, "</div>")).otherwise(F.lit("")),
        '<a href="https://www.ebay.de/itm/', n, '">x</a>',
        F.when(has_own, text('<div class="su-card-container__attributes__secondary"><span class="su-styled-text">', own, "</span></div>")).otherwise(F.lit("")))
    idealo = text(
        '<div class="sr-resultItem y"><a class="product-name-z" href="/p/', n, '">', name, "</a>",
        F.when(k == 0, text('<span class="price-amount">ab ', amount, " €</span>"))
         .when(k == 1, text('<em class="my-price">', amount, " €</em>")).otherwise(F.lit("")),
        F.when(has_own, text('<i class="the-shop">', own, "</i>")).otherwise(F.lit("")), "</div>")
    layout = F.col("l_orderkey") % 3
    item = F.when(layout == 0, amazon).when(layout == 1, ebay).otherwise(idealo)
    pages = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", item.alias("h")))).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["h"]), "\n")
    html = text("<html><body>", F.when(layout == 1, text("<ul>", body, "</ul>"))
                .when(layout == 2, text('<div class="sr-resultList">', body, "</div>")).otherwise(body), "</body></html>")
    return pages.select(F.col("l_orderkey").alias("page_id"), text("https://page/", F.col("l_orderkey").cast("string")).alias("url"),
                        html.alias("html"), layout.alias("layout"))


@register("page_layouts", """
WITH x AS (
  SELECT l_orderkey AS page_id, l_orderkey % 3 AS layout, l_linenumber % 3 AS k, l_linenumber AS line, l_suppkey,
         CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS amount,
         CAST(l_orderkey AS VARCHAR) || 'x' || CAST(l_linenumber AS VARCHAR) AS n,
         'Item ' || CAST(l_partkey AS VARCHAR) || ' & Co' AS product_name,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS position
  FROM lineitem),
p AS (SELECT *, CASE WHEN k = 0 OR k = 1 AND layout <> 1 THEN amount ELSE 0.0 END AS price FROM x)
SELECT page_id, CAST(position AS INTEGER) AS position, product_name, CAST(price AS DOUBLE) AS price,
       CASE WHEN price > 0 THEN 'in_stock' WHEN layout = 2 THEN 'unknown' ELSE 'out_of_stock' END AS availability,
       CASE WHEN l_suppkey % 2 = 0 THEN 'Supplier ' || CAST(l_suppkey AS VARCHAR)
            WHEN layout = 0 THEN 'Amazon DE' WHEN layout = 1 THEN 'eBay DE' ELSE 'Idealo DE' END AS seller,
       CASE WHEN layout = 0 AND line % 2 = 0 THEN 'https://www.amazon.de/dp/' || n WHEN layout = 0 THEN 'https://www.amazon.de/gp/dp/' || n
            WHEN layout = 1 THEN 'https://www.ebay.de/itm/' || n ELSE 'https://www.idealo.de/p/' || n END AS url
FROM p""")
def q_page_layouts(spark, sf):
    """P14a-c: the three shop layouts, with missing and unreadable prices, missing sellers and open tags."""
    pages = layout_pages(spark, sf)
    found = [PAGES.page_listings(pages.where(F.col("layout") == i), profile, F.lit("x"), profile, _fixed_ts())
             for i, profile in enumerate(("amazon_de", "ebay_de", "idealo_de"))]
    rows = found[0].unionByName(found[1]).unionByName(found[2])
    return rows.select("page_id", "position", "product_name", "price", "availability", "seller", "url")


# ============================================================== files
from ..session import new_folder, written  # noqa: E402
from ..sources import sinks as SINKS  # noqa: E402


@register("publish_round_trip", with_views("""
SELECT lower(left(source, 1)) AS source_key, coalesce(lower(category), 'none') AS category_key,
       CAST(year(scrape_timestamp) AS INTEGER) AS year, count(*) AS n, count(url) FILTER (WHERE url <> '') AS with_url,
       min(price) AS price_min, max(price) AS price_max, count(currency) AS with_currency
FROM listings_raw GROUP BY ALL"""))
def q_publish_round_trip(spark, sf):
    """All listings written to the partitioned target and read back from the files.

    Partitions are by the source's first letter, category and year; the rows are
    dealt by them first, so each partition is a file or a few, and get the partition
    columns after that. Files are packed: as plain JSON they are many times their tables."""
    l = tables.listings(spark, sf)
    target = new_folder(spark, "published")
    parts = {"_source": F.lower(F.substring("source", 1, 1)), "_category": F.coalesce(F.lower("category"), F.lit("none")),
             "_run_date": F.concat(F.date_format("scrape_timestamp", "yyyy"), F.lit("-01-01"))}
    RAW.publish(l.repartition(*parts.values()).withColumns({**parts, "_file": F.lit("f")}), target, compression="gzip")
    back = spark.read.schema("product_name string, price double, currency string, url string, source_key string, "
                             "category_key string, year int, month int, day int").json(target)
    return back.groupBy("source_key", "category_key", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("url") != "").alias("with_url"),
        F.min("price").alias("price_min"), F.max("price").alias("price_max"), F.count("currency").alias("with_currency"))


@register("sink_round_trip", with_views(CLEANED_CTES + "," + RULE_CTES + """
SELECT product_id, count(*) AS offers, count(*) AS offer_count, min(canonical_name) AS canonical_name,
       min(product_category) AS category_key, min(price_clean) AS least_offer
FROM matched WHERE product_id IS NOT NULL GROUP BY product_id"""))
def q_sink_round_trip(spark, sf):
    """Nested unified records written by category and day, and read back with their offers."""
    m = written(matching.matched_only(pipeline.matched_listings(spark, sf)).select(*merging.TAKEN), "matched")
    root = new_folder(spark, "unified")
    SINKS.write_unified(merging.unified_records(m), root, compression="gzip")
    back = spark.read.schema("product_id long, canonical_name string, offer_count long, prices array<struct<price:double>>, "
                             "category_key string").json(root + "/unified")
    SINKS.write_flat(back.select("product_id", "canonical_name", "offer_count", "category_key", F.size("prices").alias("offers"),
                                 F.array_min(F.transform("prices", lambda o: o["price"])).alias("least_offer")), root, "flat", compression="gzip")
    flat = spark.read.schema("product_id long, canonical_name string, offer_count long, category_key string, offers long, "
                             "least_offer double").json(root + "/processed/flat")
    return flat.select("product_id", "offers", "offer_count", "canonical_name", "category_key", "least_offer")


# ============================================================== entity grouping
from ..operators import entity as ENTITY  # noqa: E402
from ..session import cut_lineage  # noqa: E402


@register("entity_groups")
def q_entity_groups(spark, sf):
    """J7 + A3 over the cleaned listings: rule stage, fuzzy partner stage
    (>= 88), connected components, then one merged record per group."""
    c = pipeline.cleaned_listings(spark, sf)
    rec = written(c.withColumn("row_id", F.monotonically_increasing_id())
                   .withColumn("pos", F.col("row_id"))
                   .withColumn("price", F.col("price_clean")), "records")
    groups = written(ENTITY.grouped_records(rec), "groups")
    m = merging.merge_groups(rec, groups, matched_by="catalog_build", with_offers=False)
    return m.select("group_id", "product_name", "currency", "price_min", "price_max", "price_mean",
                    "offer_count", "matched_by")


# ============================================================== whole texts
@register("match_documents", f"""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS q FROM documents),
qa AS (SELECT doc_id, {acc_sql('q')} AS acc, list_distinct(regexp_extract_all(q, '([a-z0-9]+)', 1)) AS qt FROM d),
cs AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '([a-z0-9]+)', 1)) AS sig FROM benchmark),
pairs AS (SELECT qa.doc_id, cs.item_id,
                 len(list_filter(cs.sig, lambda x: list_contains(qa.qt, x)))::DOUBLE / len(cs.sig) AS score
          FROM qa CROSS JOIN cs WHERE NOT qa.acc AND len(cs.sig) > 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS rn
                        FROM pairs WHERE score > 0) WHERE rn = 1)
SELECT qa.doc_id,
       CASE WHEN NOT qa.acc AND best.score >= {K.RULE_THRESHOLD} THEN best.item_id END AS product_id,
       round(CASE WHEN qa.acc THEN 0.0 ELSE coalesce(best.score, 0.0) END, 9) AS match_score,
       CASE WHEN qa.acc THEN 'accessory_filter' WHEN best.score >= {K.RULE_THRESHOLD} THEN 'token_overlap'
            ELSE 'below_threshold' END AS match_method
FROM qa LEFT JOIN best USING (doc_id)""")
def q_match_documents(spark, sf):
    """J2 over whole documents against the benchmark passages as catalog."""
    docs = tables.read(spark, sf, "documents").select("doc_id", "text", F.lit(None).cast("string").alias("category"))
    cat = tables.read(spark, sf, "benchmark").select(
        F.col("item_id").alias("product_id"), F.col("text").alias("canonical_name"),
        F.lit("benchmark").alias("category"), F.col("item_id").alias("ord"))
    m = matching.match_rule(docs, cat, name_col="text", category_col="category")
    return m.select("doc_id", "product_id", F.round("match_score", 9).alias("match_score"), "match_method")


@register("clean_name_documents", f"""
SELECT doc_id, nullif({tables.clean_name_sql('text', nfc=True)}, '') AS text_clean FROM documents""")
def q_clean_name_documents(spark, sf):
    """P2 + P28 over whole documents.  DuckDB has no NFKC; its NFC stands in
    for it in the oracle, which is exact for texts without compatibility
    characters (the driver documents are such texts)."""
    d = tables.read(spark, sf, "documents")
    return d.select("doc_id", C.blank_to_null(C.clean_name("text")).alias("text_clean"))


@register("match_attached_join", ORACLE["match_attached"])
def q_match_attached_join(spark, sf):
    """J6 through the join plan (distinct queries, inverted-index join, join back)."""
    c = pipeline.cleaned_listings(spark, sf)
    m = matching.matched_only(matching.match_rule(c, tables.catalog(spark, sf), plan="join"))
    return m.select("product_name_clean", "source", "price_clean", "url", "product_id", "match_score")


@register("unified_offers", with_views(CLEANED_CTES + "," + RULE_CTES + """,
o AS (SELECT product_id, nullif(source, '') AS source, price_clean AS price, coalesce(nullif(currency, ''), 'EUR') AS currency,
             coalesce(nullif(availability_clean, ''), 'unknown') AS availability, seller, url, scrape_timestamp,
             coalesce(is_anomaly, false) AS is_anomaly
      FROM matched WHERE product_id IS NOT NULL)
SELECT product_id, row_number() OVER (PARTITION BY product_id ORDER BY scrape_timestamp DESC NULLS LAST, source NULLS LAST, url NULLS LAST,
         seller NULLS LAST, price NULLS LAST, currency NULLS LAST, availability NULLS LAST, is_anomaly NULLS LAST) AS position,
       source, price, currency, availability, seller, url,
       strftime(scrape_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS scrape_timestamp, is_anomaly
FROM o"""))
def q_unified_offers(spark, sf):
    """A2 offers: one row per offer of each matched product, with its position."""
    m = written(matching.matched_only(pipeline.matched_listings(spark, sf)).select(*merging.TAKEN), "matched")
    return TX.sanitize_frame(merging.product_offers(m))


@register("source_preview", with_views(CLEANED_CTES + """
SELECT source, product_name_clean, url, scrape_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY scrape_timestamp DESC NULLS LAST, url ASC NULLS LAST) AS rn
  FROM cleaned) WHERE rn <= 3"""))
def q_source_preview(spark, sf):
    """Head-3 preview per source of the cleaned listings."""
    c = pipeline.cleaned_listings(spark, sf)
    return reporting.preview_per_source(c, 3).select("source", "product_name_clean", "url", "scrape_timestamp")


# ============================================================== embedding store
from ..operators import embedding_store as STORE  # noqa: E402


@register("embedding_store", """
WITH c AS (SELECT p_partkey AS product_id, concat_ws(' ', p_brand, p_name) AS text FROM part),
s1 AS (SELECT product_id, text, 'one' AS encoder, 1 AS version FROM c WHERE product_id % 13 <> 0),
w2 AS (SELECT product_id, CASE WHEN product_id % 7 = 0 THEN text || ' v2' ELSE text END AS text FROM c WHERE product_id % 11 <> 0),
s2 AS (SELECT w.product_id, w.text, 'one' AS encoder, CASE WHEN s.text = w.text THEN 1 ELSE 2 END AS version FROM w2 w LEFT JOIN s1 s USING (product_id)),
w3 AS (SELECT * FROM w2 UNION ALL SELECT * FROM c WHERE product_id % 22 = 0),
s3 AS (SELECT w.product_id, w.text, 'one' AS encoder, coalesce(s.version, 3) AS version FROM w3 w LEFT JOIN s2 s USING (product_id)),
s4 AS (SELECT product_id, text, 'two' AS encoder, 4 AS version FROM w3),
a AS (SELECT 1 AS as_of, * FROM s1 UNION ALL SELECT 2, * FROM s2 UNION ALL SELECT 3, * FROM s3 UNION ALL SELECT 4, * FROM s4)
SELECT as_of, product_id, md5(text) AS fingerprint, encoder, CAST(version AS INTEGER) AS version, CAST(length(text) AS INTEGER) AS said FROM a""")
def q_embedding_store(spark, sf):
    """The catalog as of four versions of its store: first load, new names and removals, products that come
    back, another encoder. The stored vector holds the text's length, which shows what was encoded when."""
    c = tables.catalog(spark, sf).select("product_id", F.col("canonical_name").alias("text"))
    n, text = F.col("product_id"), F.col("text")
    second = c.where(n % 11 != 0).withColumn("text", F.when(n % 7 == 0, F.concat(text, F.lit(" v2"))).otherwise(text))
    third = second.unionByName(c.where(n % 22 == 0))
    path = new_folder(spark, "embeddings")
    encode = lambda df: df.withColumn("embedding", F.array(F.length("text").cast("float")))
    for state, encoder in ((c.where(n % 13 != 0), "one"), (second, "one"), (third, "one"), (third, "two")):
        STORE.sync(path, state, encode, encoder)
    states = [STORE.read(spark, path, v).select(F.lit(v).alias("as_of"), "product_id", "fingerprint", "encoder", "version",
                                                F.col("embedding")[0].cast("int").alias("said")) for v in (1, 2, 3, 4)]
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out


# ============================================================== stored medians
from ..operators import median_store as MEDIANS  # noqa: E402


@register("stored_medians", with_views(CLEANED_CTES + """,
y AS (SELECT DISTINCT year(scrape_timestamp) AS upto FROM norm WHERE scrape_timestamp IS NOT NULL),
last AS (SELECT min(upto) AS upto FROM y UNION SELECT max(upto) FROM y)
SELECT CAST(upto AS INTEGER) AS upto, category, round(median(price_clean), 6) AS category_median
FROM norm JOIN last ON year(scrape_timestamp) <= upto WHERE price_clean IS NOT NULL GROUP BY upto, category"""))
def q_stored_medians(spark, sf):
    """A1's medians from a store that the listings' years are added to one by one: after the first and after the last."""
    n = cleaning.normalize_keys(tables.listings(spark, sf), tables.LISTING_CATEGORY_MAP)
    n = cut_lineage(n.select("category", "price_clean", F.year("scrape_timestamp").alias("y")).where("y is not null"))
    years = [r["y"] for r in n.select("y").distinct().orderBy("y").collect()]
    path, out = new_folder(spark, "medians"), None
    for y in years:
        MEDIANS.add_day(n.where(F.col("y") == y), path, str(y))
        if y in (years[0], years[-1]):
            state = cut_lineage(MEDIANS.stored_medians(spark, path).select(F.lit(y).alias("upto"), "category", F.round("category_median", 6).alias("category_median")))
            out = state if out is None else out.unionByName(state)
    return out
