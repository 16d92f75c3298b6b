"""Run-metric reports (A4-A7, A6b, P27, P29) and the pipeline funnel.

Input: run-metric rows (F7): scraper_name, source, category, products_found,
time_seconds, success, error_message, cost_usd, tokens_used, timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prices as PR
from ..functions import text as TX


def dround(c, places: int):
    """Rounding of the decimal value (HALF_UP), stable across engines."""
    return F.round(c.cast("decimal(38,12)"), places).cast("double")


def with_derived(runs: DataFrame) -> DataFrame:
    """P27 cost per product and P29 status label on every run row."""
    return runs.select("*",
                       PR.cost_per_product("cost_usd", "products_found").alias("cost_per_product"),
                       TX.run_status("success", "error_message", "products_found").alias("status"))


def approach_stats(runs: DataFrame) -> DataFrame:
    """A4 over all rows (failures included)."""
    n = F.count(F.lit(1))
    s = F.count_if("success")
    return runs.groupBy("scraper_name").agg(
        n.alias("runs"), s.alias("successes"),
        dround(s / n, 3).alias("success_rate"),
        dround(F.avg("products_found"), 1).alias("avg_products_found"),
        dround(F.avg("time_seconds"), 2).alias("avg_time_seconds"),
        dround(F.sum("cost_usd"), 6).alias("total_cost_usd"))


def source_winners(runs: DataFrame) -> DataFrame:
    """A5 stored winners over ALL rows; ties go to the first approach name."""
    fastest = F.min(F.struct(F.col("time_seconds"), F.col("scraper_name")))["scraper_name"]
    most = F.min(F.struct((-F.col("products_found")).alias("nf"), F.col("scraper_name")))["scraper_name"]
    return runs.groupBy("source").agg(fastest.alias("fastest_scraper"),
                                      most.alias("most_products_scraper"),
                                      F.max("products_found").alias("max_products_found"))


def report_winners(runs: DataFrame) -> DataFrame:
    """Winners among successful runs; cheapest per product among runs that
    found something; sources where everything failed get 'all failed'."""
    ok = F.col("success")
    cpp = PR.cost_per_product("cost_usd", "products_found")
    fastest = F.min(F.when(ok, F.struct(F.col("time_seconds"), F.col("scraper_name"))))["scraper_name"]
    most = F.min(F.when(ok, F.struct((-F.col("products_found")).alias("nf"), F.col("scraper_name"))))["scraper_name"]
    cheap = F.min(F.when(ok & (F.col("products_found") > 0),
                         F.struct(cpp.alias("c"), F.col("scraper_name"))))["scraper_name"]
    any_ok = F.max(ok.cast("int")) == 1
    return runs.groupBy("source").agg(
        F.when(any_ok, fastest).otherwise(F.lit("all failed")).alias("fastest_scraper"),
        F.when(any_ok, most).alias("most_products_scraper"),
        F.when(any_ok, cheap).alias("cheapest_scraper"))


def success_text(runs: DataFrame) -> DataFrame:
    """``s/n (floor(100*s/n)%)`` per approach."""
    n = F.count(F.lit(1))
    s = F.count_if("success")
    return runs.groupBy("scraper_name").agg(
        F.concat(s.cast("string"), F.lit("/"), n.cast("string"), F.lit(" ("),
                 F.floor(s * 100 / n).cast("string"), F.lit("%)")).alias("success_rate_text"))


def run_totals(runs: DataFrame) -> DataFrame:
    """A7."""
    return runs.agg(dround(F.sum("cost_usd"), 6).alias("total_cost_usd"),
                    F.count(F.lit(1)).alias("total_runs"))


def preview_per_source(df: DataFrame, n: int = 3, order=("scrape_timestamp", "url")) -> DataFrame:
    """The first ``n`` rows per source (a top-k report: the limit is the
    feature).  Window per source with a bounded rank filter."""
    from pyspark.sql import Window
    o = [F.col(order[0]).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in order[1:]]
    w = Window.partitionBy("source").orderBy(*o)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
