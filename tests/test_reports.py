"""Run-metric reports on a re-typed 14-run sample with its published summary,
matcher-quality metrics and the threshold sweep."""

from pricefold.operators import quality, reporting

RUNS = [
    ("beautifulsoup", "amazon_de", 21, 5.07, 0.0), ("beautifulsoup", "ebay_de", 60, 4.05, 0.0),
    ("beautifulsoup", "idealo_de", 0, 9.69, 0.0), ("crawl4ai", "amazon_de", 2, 11.93, 0.002),
    ("crawl4ai", "ebay_de", 2, 14.29, 0.002), ("crawl4ai", "idealo_de", 0, 8.03, 0.002),
    ("playwright", "amazon_de", 22, 5.56, 0.0), ("playwright", "ebay_de", 60, 4.35, 0.0),
    ("playwright", "idealo_de", 0, 49.37, 0.0), ("selenium", "amazon_de", 22, 12.87, 0.0),
    ("selenium", "ebay_de", 60, 11.66, 0.0), ("selenium", "idealo_de", 0, 11.77, 0.0),
    ("serpapi", "google_shopping", 40, 0.62, 0.01), ("serpapi", "idealo_de_serpapi", 9, 0.56, 0.01),
]


def _runs(spark):
    rows = [(a, s, "laptops", f, t, True, "", c, 0, "2026-04-07") for a, s, f, t, c in RUNS]
    return spark.createDataFrame(rows, "scraper_name string, source string, category string, products_found int, "
                                       "time_seconds double, success boolean, error_message string, "
                                       "cost_usd double, tokens_used int, timestamp string")


def test_approach_stats_golden(spark):
    got = {r["scraper_name"]: r.asDict() for r in reporting.approach_stats(_runs(spark)).collect()}
    assert (got["beautifulsoup"]["avg_products_found"], got["beautifulsoup"]["avg_time_seconds"]) == (27.0, 6.27)
    assert (got["crawl4ai"]["avg_products_found"], got["crawl4ai"]["avg_time_seconds"],
            got["crawl4ai"]["total_cost_usd"]) == (1.3, 11.42, 0.006)
    assert (got["playwright"]["avg_products_found"], got["playwright"]["avg_time_seconds"]) == (27.3, 19.76)
    assert (got["selenium"]["avg_products_found"], got["selenium"]["avg_time_seconds"]) == (27.3, 12.1)
    assert (got["serpapi"]["avg_products_found"], got["serpapi"]["avg_time_seconds"],
            got["serpapi"]["total_cost_usd"], got["serpapi"]["runs"]) == (24.5, 0.59, 0.02, 2)
    assert all(v["success_rate"] == 1.0 for v in got.values())


def test_source_winners_golden(spark):
    got = {r["source"]: (r["fastest_scraper"], r["most_products_scraper"], r["max_products_found"])
           for r in reporting.source_winners(_runs(spark)).collect()}
    assert got == {"amazon_de": ("beautifulsoup", "playwright", 22),
                   "ebay_de": ("beautifulsoup", "beautifulsoup", 60),
                   "idealo_de": ("crawl4ai", "beautifulsoup", 0),
                   "google_shopping": ("serpapi", "serpapi", 40),
                   "idealo_de_serpapi": ("serpapi", "serpapi", 9)}


def test_totals_and_cost_per_product_golden(spark):
    t = reporting.run_totals(_runs(spark)).collect()[0]
    assert (t["total_cost_usd"], t["total_runs"]) == (0.026, 14)
    cpp = {(r["scraper_name"], r["source"]): r["cost_per_product"]
           for r in reporting.with_derived(_runs(spark)).collect()}
    assert cpp[("crawl4ai", "amazon_de")] == 0.001 and cpp[("crawl4ai", "idealo_de")] == 0.0
    assert cpp[("serpapi", "google_shopping")] == 0.00025 and cpp[("serpapi", "idealo_de_serpapi")] == 0.001111


def test_success_text_and_report_winners(spark):
    runs = _runs(spark).union(spark.createDataFrame(
        [("serpapi", "x_src", "laptops", 0, 1.0, False, "boom", 0.0, 0, "t")], _runs(spark).schema))
    txt = {r["scraper_name"]: r["success_rate_text"] for r in reporting.success_text(runs).collect()}
    assert txt["serpapi"] == "2/3 (66%)" and txt["selenium"] == "3/3 (100%)"
    win = {r["source"]: r.asDict() for r in reporting.report_winners(runs).collect()}
    assert win["x_src"]["fastest_scraper"] == "all failed"
    assert win["ebay_de"]["cheapest_scraper"] == "beautifulsoup"


def test_quality_metrics(spark):
    rows = [("clean", "1", True, "1"), ("clean", "2", True, "9"), ("noisy_en", "3", False, None),
            ("accessory", None, True, "5"), ("accessory", None, False, None)]
    df = spark.createDataFrame(rows, "test_type string, expected_product_id string, matched boolean, "
                                     "product_id string")
    r = quality.quality_metrics(df).collect()[0].asDict()
    assert (r["tp"], r["fp"], r["fn"], r["fp_accessory"], r["tn_accessory"]) == (1, 2, 1, 1, 1)
    assert (r["n_positives"], r["n_negatives"]) == (2, 2)
    assert (r["precision"], r["recall"], r["fp_rate"]) == (0.3333, 0.5, 0.5)


def test_threshold_sweep(spark):
    df = spark.createDataFrame([(True, 100.0), (True, 81.5), (False, 70.0), (False, 90.0)],
                               "is_positive boolean, raw_score double")
    rows = {r["threshold"]: r.asDict() for r in quality.threshold_sweep(df).collect()}
    assert rows[60]["tp"] == 2 and rows[60]["fp"] == 2
    assert rows[95]["tp"] == 1 and rows[95]["fp"] == 0 and rows[95]["tn"] == 2
    best = [t for t, r in rows.items() if r["is_best"]]
    assert best == [75]   # f1 0.8 at 75 and 80; the lower threshold wins
