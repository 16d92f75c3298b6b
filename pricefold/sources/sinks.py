"""Sinks: unified nested records (S8), flat outputs (S9), catalog summary
(S10) and the run report (S11).  All writes are partitioned DataFrame writes
with dynamic partition overwrite; nothing is gathered on the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sanitize_frame
from ..operators import reporting
from .raw import packed, write_partitioned

CATALOG_FLAT_FIELDS = ["product_name", "currency", "price_min", "price_max", "price_mean",
                       "offer_count", "matched_by"]


def _today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def write_unified(unified: DataFrame, root: str, run_date: dt.date | None = None, compression: str | None = None) -> None:
    """``unified/category=/year=/month=/day=`` JSON, NaN/Inf -> null,
    timestamps as ISO text (P26); packed by ``compression`` where one is given."""
    d = run_date or _today()
    # O1: records sorted by product id inside each output partition
    out = sanitize_frame(unified.sortWithinPartitions("product_id")).withColumn("category_key", F.col("category")) \
        .withColumn("year", F.lit(f"{d.year:04d}")).withColumn("month", F.lit(f"{d.month:02d}")) \
        .withColumn("day", F.lit(f"{d.day:02d}"))
    write_partitioned(out, root.rstrip("/") + "/unified", ["category_key", "year", "month", "day"], compression=compression)


def write_flat(df: DataFrame, root: str, name: str, fmt: str = "json",
               run_date: dt.date | None = None, compression: str | None = None) -> None:
    """``processed/{name}/run_date=YYYY-MM-DD/`` as JSON lines or CSV with
    header; UTF-8, non-ASCII kept; packed by ``compression`` where one is given."""
    d = (run_date or _today()).isoformat()
    out = sanitize_frame(df).withColumn("run_date", F.lit(d))
    w = packed(out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date"), compression)
    path = f"{root.rstrip('/')}/processed/{name}"
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.option("ignoreNullFields", False).json(path)


def write_catalog(catalog: DataFrame, root: str) -> None:
    """Nested records as JSON plus the flat seven-column CSV."""
    base = root.rstrip("/") + "/catalog"
    sanitize_frame(catalog).write.mode("overwrite").option("ignoreNullFields", False).json(base + "/catalog_json")
    (catalog.select(*CATALOG_FLAT_FIELDS).write.mode("overwrite").option("header", True)
            .csv(base + "/catalog_csv"))


def write_run_report(runs: DataFrame, root: str, run_date: dt.date | None = None) -> None:
    """Detail rows and the summary aggregates (A4, A5, A7) for one date."""
    d = (run_date or _today()).isoformat()
    base = f"{root.rstrip('/')}/benchmark/run_date={d}"
    # O2: detail rows ordered by (approach, source)
    (reporting.with_derived(runs).orderBy("scraper_name", "source")
              .write.mode("overwrite").option("ignoreNullFields", False).json(base + "/detail"))
    reporting.approach_stats(runs).write.mode("overwrite").json(base + "/by_scraper")
    reporting.source_winners(runs).write.mode("overwrite").json(base + "/by_source")
    reporting.run_totals(runs).write.mode("overwrite").json(base + "/totals")
