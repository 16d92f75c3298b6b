"""Folding offers into price records (A2 unified records, A3 explicit groups).

The layout does not depend on size: a header row per product (or group) with
its statistics, which are partial aggregates, and an offer row per offer with
its position.  Positions of a product with very many offers come from counts per
(product, day) plus the order within a day, and a day beyond a bound is ordered in
stretches (``ranking``), so it is spread, also where all are of one day.
``nested`` folds the offer rows into the one nested record per product that a
JSON sink wants; only that step needs all offers of a product in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.text import non_blank
from .ranking import with_position

#: What price records take of matched listings.
TAKEN = ["product_id", "canonical_name", "product_category", "source", "price_clean", "currency", "availability_clean", "seller", "url",
         "scrape_timestamp", "is_anomaly"]


def exact_mean2(x) -> F.Column:
    """Mean rounded HALF_UP to 2 decimals, independent of summation order:
    prices are taken as integers of 1e-9 (exact for prices of up to nine
    decimals), summed exactly and divided with the remainder.  A double
    average depends on the order, which decides .xx5 ties in the last bit."""
    d = x.cast("decimal(38,9)")
    s = (F.sum(d) * F.lit(1_000_000_000)).cast("decimal(38,0)")
    c = F.count(d).cast("decimal(38,0)")
    q = (F.abs(s) * 2 + c * 10_000_000).cast("decimal(38,0)")
    m = (c * 20_000_000).cast("decimal(38,0)")
    cents = ((q - F.pmod(q, m)) / m).cast("decimal(38,0)")
    return F.when(c > 0, (F.signum(s) * cents.cast("double")) / F.lit(100.0))


def price_value(df: DataFrame, col: str = "price") -> F.Column:
    """The numbers of a raw price column: a numeric column, or the numbers that a
    JSON scan kept beside the text; text prices are no numbers and give null."""
    if "_price_number" in df.columns:
        return F.col("_price_number")
    if isinstance(df.schema[col].dataType, T.NumericType):
        return F.col(col).cast("double")
    return F.lit(None).cast("double")


def offer_struct() -> F.Column:
    """P25 defaults: source else _source, currency else EUR, availability else unknown."""
    return F.struct(
        non_blank(F.col("source")).alias("source"),
        F.col("price_clean").alias("price"),
        F.coalesce(non_blank(F.col("currency")), F.lit(K.DEFAULT_CURRENCY)).alias("currency"),
        F.coalesce(non_blank(F.col("availability_clean")), F.lit("unknown")).alias("availability"),
        F.col("seller"), F.col("url"), F.col("scrape_timestamp"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"))


def with_source_fallback(df: DataFrame) -> DataFrame:
    if "_source" in df.columns:
        return df.withColumn("source", F.coalesce(non_blank(F.col("source")), F.col("_source")))
    return df


def product_stats(matched: DataFrame, matched_by: str = "rule") -> DataFrame:
    """A2 scalars per product: min / max / mean (2 dp) of non-anomalous prices,
    offer_count over all offers (anomalies included)."""
    good = F.when(~F.coalesce(F.col("is_anomaly"), F.lit(False)), F.col("price_clean"))
    # name and category come from the catalog row of the product (functionally
    # dependent on product_id): grouping by them keeps every aggregation
    # buffer fixed-width, i.e. a hash aggregate with map-side partials.
    return (matched.groupBy("product_id", "canonical_name", F.col("product_category").alias("category"))
                   .agg(F.min(good).alias("price_min"),
                        F.max(good).alias("price_max"),
                        exact_mean2(good).alias("price_mean"),
                        F.count(F.lit(1)).alias("offer_count"),
                        F.count_if(F.coalesce(F.col("is_anomaly"), F.lit(False))).alias("anomaly_count"))
                   .withColumn("matched_by", F.lit(matched_by)))


#: Order of a product's offers: latest first, undated last, then by these columns.
OFFER_TIES = ["source", "url", "seller", "price", "currency", "availability", "is_anomaly"]


def product_offers(matched: DataFrame) -> DataFrame:
    """A2 offers: one row per offer with product_id and position."""
    o = with_source_fallback(matched).select("product_id", offer_struct().alias("o")).select("product_id", "o.*")
    ts = F.col("scrape_timestamp").cast("timestamp")
    return with_position(o, "product_id", F.to_date(ts),
                         [ts.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in OFFER_TIES]])


def nested(header: DataFrame, offers: DataFrame, key: str, name: str) -> DataFrame:
    """One record per header row with its offers as an array in position order.

    The array holds every offer of the key, so this is for sinks whose records
    are nested; everything else works on the two flat tables."""
    fields = [c for c in offers.columns if c not in (key, "position")]
    arrays = (offers.groupBy(key).agg(F.collect_list(F.struct("position", F.struct(*fields).alias("o"))).alias("_a"))
                    .select(key, F.transform(F.array_sort("_a"), lambda e: e["o"]).alias(name)))
    return header.join(arrays, key, "left")


def unified_records(matched: DataFrame, matched_by: str = "rule", merged_at=None) -> DataFrame:
    """Nested unified records (F9 shape), one per product."""
    ts = merged_at if merged_at is not None else F.current_timestamp()
    u = nested(product_stats(matched, matched_by), product_offers(matched), "product_id", "prices")
    return u.select("product_id", "canonical_name", "category", "prices", "price_min", "price_max",
                    "price_mean", "offer_count", "matched_by", ts.alias("merged_at"))


# ------------------------------------------------------------------ A3
def group_members(records: DataFrame, groups: DataFrame, matched_by: str = "unknown",
                  row_id: str = "row_id") -> DataFrame:
    """A record per (group, member): rows in no group are groups of their own, a row in two groups appears twice."""
    single = (records.join(groups.select(row_id).distinct(), row_id, "left_anti")
                     .select(F.concat(F.lit("single-"), F.col(row_id).cast("string")).alias("group_id"),
                             F.col(row_id), F.lit("none").alias("_mb")))
    members = (groups.select(F.col("group_id").cast("string").alias("group_id"), row_id)
                     .withColumn("_mb", F.lit(matched_by)).unionByName(single))
    return members.join(records, row_id)


def group_offers(records: DataFrame, groups: DataFrame, row_id: str = "row_id", pos: str = "pos") -> DataFrame:
    """A3 offers: one row per offer with group_id and position, in record order."""
    g = group_members(records, groups, row_id=row_id)
    # the place that the price takes is its number; a text price stays out of it as out of the statistics
    o = g.select("group_id", F.col(pos).alias("_pos"), F.col(row_id).alias("_row"), "seller", "source",
                 price_value(g).alias("price"), "currency", "url", "availability", "scrape_timestamp")
    return with_position(o, "group_id", -F.floor(F.col("_pos") / 65_536), [F.col("_pos"), F.col("_row")]).drop("_pos", "_row")


def merge_groups(records: DataFrame, groups: DataFrame, matched_by: str = "unknown",
                 row_id: str = "row_id", pos: str = "pos", with_offers: bool = True) -> DataFrame:
    """A3: ``groups`` is (group_id, row_id).  Per group: longest name (first on
    ties), first non-empty currency else EUR, min/max/mean of raw prices that
    are numbers (no anomaly filter), count, and the offers as an array unless
    ``with_offers`` is off (``group_offers`` has them as rows).  Rows in no
    group become singletons with matched_by 'none'."""
    g = group_members(records, groups, matched_by, row_id)
    name = F.coalesce(F.col("product_name"), F.lit(""))
    longest = F.max(F.struct(F.char_length(name).alias("l"), (-F.col(pos)).alias("np"),
                             name.alias("n")))["n"]
    first_cur = F.coalesce(F.min(F.when(non_blank(F.col("currency")).isNotNull(),
                                        F.struct(F.col(pos).alias("p"), F.col("currency").alias("c"))))["c"],
                           F.lit(K.DEFAULT_CURRENCY))
    price = price_value(g)
    stats = g.groupBy("group_id").agg(
        longest.alias("product_name"), first_cur.alias("currency"),
        F.min(price).alias("price_min"), F.max(price).alias("price_max"),
        exact_mean2(price).alias("price_mean"), F.count(F.lit(1)).alias("offer_count"),
        F.first("_mb").alias("matched_by"))
    return nested(stats, group_offers(records, groups, row_id, pos), "group_id", "offers") if with_offers else stats
