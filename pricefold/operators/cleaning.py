"""The cleaning pipeline: category, name, price, availability, anomaly flag, dedup.

Step order follows the reference: the anomaly flag is computed on all rows,
before the keep-latest dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import cleaning as C
from ..session import cut_lineage
from .joins import shared

DEDUP_KEYS = ("product_name_clean", "source", "price_clean")


def normalize_keys(df: DataFrame, category_map: dict | None = None, use_nfkc: bool = True) -> DataFrame:
    """Row-local steps 1-3 (P32, P1, P2, P28, P3): everything the dedup key
    and the anomaly median need; one projection, no shuffle."""
    df = C.category_fallback(df)
    price_type = df.schema["price"].dataType if "price" in df.columns else T.StringType()
    if "price" not in df.columns:
        df = df.withColumn("price", F.lit(None).cast("string"))
    if "availability" not in df.columns:
        df = df.withColumn("availability", F.lit(None).cast("string"))
    number = F.col("_price_number") if "_price_number" in df.columns else None
    return (df
            .withColumn("category", C.normalize_category("category", category_map))
            .withColumn("product_name_clean", C.blank_to_null(C.clean_name("product_name", use_nfkc)))
            .withColumn("price_clean", C.parse_price_clean("price", price_type, number)))


def map_availability(df: DataFrame, availability_precedence: str = "reference") -> DataFrame:
    """Step 4 (P4)."""
    avail = C.map_availability if availability_precedence == "reference" \
        else C.map_availability_negation_first
    return df.withColumn("availability_clean", avail("availability"))


def normalize(df: DataFrame, category_map: dict | None = None, use_nfkc: bool = True,
              availability_precedence: str = "reference") -> DataFrame:
    """Row-local steps 1-4 (P32, P1, P2, P28, P3, P4): one projection, no shuffle."""
    return map_availability(normalize_keys(df, category_map, use_nfkc), availability_precedence)


#: Of a quantile sketch: its rank error is one in so many, which bounds how many prices a bracket holds.
MEDIAN_ACCURACY = 10_000


def category_medians(df: DataFrame, approx: bool = False, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Median of non-null ``price_clean`` per category (zeros included), exactly.

    A mergeable quantile sketch per category gives a bracket that is sure to
    hold the median (its rank error is 1 / ``accuracy`` of the rows, the bracket
    is twice as wide on either side).  Prices below the bracket are counted,
    those inside are counted by value, and the running counts find the middle
    one or two.  No task sees more of a category than the values inside its
    bracket.  ``approx=True`` is the sketch's own median.
    """
    p = F.col("price_clean")
    rows = df.where(p.isNotNull()).select("category", p.alias("_p"))
    if approx:
        return rows.groupBy("category").agg(F.percentile_approx("_p", 0.5, accuracy).cast("double").alias("category_median"))
    wide = 2.0 / accuracy
    bracket = rows.groupBy("category").agg(F.percentile_approx("_p", [0.5 - wide, 0.5 + wide], accuracy).alias("_b"),
                                           F.count(F.lit(1)).alias("_n"))
    bracket = bracket.select(F.col("category").alias("_c"), F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"), "_n")
    bracket = shared(cut_lineage(bracket))
    near = rows.join(bracket, F.col("category").eqNullSafe(F.col("_c"))).where("_p <= _hi")
    # one row per category for all that is below, one per value inside
    value = F.when(F.col("_p") >= F.col("_lo"), F.col("_p"))
    counts = near.groupBy("category", value.alias("_v")).agg(F.count(F.lit(1)).alias("_k"), F.first("_n").alias("_n"))
    upto = F.sum("_k").over(Window.partitionBy("category").orderBy(F.col("_v").asc_nulls_first()))
    ranked = counts.withColumn("_upto", upto).where("_v is not null")
    # 1-based ranks of the middle: (n + 1) div 2 and n div 2 + 1
    low, high = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    first = F.min(F.when(F.col("_upto") >= low, F.col("_v")))
    second = F.min(F.when(F.col("_upto") >= high, F.col("_v")))
    return ranked.groupBy("category").agg(((first + second) / 2).cast("double").alias("category_median"))


def flag_anomalies(df: DataFrame, approx_median: bool = False,
                   medians: DataFrame | None = None) -> DataFrame:
    """A1: ``price > 3*median`` or ``price < median/3`` (strict); median <= 0 or
    null price -> False.  One row per category is joined back, worked out first
    and sent whole where it is measured to be small."""
    med = medians if medians is not None else category_medians(df, approx_median)
    out = df.join(shared(cut_lineage(med)), "category", "left")
    m = F.col("category_median")
    p = F.col("price_clean")
    flag = F.when(p.isNull() | m.isNull() | (m <= 0), F.lit(False))\
            .otherwise((p > F.lit(K.ANOMALY_HIGH_FACTOR) * m) | (p < F.lit(K.ANOMALY_LOW_FACTOR) * m))
    return out.select(*df.columns, flag.alias("is_anomaly"))


def dedup_latest(df: DataFrame, keys=DEDUP_KEYS, ts_col: str = "scrape_timestamp") -> DataFrame:
    """W1 keep-latest: per non-null key, the row with the latest timestamp
    (null timestamps last).  Rows with any null key are all kept.

    One ``groupBy(keys, _rid).agg(max(struct(...)))`` pass: ``_rid`` is null
    for complete keys and a per-row id otherwise, so null-key rows form
    singleton groups without a second scan of the input.  Partial
    aggregation collapses repeated keys map-side, so a hot key never lands
    whole in one task.  Ties on the timestamp go to the greatest remaining
    columns (in input column order), independent of partitioning.
    """
    keys = list(keys)
    tie_cols = [c for c in df.columns if c not in keys and c != ts_col]
    has_keys = F.lit(True)
    for k in keys:
        has_keys = has_keys & F.col(k).isNotNull()
    # a null is the least value, so rows without a timestamp come last
    order = F.struct(F.col(ts_col).alias("_ts"), *[F.col(c) for c in tie_cols])
    # The sort-based aggregation sorts by the keys, so rows of similar names are shuffled side by side,
    # which compresses them better than a hash in front (whose short prefix sorts a little faster).
    return (df.withColumn("_rid", F.when(~has_keys, F.monotonically_increasing_id()))
              .groupBy(*keys, "_rid").agg(F.max(order).alias("_b"))
              .select(*[F.col(c) if c in keys else
                        (F.col("_b._ts") if c == ts_col else F.col("_b." + c)).alias(c)
                        for c in df.columns]))


def clean(df: DataFrame, category_map: dict | None = None, use_nfkc: bool = True,
          approx_median: bool = False, availability_precedence: str = "reference") -> DataFrame:
    """Full six-step cleaner.

    Same result as running the steps in the reference order, cheaper plan:
    the medians come from all normalised rows (pre-dedup, as in the
    reference), while the keep-latest dedup runs before the availability
    mapping and the flag join.  Both are row functions of columns that
    precede them in the dedup tie order (availability; category and the
    price key), so they never decide a tie and the surviving row is the same;
    the later steps just see fewer and narrower rows.
    """
    k = normalize_keys(df, category_map, use_nfkc)
    med = category_medians(k, approx_median)
    # a price that is its key isn't carried beside it (a zero is: as a key it has no sign)
    own = isinstance(k.schema["price"].dataType, T.DoubleType) and "_price_number" not in k.columns
    if own:
        k = k.withColumn("price", F.when(F.col("price_clean").isNull() | (F.col("price_clean") == 0), F.col("price")))
    d = dedup_latest(k)
    if own:
        d = d.withColumn("price", F.coalesce("price", "price_clean"))
    d = map_availability(d, availability_precedence)
    return flag_anomalies(d, medians=med)
