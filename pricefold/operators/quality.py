"""Matcher quality: labelled test set (O5, O6, U1), expected-vs-actual join
(J10), metrics (A10), breakdown (A12) and threshold sweep (A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from .reporting import dround


def sample_per_category(catalog: DataFrame, n: int = K.TEST_SET_PER_CATEGORY,
                        seed: int = K.TEST_SET_SEED) -> DataFrame:
    """``n`` products of each category (all when fewer), drawn by a seeded
    hash of the product id.  The bounded rank is cut down before the shuffle."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("product_id").cast("string")).cast("binary"))
    w = Window.partitionBy("category").orderBy(draw, "product_id")
    return catalog.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def wrong_category_cases(catalog: DataFrame, n: int = K.TEST_SET_PER_CATEGORY) -> DataFrame:
    """A11 negatives that are no accessories: each sampled product, asked for in
    the category after its own (by name, the last wraps around), where it isn't sold."""
    s = sample_per_category(catalog, n)
    names = s.select("category").distinct()     # a row per category
    w = Window.orderBy("category")
    after = names.select("category", F.coalesce(F.lead("category").over(w), F.first("category").over(w)).alias("other"))
    other = after.where("other <> category")
    return s.join(other, "category").select(F.col("canonical_name").alias("query"), F.col("other").alias("category"))


def near_miss_cases(catalog: DataFrame, n: int = K.TEST_SET_PER_CATEGORY, seed: int = K.TEST_SET_SEED) -> DataFrame:
    """A11 negatives close to a product: a sampled product's name with its last word taken from the next
    sampled product of the category (the first follows the last), where no product has that name."""
    s = sample_per_category(catalog, n, seed)
    words = F.split(F.trim("canonical_name"), r"\s+")
    w = Window.partitionBy("category").orderBy("product_id")     # n rows of a category
    last = F.element_at(words, -1)
    other = F.coalesce(F.lead(last).over(w), F.first(last).over(w))
    name = F.array_join(F.concat(F.slice(words, 1, F.size(words) - 1), F.array(other)), " ")
    cases = s.where(F.size(words) > 1).select(name.alias("query"), "category").distinct()
    return cases.join(catalog.select(F.col("canonical_name").alias("query"), "category"), ["query", "category"], "left_anti")


def negatives_frame(spark: SparkSession) -> DataFrame:
    rows = [(q, c) for q, c in K.ACCESSORY_NEGATIVES]
    return spark.createDataFrame(rows, "query string, category string")


def build_test_set(catalog: DataFrame, n: int = K.TEST_SET_PER_CATEGORY, seed: int = K.TEST_SET_SEED) -> DataFrame:
    """O6 + U1: three query variants per sampled product, plus the fixed
    accessory negatives.  Columns: case_id, query, category,
    expected_product_id, test_type."""
    s = sample_per_category(catalog, n, seed)
    name = F.col("canonical_name")
    variants = F.array(
        F.struct(name.alias("query"), F.lit("clean").alias("test_type")),
        F.struct(F.concat(name, F.lit(K.NOISY_EN_SUFFIX)).alias("query"), F.lit("noisy_en").alias("test_type")),
        F.struct(F.concat(F.lit(K.NOISY_DE_PREFIX), name, F.lit(K.NOISY_DE_SUFFIX)).alias("query"),
                 F.lit("noisy_de").alias("test_type")))
    pos = (s.select("product_id", "category", F.explode(variants).alias("v"))
            .select(F.col("v.query").alias("query"), "category",
                    F.col("product_id").cast("string").alias("expected_product_id"),
                    F.col("v.test_type").alias("test_type")))
    neg = (negatives_frame(catalog.sparkSession)
           .select("query", "category", F.lit(None).cast("string").alias("expected_product_id"),
                   F.lit("accessory").alias("test_type")))
    out = pos.unionByName(neg)
    return out.withColumn("case_id", F.xxhash64("query", "category", "test_type"))


def test_breakdown(cases: DataFrame) -> DataFrame:
    """A12."""
    return cases.groupBy("test_type").agg(F.count(F.lit(1)).alias("n"))


def quality_metrics(results: DataFrame) -> DataFrame:
    """A10 from rows (test_type, expected_product_id, matched, product_id)."""
    acc = F.col("test_type") == "accessory"
    m = F.col("matched")
    right = m & (F.col("product_id").cast("string") == F.col("expected_product_id"))
    agg = results.agg(
        F.count_if(~acc & right).alias("tp"),
        F.count_if((~acc & m & ~right) | (acc & m)).alias("fp"),
        F.count_if(~acc & ~m).alias("fn"),
        F.count_if(acc & m).alias("fp_accessory"),
        F.count_if(acc & ~m).alias("tn_accessory"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    n_neg = F.col("fp_accessory") + F.col("tn_accessory")
    fpr = F.when(n_neg > 0, F.col("fp_accessory") / n_neg).otherwise(F.lit(0.0))
    return agg.select("tp", "fp", "fn", "fp_accessory", "tn_accessory",
                      (tp + fn).alias("n_positives"), n_neg.alias("n_negatives"),
                      dround(prec, 4).alias("precision"), dround(rec, 4).alias("recall"),
                      dround(f1, 4).alias("f1"), dround(fpr, 4).alias("fp_rate"))


def threshold_sweep(scored: DataFrame, thresholds=K.SWEEP_THRESHOLDS) -> DataFrame:
    """Rows (is_positive, raw_score) scored ONCE; every threshold is a
    conditional count in one aggregation pass (no join, no per-threshold scan).
    Returns one row per threshold with TP/FP/FN/TN, precision, recall, F1 and
    ``is_best`` (best F1, lowest threshold on ties)."""
    pos = F.col("is_positive")
    s = F.col("raw_score")
    aggs = []
    for t in thresholds:
        aggs += [F.count_if(pos & (s >= t)).alias(f"tp_{t}"), F.count_if(~pos & (s >= t)).alias(f"fp_{t}")]
    aggs += [F.count_if(pos).alias("n_pos"), F.count_if(~pos).alias("n_neg")]
    a = scored.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"tp_{t}").alias("tp"),
                              F.col(f"fp_{t}").alias("fp")) for t in thresholds])
    x = a.select(F.explode(rows).alias("r"), "n_pos", "n_neg").select("r.*", "n_pos", "n_neg")
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("n_pos") - tp
    tn = F.col("n_neg") - fp
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    x = x.select("threshold", "tp", "fp", fn.alias("fn"), tn.alias("tn"),
                 dround(prec, 4).alias("precision"), dround(rec, 4).alias("recall"),
                 f1.alias("_f1"))
    # best = max f1, lowest threshold on ties (strictly-greater scan); 8 rows.
    w = Window.orderBy(F.col("_f1").desc(), F.col("threshold").asc())
    return (x.withColumn("is_best", F.row_number().over(w) == 1)
             .withColumn("f1", dround(F.col("_f1"), 4)).drop("_f1"))
