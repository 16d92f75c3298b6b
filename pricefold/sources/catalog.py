"""Product catalog scan (S5): CSV with header or JSON array, fixed schema.

``ean`` keeps its leading zeros, so the schema is declared, never inferred.
A catalog order column (``ord``) is added from the file order when absent:
ties in every matcher go to the first catalog position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CATALOG_SCHEMA = (
    "product_id string, canonical_name string, brand string, model string, variant string, "
    "category string, subcategory string, ean string, our_cost_price_eur double, "
    "our_retail_price_eur double, created_at date, specs_camera_mp int, specs_chip string, "
    "specs_display_inch double, specs_form_factor string, specs_gpu string, specs_interface string, "
    "specs_os string, specs_processor string, specs_ram_gb int, specs_storage_gb int, "
    "specs_tdp_watts int, specs_vram_gb int")


def _with_order(df: DataFrame) -> DataFrame:
    """File order -> ``ord`` = file rank * 2^44 + split offset + place in the split.

    A split holds fewer rows than bytes, so this grows in the order of the file.
    The places come from row ids and their least one per split, a row per split;
    no task numbers the rows of a whole file."""
    if "ord" in df.columns:
        return df
    x = (df.withColumn("_f", F.col("_metadata.file_path"))
           .withColumn("_b", F.col("_metadata.file_block_start"))
           .withColumn("_r", F.monotonically_increasing_id()))
    splits = x.groupBy("_f", "_b").agg(F.min("_r").alias("_first"))
    rank = F.dense_rank().over(Window.orderBy("_f"))      # over a row per split
    splits = splits.select(F.col("_f").alias("_sf"), F.col("_b").alias("_sb"), "_first", (rank - 1).cast("long").alias("_k"))
    place = F.col("_k") * F.lit(1 << 44) + F.col("_b") + F.col("_r") - F.col("_first") + 1
    return (x.join(splits, (F.col("_f") == F.col("_sf")) & (F.col("_b") == F.col("_sb")))
             .withColumn("ord", place.cast("long")).drop("_f", "_b", "_r", "_sf", "_sb", "_first", "_k"))


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return _with_order(spark.read.schema(CATALOG_SCHEMA).option("header", True).csv(path))


def read_catalog_json(spark: SparkSession, path: str) -> DataFrame:
    return _with_order(spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path))
