"""Category medians that a new day updates without reading the history again (A1).

A day is stored twice, both times as counts: by cell (a coarse, monotone function of the price), and by
price within its cell, in folders of a few cells each. Cells are a sketch that merges by addition and is
exact in itself: the summed counts say in which cell the middle price of a category lies and how many
prices come before that cell. Only the prices of these cells are read, which is a folder a day and
category at most two, whatever the days before hold. The result equals ``category_medians`` over all rows.
A day that is stored again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Cells to a factor of e of the price, and cells of a folder.
FINENESS, FOLDER = 50, 10
VALUES, CELLS = "category string, price double, n long, cell int, folder int", "category string, cell int, n long"


def cell(price: Column) -> Column:
    """Number of the price's cell: never smaller for a larger price. Prices up to 0 are told apart by sign only."""
    scale = F.floor(F.ln(F.greatest(price, F.lit(1e-6))) * FINENESS).cast("int")
    return F.when(price > 0, scale).when(price == 0, F.lit(-1_000_000)).otherwise(F.lit(-1_000_001))


def add_day(rows: DataFrame, path: str, day: str) -> None:
    """Store the non-null ``price_clean`` of a day's ``rows`` by category; the day's former rows are replaced."""
    # categories may be null; folders may not
    values = rows.where("price_clean is not null and not isnan(price_clean)").select("category", F.col("price_clean").cast("double").alias("price"))
    values = values.groupBy("category", "price").agg(F.count(F.lit(1)).alias("n")).withColumn("cell", cell(F.col("price")))
    values.withColumn("folder", F.floor(F.col("cell") / FOLDER).cast("int")).repartition("folder") \
          .sortWithinPartitions("folder", "cell").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/values/day={day}")
    stored = rows.sparkSession.read.schema(VALUES).parquet(f"{path}/values/day={day}")
    stored.groupBy("category", "cell").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{path}/cells/day={day}")


def middle_cells(spark: SparkSession, path: str) -> DataFrame:
    """category, cell, folder, before (prices of the category in lower cells) and n (all its prices) of the cells
    that hold a category's middle price, or one of its two."""
    cells = spark.read.schema(CELLS).parquet(f"{path}/cells").groupBy("category", "cell").agg(F.sum("n").alias("here"))
    upto = F.sum("here").over(Window.partitionBy("category").orderBy("cell"))
    whole = F.sum("here").over(Window.partitionBy("category"))
    ranked = cells.withColumn("upto", upto).withColumn("n", whole).withColumn("before", F.col("upto") - F.col("here"))
    low, high = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    holds = ((F.col("before") < low) & (low <= F.col("upto"))) | ((F.col("before") < high) & (high <= F.col("upto")))
    return ranked.where(holds).select("category", "cell", F.floor(F.col("cell") / FOLDER).cast("int").alias("folder"), "before", "n")


def stored_medians(spark: SparkSession, path: str) -> DataFrame:
    """category and category_median of all stored days."""
    wanted = middle_cells(spark, path)
    # few rows (two a category): their folders prune the files before any is opened
    folders = [r[0] for r in wanted.select("folder").distinct().collect()]
    values = spark.read.schema(VALUES).parquet(f"{path}/values").where(F.col("folder").isin(folders)).alias("v")
    w = wanted.alias("w")
    same = F.col("v.category").eqNullSafe(F.col("w.category")) & (F.col("v.cell") == F.col("w.cell"))
    counts = values.join(w, same).groupBy("w.category", "w.cell", "w.before", "w.n", F.col("v.price").alias("price")).agg(F.sum("v.n").alias("k"))
    upto = F.col("before") + F.sum("k").over(Window.partitionBy("category", "cell").orderBy("price"))
    ranked = counts.withColumn("upto", upto)
    first = F.min(F.when(F.col("upto") >= F.expr("(n + 1) div 2"), F.col("price")))
    second = F.min(F.when(F.col("upto") >= F.expr("n div 2 + 1"), F.col("price")))
    return ranked.groupBy("category").agg(((first + second) / 2).alias("category_median"))
