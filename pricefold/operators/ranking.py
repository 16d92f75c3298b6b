"""Positions within a key without one task that orders all of it.

Rows of a key are numbered by a window where they are few, and else those of a (key, part). The rows of a part beyond a bound are
range-partitioned by their order instead: each partition numbers its own stretch of a part, and prefix
sums over the stretches' counts move it on. Rows equal in all order columns are interchangeable; a salt
that is written with them spreads them, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, written
from .joins import shared

#: Rows of a key, or of a (key, part), that one task may order, and rows of a stretch of a larger one.
MOST, STRETCH = 1_000_000, 250_000


def _before(counts: DataFrame, keys: list, order: Column, n: str, name: str) -> DataFrame:
    """``counts`` with the sum of ``n`` over the rows of the same ``keys`` that come before."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(n).over(w), F.lit(0)))


def _same(columns: dict) -> Column:
    out = F.lit(True)
    for a, b in columns.items():
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def with_position(rows: DataFrame, key: str, part: Column, order: list[Column], most: int | None = None) -> DataFrame:
    """``rows`` with ``position`` (from 1) within ``key``: by ``part`` descending (null last), then ``order``.

    Only keys of more than ``most`` rows are taken apart, and only their rows are written first."""
    most = MOST if most is None else most
    large = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(F.col(key).alias("_k"))
    large = cut_lineage(large)
    few = rows if large.isEmpty() else rows.join(shared(large), _same({key: "_k"}), "left_anti")
    number = F.row_number().over(Window.partitionBy(key).orderBy(part.desc_nulls_last(), *order))
    few = few.withColumn("position", number.cast("long"))
    if large.isEmpty():
        return few
    many = rows.join(shared(large), _same({key: "_k"}), "left_semi")
    return few.unionByName(_in_parts(written(many.withColumn("_part", part).withColumn("_salt", F.rand(11)), "many"), key, order, most))


def _in_parts(parts: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """``parts`` (with _part and _salt) with ``position`` from counts per (key, _part) and the order within them."""
    counts = parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(_before(counts, [key], F.col("_part").desc_nulls_last(), "_n", "_before")
                         .select(F.col(key).alias("_k"), F.col("_part").alias("_p"), "_n", "_before"))
    rows = parts.join(shared(counts), _same({key: "_k", "_part": "_p"})).drop("_k", "_p")
    few = rows.where(F.col("_n") <= most).withColumn("_i", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)))
    large = counts.where(F.col("_n") > most).agg(F.sum("_n")).first()[0]
    if large:
        few = few.unionByName(_in_stretches(rows.where(F.col("_n") > most), key, order, int(large)))
    return few.withColumn("position", F.col("_before") + F.col("_i")).drop("_part", "_salt", "_n", "_before", "_i")


def _in_stretches(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """``rows`` with ``_i`` (from 1) within (key, _part) by ``order``."""
    ranged = rows.repartitionByRange(max(2, -(-n // STRETCH)), F.col(key), F.col("_part"), *order, F.col("_salt"))
    ranged = written(ranged.withColumn("_s", F.spark_partition_id()), "ranged")   # which stretch a row is in lasts
    counts = ranged.groupBy(key, "_part", "_s").agg(F.count(F.lit(1)).alias("_m"))
    counts = _before(counts, [key, "_part"], F.col("_s").asc(), "_m", "_off")
    counts = counts.select(F.col(key).alias("_k"), F.col("_part").alias("_p"), F.col("_s").alias("_t"), "_off")
    number = F.row_number().over(Window.partitionBy(key, "_part", "_s").orderBy(*order))
    return ranged.withColumn("_i", number).join(counts, _same({key: "_k", "_part": "_p", "_s": "_t"})) \
                 .withColumn("_i", F.col("_off") + F.col("_i")).drop("_s", "_k", "_p", "_t", "_off")
