"""A store of catalog embeddings that is brought up to date by what changed.

The store is a folder of versions. A version holds the rows that it changed: an embedding with the
fingerprint of its text and the version of its encoder, or a tombstone for a product that is gone. A
product's state as of a version is its last row up to there. Renamed products (another fingerprint) and
products of another encoder version are encoded again, the rest is never sent to the encoder; removed
products get a tombstone. ``compact`` folds old versions into one; a store can be read as of any version
from there on. A version counts when its folder is complete (Spark's ``_SUCCESS``), so a job that was
lost halfway leaves nothing behind that a reader would take. One writer at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .encoder import Encoder

STATE = ["fingerprint", "encoder", "embedding", "deleted"]


def fingerprint(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]      # a folder a version
    found = [int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n))]
    done = lambda v: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}/_SUCCESS"))
    return sorted(v for v in found if done(v))


def _rows(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in numbers])


def read(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """product_id, fingerprint, encoder, embedding and version of each product that the store holds as of a version."""
    numbers = [v for v in versions(spark, path) if as_of is None or v <= as_of]
    if not numbers:
        raise ValueError(f"the store {path} has no version" + (f" up to {as_of}" if as_of is not None else ""))
    last = F.max_by(F.struct(*STATE), "version").alias("s")
    state = _rows(spark, path, numbers).groupBy("product_id").agg(last, F.max("version").cast("int").alias("version"))
    return state.where("not s.deleted").select("product_id", "s.fingerprint", "s.encoder", "s.embedding", "version")


def sync(path: str, catalog: DataFrame, encoder: Encoder, encoder_version: str) -> dict[str, int]:
    """Bring the store to ``catalog`` (product_id, text; a product once). Nothing is written if nothing changed.

    Returns version (the store's last one), encoded and removed."""
    spark = catalog.sparkSession
    wanted = catalog.select("product_id", "text").withColumn("fingerprint", fingerprint(F.col("text"))).withColumn("encoder", F.lit(encoder_version))
    known = versions(spark, path)
    if known:
        held = read(spark, path).select("product_id", "fingerprint", "encoder")
        changed = wanted.join(held, ["product_id", "fingerprint", "encoder"], "left_anti")
        gone = held.join(wanted.select("product_id"), "product_id", "left_anti").select("product_id", "fingerprint", "encoder")
    else:
        changed, gone = wanted, wanted.select("product_id", "fingerprint", "encoder").limit(0)
    fresh = encoder(changed).select("product_id", "fingerprint", "encoder", F.col("embedding").cast("array<float>").alias("embedding"), F.lit(False).alias("deleted"))
    dead = gone.select("*", F.lit(None).cast("array<float>").alias("embedding"), F.lit(True).alias("deleted"))
    rows = cut_lineage(fresh.unionByName(dead))
    counts = {r["deleted"]: r["count"] for r in rows.groupBy("deleted").count().collect()}
    version = known[-1] if known else 0
    if counts:
        version += 1
        rows.write.mode("overwrite").parquet(f"{path}/version={version}")
    return {"version": version, "encoded": counts.get(False, 0), "removed": counts.get(True, 0)}


def compact(spark: SparkSession, path: str, up_to: int | None = None) -> int:
    """Fold the versions up to ``up_to`` (all) into that one: live rows only. Earlier versions can't be read any more.

    The folded rows are written beside the store and then take the place of the last folded version."""
    numbers = [v for v in versions(spark, path) if up_to is None or v <= up_to]
    if len(numbers) < 2:
        return numbers[-1] if numbers else 0
    target = numbers[-1]
    rows = cut_lineage(read(spark, path, target).select("product_id", *STATE[:3], F.lit(False).alias("deleted")))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    side = f"{path}/_compact-{target}"
    rows.write.mode("overwrite").parquet(side)
    # the last version goes and comes back within two renames of whole folders; older ones only repeat what it says
    fs.rename(hadoop(f"{path}/version={target}"), hadoop(f"{path}/_old-{target}"))
    fs.rename(hadoop(side), hadoop(f"{path}/version={target}"))
    for v in numbers[:-1]:
        fs.delete(hadoop(f"{path}/version={v}"), True)
    fs.delete(hadoop(f"{path}/_old-{target}"), True)
    return target
