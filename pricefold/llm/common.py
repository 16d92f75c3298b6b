"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package, table_path
from ..session import written as written  # computed once, and safe from lost executors

#: Rows of one Arrow batch that are worked on at once; long texts then stay within a worker's memory.
SLICE_ROWS = 256
#: Rows of an Arrow batch at most.
BATCH_ROWS = 2000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def prepare(spark: SparkSession) -> None:
    """What every operator needs of a session: the shared folder, the package on the workers, and
    Arrow batches that long texts leave small."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for a table that is written and read again."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bounded_sample(df: DataFrame, n: int, group: str, key: str) -> DataFrame:
    """At most ``n`` rows of each ``group``, those with the smallest hash of ``key``.

    The hash takes the place of a seed, so the sample doesn't depend on how rows are partitioned.
    A running number up to a constant is cut down before the shuffle (WindowGroupLimit).
    """
    from pyspark.sql import Window
    order = Window.partitionBy(group).orderBy(F.xxhash64(F.col(key), F.lit(7)), F.col(key))
    return df.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value of each 64-bit value (the published finaliser of SplitMix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shared:
    """A broadcast value, and what a worker process makes of it once; a worker keeps the last one only."""

    made: dict[str, object] = {}

    def __init__(self, spark: SparkSession, value, make=None):
        self.key, self.make, self.broadcast = uuid.uuid4().hex, make, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        if self.key not in Shared.made:
            Shared.made.clear()
            value = self.broadcast.value
            Shared.made[self.key] = self.make(value) if self.make else value
        return Shared.made[self.key]


class Memo(dict):
    """A dict that computes what is missing and starts anew at ``limit`` entries, so it stays bounded."""

    def __init__(self, make, limit: int = 150_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value
