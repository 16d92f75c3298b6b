"""Join helpers: what is sent to all executors is measured in bytes first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes (in the workers' memory) up to which a side is sent whole to all executors.
MAX_SHARED_BYTES = 64 << 20


def frame_bytes(df: DataFrame) -> int:
    """About what the rows of ``df`` take as Python objects; one aggregation, nothing is cached."""
    def width(c, kind):
        if isinstance(kind, T.StringType):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 60
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.StringType):
                return F.aggregate(F.coalesce(c, F.array().cast(kind)), F.lit(60), lambda n, x: n + F.octet_length(x) + 80)
            return F.coalesce(F.size(c), F.lit(0)) * 16 + 60
        return F.lit(32)
    row = F.lit(100)
    for f in df.schema.fields:
        row = row + width(F.col(f.name), f.dataType)
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def shared(df: DataFrame, most: int = MAX_SHARED_BYTES) -> DataFrame:
    """``df`` (flat, and cheap to read) to be sent whole to all executors where its rows are measured to take at most
    ``most`` bytes there; else Spark picks the join. A join's other side then isn't shuffled, which Spark, planning
    from files' sizes or without any, may find out only when that is done."""
    row = F.lit(64)
    for f in df.schema.fields:
        row = row + (F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16 if isinstance(f.dataType, T.StringType) else F.lit(16))
    size = df.agg(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def spread(df: DataFrame, *cols, per_core: int = 4) -> DataFrame:
    """Hash-spread rows that feed CPU-heavy Python work over all cores.

    AQE coalesces small shuffles by bytes, which would put a compute-bound
    ``mapInPandas`` into one task; an explicit repartition count is kept."""
    spark = df.sparkSession
    n = max(int(spark.sparkContext.defaultParallelism) * per_core,
            int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *cols) if cols else df.repartition(n)
