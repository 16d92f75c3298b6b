"""Latest partition per key (S2 / W3 over a table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_partition(df: DataFrame, keys, date_col: str = "run_date") -> DataFrame:
    """Rows of the partition with the greatest ``date_col`` per key.  The
    per-key maximum is a partial aggregate; joining it back (equi-join on
    keys + date) keeps only the latest partition (rank() == 1 semantics)."""
    keys = list(keys)
    latest = df.where(F.col(date_col).isNotNull()).groupBy(*keys).agg(F.max(date_col).alias(date_col))
    return df.join(latest, keys + [date_col], "left_semi")
