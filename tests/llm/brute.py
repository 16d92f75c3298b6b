"""Fixtures and plain Python versions that the tests of this folder compare with."""

import duckdb
from pyspark.sql import types as T

DOCS = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType()).add("lang", T.StringType()) \
    .add("source", T.StringType()).add("n_chars", T.LongType())


def docs(spark, rows):
    """Documents from (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def table(sf_dir, name):
    """Rows of a given table as dicts."""
    con = duckdb.connect()
    got = con.execute(f"SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    names = [d[0] for d in got.description]
    return [dict(zip(names, r)) for r in got.fetchall()]
