"""Exact cosine search that skips blocks of the catalog (J4 for catalogs of any size).

Angles between unit vectors are a metric. Each category's vectors are dealt to their nearest centre (some
of its own vectors, drawn by hash) and to shells by their angle to it. For a query at angle ``a`` to the
centre, no vector of a shell from ``lo`` to ``hi`` is nearer than ``max(a - hi, lo - a, 0)``. A query first
scores the block with the best bound; then only blocks whose bound reaches that score are visited, so
clustered vectors are found in few blocks, and vectors without structure cost what a full scan costs.

A small category is one block. Vectors that aren't of unit length (a text without words is the zero
vector) lie in a block that has no bound, and such queries visit every block of their category.
Centres and the table of blocks are broadcast: at most ``MAX_CENTRES`` vectors, and a row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Vectors to a centre, centres in all at most, width of a shell in radians, vectors of a block, queries of a task.
CLUSTER, MAX_CENTRES, SHELL, BLOCK, QUERIES = 2000, 4096, 0.1, 10_000, 5_000
#: What a bound may be wrong by: vectors of 32-bit numbers are of unit length up to 1e-6.
MARGIN = 1e-5


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows made unit length, and which of them were (nearly) of that length before."""
    size = np.sqrt((m * m).sum(axis=1))
    ok = np.abs(size - 1) < MARGIN / 10
    return m / np.where(ok, size, 1.0)[:, None], ok


def _centres(catalog: DataFrame, cluster: int) -> dict[str, np.ndarray]:
    """Unit vectors drawn from each category of more than ``cluster`` vectors, in proportion to its size."""
    sizes = catalog.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > cluster)
    total, most = large.agg(F.sum("n"), F.max("n")).first()
    if not total:
        return {}
    per = max(cluster, -(-total // MAX_CENTRES))
    take = int(-(-most // per))
    order = Window.partitionBy("category").orderBy(F.xxhash64("product_id"), "product_id")
    drawn = catalog.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= take).join(large, "category")
    drawn = drawn.where(F.col("_n") <= F.ceil(F.col("n") / per)).select("category", "embedding").toPandas()
    out = {}
    for category, rows in drawn.groupby("category"):
        unit, ok = _unit(_matrix(rows["embedding"]))
        if ok.any():
            out[category] = unit[ok]
    return out


def _angles(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(m @ centres.T, -1.0, 1.0))


def clustered(catalog: DataFrame, centres) -> DataFrame:
    """``catalog`` (category, product_id, ord, embedding) with cluster (-1: none), angle and shell."""
    kinds = {f.name: f.dataType.simpleString() for f in catalog.schema.fields}

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = centres.value
        for batch in batches:
            cluster, angle = np.full(len(batch), -1, np.int32), np.zeros(len(batch))
            for category, at in batch.groupby("category", sort=False).indices.items():
                if category in known:
                    unit, ok = _unit(_matrix(batch["embedding"].iloc[at]))
                    a = _angles(unit, known[category])
                    near = a.argmin(axis=1)
                    cluster[at] = np.where(ok, near, -1)
                    angle[at] = np.where(ok, a[np.arange(len(a)), near], 0.0)
            yield batch.assign(cluster=cluster, angle=angle, shell=np.floor(angle / SHELL).astype(np.int32))
    columns = ["category", "product_id", "ord", "embedding"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", cluster int, angle double, shell int"
    return catalog.select(*columns).mapInPandas(assign, schema)


def _visits(queries: DataFrame, centres, table, first: bool) -> DataFrame:
    """query_id, block: each query's block of the best bound (``first``), or the others that its ``best`` doesn't rule out."""
    kind = queries.schema["query_id"].dataType.simpleString()

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, blocks = centres.value, table.value
        for batch in batches:
            ids, visited = [], []
            for category, at in batch.groupby("category", sort=False).indices.items():
                if category not in blocks:
                    continue
                number, cluster, lo, hi = blocks[category]
                unit, ok = _unit(_matrix(batch["embedding"].iloc[at]))
                bound = np.full((len(at), len(number)), 1.0)
                held = cluster >= 0
                if held.any():
                    a = _angles(unit, known[category])[:, cluster[held]]
                    least = np.maximum(np.maximum(a - hi[held], lo[held] - a), 0.0)
                    bound[:, held] = np.where(ok[:, None], np.cos(np.minimum(least, np.pi)), 1.0)
                top = bound.argmax(axis=1)
                if first:
                    ids.append(batch["query_id"].to_numpy()[at])
                    visited.append(number[top])
                    continue
                best = batch["best"].to_numpy()[at]
                sizes = np.sqrt((_matrix(batch["embedding"].iloc[at]) ** 2).sum(axis=1))
                may = (bound >= (best - MARGIN)[:, None]) | (np.abs(sizes - 1) >= MARGIN / 10)[:, None]
                may[:, ~held] = True
                may[np.arange(len(at)), top] = False
                q, b = np.nonzero(may)
                ids.append(batch["query_id"].to_numpy()[at][q])
                visited.append(number[b])
            if ids:
                yield pd.DataFrame({"query_id": np.concatenate(ids), "block": np.concatenate(visited)})
    return queries.mapInPandas(choose, f"query_id {kind}, block long")


def _score(visits: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Best product of each (query, visited block): query_id, score, ord, product_id."""
    from .vector import best_rows
    n = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("_salts"))
    asked = visits.join(n, "block").withColumn("salt", F.pmod(F.xxhash64("query_id"), F.col("_salts"))).drop("_salts") \
                  .join(queries.select("query_id", "embedding"), "query_id")
    held = rows.join(n, "block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts")
    columns = ["query_id", "score", "ord", "product_id"]

    def run(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame(columns=columns)
        cs = cs.sort_values("ord", kind="stable")
        at, score = best_rows(_matrix(qs["embedding"]), _matrix(cs["embedding"]))   # first maximum = catalog order
        return pd.DataFrame({"query_id": qs["query_id"].to_numpy(), "score": score, "ord": cs["ord"].to_numpy()[at], "product_id": cs["product_id"].to_numpy()[at]})
    kind = {c: (queries if c == "query_id" else rows).schema[c].dataType.simpleString() for c in ("query_id", "product_id", "ord")}
    return asked.groupBy("block", "salt").cogroup(held.select("block", "salt", "product_id", "ord", "embedding").groupBy("block", "salt")) \
                .applyInPandas(run, f"query_id {kind['query_id']}, score double, ord {kind['ord']}, product_id {kind['product_id']}")


def best_pruned(queries: DataFrame, catalog: DataFrame, cluster: int = CLUSTER) -> tuple[DataFrame, dict[str, int]]:
    """(query_id, best_score, best_product_id) of each query with a candidate, and how many (query, block)
    pairs there are and were visited. queries: (query_id, category, embedding); catalog: (product_id, category, ord, embedding)."""
    spark = queries.sparkSession
    queries = cut_lineage(queries.select("query_id", "category", "embedding"))
    centres = spark.sparkContext.broadcast(_centres(catalog, cluster))
    rows = cut_lineage(clustered(catalog, centres))
    keys = ["category", "cluster", "shell"]
    shells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    # a shell of more vectors than a block holds is several blocks with the same bound
    parts = shells.withColumn("chunks", F.ceil(F.col("n") / BLOCK)).withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
    parts = cut_lineage(parts.withColumn("block", F.monotonically_increasing_id()))
    rows = rows.join(shells.select(*keys, F.ceil(F.col("n") / BLOCK).alias("chunks")), keys) \
               .withColumn("chunk", F.pmod(F.xxhash64("product_id"), F.col("chunks"))).join(parts.select(*keys, "chunk", "block"), [*keys, "chunk"])
    rows = cut_lineage(rows.select("block", "product_id", "ord", "embedding"))
    listed = parts.select("category", "block", "cluster", "lo", "hi").orderBy("block").toPandas()  # a row per block
    table = spark.sparkContext.broadcast({c: tuple(g[k].to_numpy() for k in ("block", "cluster", "lo", "hi")) for c, g in listed.groupby("category")})

    start = cut_lineage(_visits(queries, centres, table, True))
    found = cut_lineage(_score(start, queries, rows))
    reached = queries.join(found.select("query_id", F.col("score").alias("best")), "query_id")
    more = cut_lineage(_visits(reached, centres, table, False))
    found = found.unionByName(_score(more, queries, rows))
    # order keys may be structures, which can't be negated: the smallest one among the best scores
    top = found.groupBy("query_id").agg(F.max("score").alias("best_score"))
    best = found.join(top, "query_id").where(F.col("score") == F.col("best_score")).groupBy("query_id", "best_score") \
                .agg(F.min_by("product_id", "ord").alias("best_product_id"))
    per = listed.groupby("category").size()
    asked = {r["category"]: r["n"] for r in queries.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {"pairs": int(sum(n * per.get(c, 0) for c, n in asked.items())), "visited": start.count() + more.count()}
    return best, counts
