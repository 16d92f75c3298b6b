"""Nearest neighbours by inner product with an adaptive dimension scan over inverted lists.

Largest inner product becomes smallest Euclidean distance by one more column, sqrt(M^2 - |x|^2) with
M the largest norm (0 for queries). Vectors are rotated at random and scanned in blocks of columns.
After d of D columns a candidate's distance is estimated as partial * D / d; by the hypothesis test
of adaptive sampling it is abandoned once that exceeds the query's current 20th distance by the
factor (1 + EPSILON / sqrt(d))^2. What survives all columns is scored on the original vectors in
double precision.

Lists are those of k-means centroids, about sqrt(rows) of them, fitted on a bounded sample
(``SAMPLE`` rows by hash). How many lists a query probes is set on that sample, too: the fewest that
reach ``TARGET`` recall of its own exact neighbours, and always enough to hold k candidates. Every
row is in a list. Lists and their queries are cut into blocks, so no task holds a hot list or all
queries of one; a query's nearest list is scanned first, and its 20th distance there is the bound
with which the others start. Of equal vectors only the k + 1 smallest ids are scanned, as no other
can be among the k nearest.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither do those without an id or of another length than most (of equally frequent lengths
the shorter is right); of rows with one id the smallest vector counts; fewer than k candidates are
all returned; ties go to the smaller id; without candidates there are no rows; other input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

K = 20
SAMPLE, MAX_LISTS, ITERATIONS = 20_000, 2048, 12
#: Recall that the number of probed lists has to reach on the sample.
TARGET, TRIALS = 0.965, 256
EPSILON, COLUMNS = 2.1, 16
#: Candidates and queries of one block, and pairs that are extended by columns at once.
CANDIDATES, QUERIES, PAIRS = 4096, 1024, 200_000
#: While so large a share of a block's pairs is left, its next columns are one matrix product.
DENSE = 0.01


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Rotation, centroids (both of the lengthened, rotated space) and the number of lists to probe."""

    def __init__(self, sample: np.ndarray, norm: float, rows: int):
        rng = np.random.default_rng(5)
        width = sample.shape[1] + 1
        self.norm = norm
        self.rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
        x = self.base(sample)
        lists = int(min(MAX_LISTS, max(1, round(rows ** 0.5)), len(x)))
        centre = x[np.sort(rng.permutation(len(x))[:lists])].copy()
        for _ in range(ITERATIONS):
            at = self.nearest(x, centre)
            sums = np.zeros_like(centre)
            np.add.at(sums, at, x)
            n = np.bincount(at, minlength=lists)
            centre[n > 0] = sums[n > 0] / n[n > 0, None]
        self.centre = centre
        self.probes = self.tune(sample, x, rng)

    @staticmethod
    def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
        half = 0.5 * (centre ** 2).sum(axis=1)
        return np.concatenate([np.argmax(x[i:i + 4096] @ centre.T - half, axis=1) for i in range(0, len(x), 4096)])

    def base(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x ** 2).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]]) @ self.rotation

    def query(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.rotation

    def order(self, q: np.ndarray) -> np.ndarray:
        """Lists from the nearest to the farthest of each query."""
        return np.argsort(0.5 * (self.centre ** 2).sum(axis=1) - self.query(q) @ self.centre.T, axis=1, kind="stable")

    def tune(self, sample: np.ndarray, x: np.ndarray, rng) -> int:
        pick = rng.permutation(len(sample))[:TRIALS]
        score = sample[pick] @ sample.T
        score[np.arange(len(pick)), pick] = -np.inf
        k = min(K, len(sample) - 1)
        if k < 1:
            return 1
        top = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order, at = self.order(sample[pick]), self.nearest(x, self.centre)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :].repeat(len(pick), 0), axis=1)
        found = np.bincount(np.take_along_axis(rank, at[top], axis=1).ravel(), minlength=len(self.centre))
        return int(np.searchsorted(np.cumsum(found) / found.sum(), TARGET) + 1)


def scan(index: Index, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, bound: np.ndarray,
         k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of what can be among the ``k`` nearest; ``bound`` is each query's k-th distance so far."""
    xr, qr, width = index.base(x), index.query(q), x.shape[1] + 1
    edges = [*range(0, width, COLUMNS), width]
    cut = bound.copy()
    n = min(len(x), 4 * k)
    if n >= k:  # a bound from the block's first candidates, for queries that have none
        first = ((qr ** 2).sum(axis=1)[:, None] + (xr[:n] ** 2).sum(axis=1)[None, :] - 2 * qr @ xr[:n].T)
        first[qids[:, None] == ids[None, :n]] = np.inf
        if n > k:
            cut = np.minimum(cut, np.partition(first, k - 1, axis=1)[:, k - 1])
    limit = lambda d: cut * (d / width) * (1 + EPSILON / d ** 0.5) ** 2 if d < width else cut
    slack = 1e-9 * (1 + index.norm ** 2)
    rows, cols = np.arange(len(q)), np.arange(len(x))
    part, alive = np.zeros((len(q), len(x))), qids[:, None] != ids[None, :]
    at = 0
    # a block of columns at a time over what any query still needs, while that is dense
    while at < width and alive.any() and (at == 0 or alive.mean() >= DENSE):
        lo, hi = at, edges[edges.index(at) + 1]
        a, b = qr[rows, lo:hi], xr[cols, lo:hi]
        part += (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * a @ b.T
        alive &= part <= limit(hi)[rows][:, None] + slack
        on_q, on_x = alive.any(axis=1), alive.any(axis=0)
        if on_q.mean() * on_x.mean() < 0.8:
            rows, cols, part, alive = rows[on_q], cols[on_x], part[np.ix_(on_q, on_x)], alive[np.ix_(on_q, on_x)]
        at = hi
    a, b = np.nonzero(alive)
    far, a, b, kept = part[a, b], rows[a], cols[b], []
    for first in range(0, len(a), PAIRS):
        i, j, s = a[first:first + PAIRS], b[first:first + PAIRS], far[first:first + PAIRS]
        for lo, hi in zip(edges, edges[1:]):  # the few pairs left, one by one
            if lo >= at:
                s = s + ((qr[i, lo:hi] - xr[j, lo:hi]) ** 2).sum(axis=1)
                on = s <= limit(hi)[i] + slack
                i, j, s = i[on], j[on], s[on]
        kept.append((i, j, (q[i] * x[j]).sum(axis=1)))
    i, j, score = (np.concatenate([c[f] for c in kept]) if kept else np.zeros(0, int) for f in range(3))
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    near = place < k
    return qids[i[near]], ids[j[near]], score[near]


def _blocks(index: common.Shared, k: int) -> Callable:
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        candidates, queries = candidates.sort_values("vec_id"), queries.sort_values("query_id")
        found = scan(index.value, candidates["vec_id"].to_numpy(), np.stack(candidates["vector"].to_list()).astype(float),
                     queries["query_id"].to_numpy(), np.stack(queries["vector"].to_list()).astype(float), queries["bound"].to_numpy(), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))
    return run


def _search(base: DataFrame, probes: DataFrame, lists: DataFrame, index: common.Shared, k: int) -> DataFrame:
    """The best of each (query, block): base (list, vec_id, vector), probes (list, query_id, vector, bound)."""
    n = probes.groupBy("list").agg(F.count(F.lit(1)).alias("_q"))
    sizes = F.broadcast(lists.join(n, "list"))  # a row per list
    pieces = lambda size, per: F.greatest(F.ceil(F.col(size) / per), F.lit(1)).cast("int")
    place = lambda key, size, per: F.pmod(F.xxhash64(key), pieces(size, per)).cast("int")
    every = lambda size, per: F.explode(F.sequence(F.lit(0), pieces(size, per) - 1))
    left = (base.join(sizes, "list").withColumn("c", place("vec_id", "_n", CANDIDATES))
            .select("list", "c", every("_q", QUERIES).alias("b"), "vec_id", "vector"))
    right = (probes.join(sizes, "list").withColumn("b", place("query_id", "_q", QUERIES))
             .select("list", every("_n", CANDIDATES).alias("c"), "b", "query_id", "vector", "bound"))
    keys = ["list", "c", "b"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_blocks(index, k), "query_id long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row of ``vectors`` (vec_id, embedding) that ``is_query`` marks."""
    spark = vectors.sparkSession
    common.prepare(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = (vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector")))
    width = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == width["w"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = common.written(rows, "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, norm = rows.agg(F.count(F.lit(1)), F.sqrt(F.max(square))).first()
    thin = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 20)) < 1.5 * SAMPLE / count * (1 << 20)
    sample = rows.where(thin).orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(SAMPLE).toArrow().column("vector").to_pylist()
    index = common.Shared(spark, Index(np.array(sample, dtype=float), float(norm), count))

    @F.arrow_udf(T.IntegerType())
    def list_of(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
        return pa.array(index.value.nearest(index.value.base(x), index.value.centre).astype(np.int32))

    copies = Window.partitionBy("vector").orderBy("vec_id")
    base = rows.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1)
    base = common.written(base.select("vec_id", "vector", list_of("vector").alias("list")), "lists")
    lists = base.groupBy("list").agg(F.count(F.lit(1)).alias("_n"))
    sizes = dict(map(tuple, lists.collect()))  # MAX_LISTS rows at most
    held = np.array([sizes.get(i, 0) for i in range(len(index.value.centre))])

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def probed(column: pa.Array) -> pa.Array:
        out = []
        x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
        for order in index.value.order(x):
            enough = int(np.searchsorted(np.cumsum(held[order]), k + 1)) + 1
            out.append(order[:max(index.value.probes, enough)].astype(np.int32))
        return pa.array(out, type=pa.list_(pa.int32()))

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector", probed("vector").alias("_probed"))
    probes = queries.select("query_id", "vector", F.posexplode("_probed").alias("step", "list"))
    probes = common.written(probes, "probes")
    nearest = probes.where("step = 0").withColumn("bound", F.lit(float("inf")))
    first = common.written(_search(base, nearest, lists, index, k), "nearest")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("_r", F.row_number().over(last)).where(F.col("_r") == k).select("query_id", F.col("score").alias("_s"))
    # the distance that belongs to an inner product: |q|^2 + M^2 - 2 q x
    distance = square + F.lit(float(norm) ** 2) - 2 * F.col("_s")
    others = (probes.where("step > 0").join(kth, "query_id", "left")
              .withColumn("bound", F.coalesce(distance, F.lit(float("inf")))))
    found = first.unionByName(_search(base, others, lists, index, k))
    ranked = found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20."""
    vectors = common.read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, F.pmod("vec_id", F.lit(20)) == 0)
