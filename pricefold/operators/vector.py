"""Cosine matching of unit vectors (J4) and the embedding-cache increment.

Vectors are unit length, so cosine = dot product.  Best product per query
within its category, first in catalog order on ties, accept >= threshold.  A
query without a category is matched against the whole catalog; one whose
category has no vectors has no candidates.

Plans (all exact):
* ``broadcast``: the catalog matrix per category is broadcast while its
  measured bytes are within a bound; each Arrow batch of queries is scored by
  matrix products of bounded size;
* ``pruned`` (any size): only blocks that may hold a better vector by the
  triangle inequality on angles are visited (``vector_pruned``);
* ``join`` (any size): block nested loop - catalog chunks x query salts per
  category meet in bounded ``cogroup.applyInPandas`` tasks, no pair rows;
  partial-aggregable ``max(struct)`` across chunks.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as TX
from ..session import cut_lineage, written
from . import embedding_store, quality
from .encoder import Encoder
from .joins import spread
from .latent import latent_ngrams
from .matching import POOL_KEY
from .vector_pruned import best_pruned

#: Bytes of the catalog's vectors up to which they are broadcast, and of one product of a block.
MAX_MATRIX_BYTES = 64 << 20
PRODUCT_BYTES = 32 << 20


def best_rows(q: np.ndarray, mat: np.ndarray, not_same: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First best row of ``mat`` per query and its score, by products of bounded size.

    ``not_same`` (ids of the queries, ids of the rows) leaves out rows with the query's own id."""
    rows = max(1, PRODUCT_BYTES // (8 * max(1, len(mat))))
    at, score = np.zeros(len(q), dtype=np.int64), np.zeros(len(q))
    for i in range(0, len(q), rows):
        sims = q[i:i + rows] @ mat.T
        if not_same is not None:
            sims[not_same[0][i:i + rows, None] == not_same[1][None, :]] = -np.inf
        at[i:i + rows] = sims.argmax(axis=1)
        score[i:i + rows] = sims[np.arange(len(sims)), at[i:i + rows]]
    return at, score


DEFAULT_BLOCK = 10_000


def _blocks(df: DataFrame, col: str, size: int, name: str) -> DataFrame:
    n = df.groupBy("category").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(float(size))))
                                   .cast("long").alias("_nb"))
    return df.join(n, "category").withColumn(name, F.pmod(F.xxhash64(F.col(col)), F.col("_nb"))).drop("_nb")


def _best_join(queries: DataFrame, catalog: DataFrame, id_type: str, qid_type: str,
               block: int = DEFAULT_BLOCK, exclude_self: bool = False) -> DataFrame:
    """Block nested loop for catalogs beyond the broadcast bound: catalog
    vectors hash-chunked per category, queries hash-salted per category;
    each (category, chunk, salt) block is one matmul in a
    ``cogroup.applyInPandas`` task (bounded memory, no pair rows); the best
    across chunks is a partial-aggregable ``max(struct(score, -ord, id))``."""
    qb = _blocks(queries.select("query_id", "category", "embedding"), "query_id", block, "salt")
    cb = _blocks(catalog.select("product_id", "category", "ord", "embedding"), "product_id", block, "chunk")
    chunks = cb.select(F.concat("category", F.lit("")).alias("category"), (F.col("chunk") + 0).alias("chunk")).distinct()
    salts = qb.select(F.concat("category", F.lit("")).alias("category"), (F.col("salt") + 0).alias("salt")).distinct()
    left = qb.join(chunks, "category")
    right = cb.join(salts, "category")
    cols = ["query_id", "score", "ord", "product_id"]

    def run(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame(columns=cols)
        cs = cs.sort_values("ord", kind="stable")
        mat = np.vstack(cs["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_list())
        q = np.vstack(qs["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_list())
        ids = (qs["query_id"].to_numpy(), cs["product_id"].to_numpy()) if exclude_self else None
        j, score = best_rows(q, mat, ids)       # first maximum = catalog order within the chunk
        return pd.DataFrame({"query_id": qs["query_id"].to_numpy(), "score": score,
                             "ord": cs["ord"].to_numpy()[j], "product_id": cs["product_id"].to_numpy()[j]})

    schema = f"query_id {qid_type}, score double, ord long, product_id {id_type}"
    per_chunk = (left.groupBy("category", "chunk", "salt")
                     .cogroup(right.groupBy("category", "chunk", "salt"))
                     .applyInPandas(run, schema))
    best = F.max(F.struct("score", (-F.col("ord")).alias("nord"), "product_id"))
    return per_chunk.groupBy("query_id").agg(best.alias("b")).select(
        "query_id", F.col("b.score").alias("best_score"), F.col("b.product_id").alias("best_product_id"))


def _best_broadcast(queries: DataFrame, catalog: DataFrame, id_type: str, qid_type: str) -> DataFrame:
    spark = queries.sparkSession
    pdf = catalog.select("category", "product_id", "ord", "embedding").toPandas()
    mats = {}
    for cat, g in pdf.groupby("category", sort=False):
        g = g.sort_values("ord", kind="stable")
        mats[cat] = (np.vstack(g["embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_list()),
                     g["product_id"].to_numpy())
    bc = spark.sparkContext.broadcast(mats)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = bc.value
        for b in batches:
            out_s = np.full(len(b), np.nan)
            out_p = [None] * len(b)
            for cat, idx in b.groupby("category", sort=False).groups.items():
                entry = m.get(cat)
                if entry is None:
                    continue
                mat, pids = entry
                q = np.vstack(b.loc[idx, "embedding"].map(lambda v: np.asarray(v, dtype=np.float64)).to_list())
                j, score = best_rows(q, mat)   # first maximum = catalog order
                pos = b.index.get_indexer(idx)
                out_s[pos] = score
                for p, jj in zip(pos, j):
                    out_p[p] = pids[jj]
            yield pd.DataFrame({"query_id": b["query_id"], "best_score": out_s,
                                "best_product_id": pd.Series(out_p, dtype="object")})

    schema = f"query_id {qid_type}, best_score double, best_product_id {id_type}"
    return spread(queries.select("query_id", "category", "embedding"), "query_id").mapInPandas(score, schema)


def with_pool(catalog: DataFrame) -> DataFrame:
    """Catalog vectors keyed by their category and, for queries without one, by the pool key.

    Ties of the pool go by the order of all products, as within a category."""
    cols = catalog.select("product_id", F.coalesce("category", F.lit(POOL_KEY)).alias("category"), "ord", "embedding")
    return cols.where(F.col("category") != POOL_KEY).unionByName(cols.withColumn("category", F.lit(POOL_KEY)))


def match_vectors(queries: DataFrame, catalog: DataFrame, threshold: float = K.VECTOR_THRESHOLD,
                  plan: str = "auto", max_bytes: int = MAX_MATRIX_BYTES, block: int = DEFAULT_BLOCK) -> DataFrame:
    """queries(query_id, category, embedding), catalog(product_id, category, ord,
    embedding) -> (query_id, product_id, match_score, match_method)."""
    queries = queries.withColumn("category", F.coalesce("category", F.lit(POOL_KEY)))
    pool = with_pool(catalog)
    if plan == "auto":
        # what the matrix takes in memory: 8 bytes a number, some more a row
        size = pool.agg(F.sum(F.size("embedding") * 8 + 200)).first()[0] or 0
        plan = "broadcast" if size <= max_bytes else "pruned"
    id_type, qid_type = (df.schema[c].dataType.simpleString() for df, c in ((catalog, "product_id"), (queries, "query_id")))
    if plan == "broadcast":
        best = _best_broadcast(queries, pool, id_type, qid_type)
    elif plan == "pruned":
        best, _ = best_pruned(queries, pool)
    else:
        best = _best_join(queries, pool, id_type, qid_type, block)
    r = queries.select("query_id").join(best, "query_id", "left")
    ok = F.col("best_score") >= F.lit(threshold)
    none = F.col("best_score").isNull() | F.isnan("best_score")
    return r.select("query_id",
                    F.when(ok & ~none, F.col("best_product_id")).alias("product_id"),
                    F.when(none, F.lit(0.0)).otherwise(F.col("best_score")).alias("match_score"),
                    F.when(none, F.lit("no_candidates")).when(ok, F.lit("cosine_similarity"))
                     .otherwise(F.lit("below_threshold")).alias("match_method"))


def best_others(vectors: DataFrame, threshold: float, block: int = DEFAULT_BLOCK) -> DataFrame:
    """(a, b): each row of ``vectors`` (id, category, embedding) and its nearest other row of the category, from ``threshold`` on."""
    q = vectors.select(F.col("id").alias("query_id"), "category", "embedding")
    # new columns of the same values, so that the two sides can be told apart
    c = vectors.select(F.col("id").alias("product_id"), F.concat("category", F.lit("")).alias("category"), F.col("id").alias("ord"),
                       F.transform("embedding", lambda x: x).alias("embedding"))
    kind = vectors.schema["id"].dataType.simpleString()
    best = _best_join(q, c, kind, kind, block, exclude_self=True)
    return best.where((F.col("best_score") >= threshold) & (F.col("best_score") < float("inf"))) \
               .select(F.col("query_id").alias("a"), F.col("best_product_id").alias("b"))


def representatives(catalog: DataFrame) -> DataFrame:
    """The first product of each (category, name), numbered by category and name."""
    first = (catalog.groupBy("category", "canonical_name").agg(F.min(F.struct("ord", "product_id")).alias("b"))
                    .select(F.col("b.product_id").alias("product_id"), "canonical_name", "category"))
    # the order is a sort key, not a number: any type that compares will do
    return first.withColumn("ord", F.struct(F.coalesce("category", F.lit("")).alias("c"), F.col("canonical_name").alias("n")))


#: Another draw of products than the labelled test set's, for fitting a threshold.
FIT_SEED = K.TEST_SET_SEED + 1


def fit_threshold(catalog: DataFrame, encoder: Encoder, n: int = K.TEST_SET_PER_CATEGORY) -> float:
    """The threshold of best F1 (A11, in steps of 0.01) for an encoder's scores.

    Cases are drawn from the catalog: name variants of products, against products asked for where they
    aren't sold and names that miss a product by a word. A variant whose best product is another one counts
    as a negative. Without a case the published threshold stands."""
    pos = quality.build_test_set(catalog, n, FIT_SEED).where("test_type <> 'accessory'").select("query", "category", "expected_product_id")
    neg = quality.wrong_category_cases(catalog, n).unionByName(quality.near_miss_cases(catalog, n, FIT_SEED))
    cases = pos.unionByName(neg.withColumn("expected_product_id", F.lit(None).cast("string")))
    scored = match_listings(cases, catalog, -1.0, encoder, name_col="query")
    right = F.coalesce(F.col("product_id").cast("string") == F.col("expected_product_id"), F.lit(False))
    sweep = quality.threshold_sweep(scored.select(right.alias("is_positive"), (F.col("match_score") * 100).alias("raw_score")), range(30, 100))
    best = sweep.where("is_best and tp > 0").first()
    return best["threshold"] / 100 if best else K.VECTOR_THRESHOLD


def match_listings(listings: DataFrame, catalog: DataFrame, threshold: float | None = None,
                   encoder: Encoder | None = None, name_col: str = "product_name_clean",
                   category_col: str = "category", plan: str = "auto", store: str | None = None,
                   encoder_version: str | None = None) -> DataFrame:
    """Listings with their MatchResult columns by the vector matcher.

    Accessories are filtered first; the rest is stripped of noise words, encoded
    (each different name once) and matched within its category, or against the
    whole catalog without one.  Without an ``encoder`` one is learned from the
    catalog and, unless given, the threshold fitted to it; with one, the
    published threshold is the default.  With a ``store`` (a folder, J9) the
    catalog's vectors are kept there and only what changed is encoded; that
    takes an ``encoder`` and its ``encoder_version``."""
    if store and not (encoder and encoder_version):
        raise ValueError("a store takes an encoder and its version")
    reps = representatives(catalog)
    names = reps.withColumn("text", F.col("canonical_name"))
    if encoder is None:
        encoder = latent_ngrams(names)
        threshold = fit_threshold(catalog, encoder) if threshold is None else threshold
    threshold = K.VECTOR_THRESHOLD if threshold is None else threshold
    order = reps.select("product_id", "canonical_name", "category", "ord")
    # a dense number keeps the sort order of (category, name) for the scoring kernels
    numbered = order.orderBy("ord").select("product_id", F.monotonically_increasing_id().alias("_ord"))
    if store:
        embedding_store.sync(store, names.select("product_id", "text"), encoder, encoder_version)
        kept = embedding_store.read(names.sparkSession, store).select("product_id", "embedding")
        vectors = names.select("product_id", "category").join(kept, "product_id")
    else:
        vectors = encoder(names).select("product_id", "category", "embedding")
    vectors = vectors.join(numbered, "product_id").withColumnRenamed("_ord", "ord")
    key = [F.coalesce(F.col(name_col), F.lit("")).alias("_name"), F.coalesce(F.col(category_col), F.lit("")).alias("_cat")]
    distinct = cut_lineage(listings.select(*key).distinct()).withColumn("_acc", TX.is_accessory(F.lower("_name")))
    query = F.concat_ws("\u0001", "_cat", "_name")
    texts = distinct.where("not _acc").select(query.alias("query_id"), F.col("_cat").alias("category"),
                                              TX.encoder_text(F.col("_name"), F.col("_cat")).alias("text"))
    found = match_vectors(encoder(texts).select("query_id", "category", "embedding"), vectors, threshold, plan)
    product = reps.select(F.col("product_id").alias("_pid"), "canonical_name", F.col("category").alias("product_category"))
    found = found.join(product, F.col("product_id") == F.col("_pid"), "left").drop("_pid")
    # of a known size: where it is small, the listings needn't be shuffled to meet it
    found = written(found, "matches")
    keyed = listings.select("*", *key).withColumn("query_id", query)
    out = keyed.join(found, "query_id", "left")
    accessory = F.col("match_method").isNull()
    return out.select(*listings.columns, "product_id", "canonical_name", "product_category",
                      F.when(accessory, F.lit(0.0)).otherwise(F.col("match_score")).alias("match_score"),
                      F.when(accessory, F.lit("accessory_filter")).otherwise(F.col("match_method")).alias("match_method"))


def embedding_increment(current: DataFrame, stored: DataFrame, keys=("product_id", "canonical_name")) -> DataFrame:
    """Catalog rows whose (id, name) has no stored embedding; only these
    are sent to the encoder.  ``left_anti`` equi-join, no full recompute."""
    return current.join(stored.select(*keys).distinct(), list(keys), "left_anti")
