"""Fuzzy catalog matching by token-set ratio (J3, W4) and threshold tuning.

token_set_ratio(a, b) on whitespace tokens A, B (published definition):
* either side empty -> 0; I = A ∩ B, with ``ab`` / ``ba`` the sorted joins of
  A \\ B and B \\ A; I non-empty and one difference empty -> 100;
* r1 = 100 - 100 * indel(ab, ba) / (|I+ab| + |I+ba|) (shared prefix cancels),
  and when I is non-empty r2 / r3 from lengths only:
  100 - 100 * (1 + |ab|) / (|I| + |I+ab|) and the same with ``ba``;
* result = max of those.

Plans (both exact): distinct processed queries against the category's
deduplicated choices.  ``broadcast`` (pool within a measured bound): one
scan per query with numpy postings (first subset candidate = 100, LCS only
where the bound reaches the running best).  ``index`` (any pool size):
candidates from an inverted index; a query whose best candidate is above the
bound of all others is done (``fuzzy_index``), the rest goes to ``join``: block
nested loop - pool chunks x query salts meet in ``cogroup.applyInPandas``
tasks of bounded size; no pair rows are emitted; the best across chunks is
a partial-aggregable ``max(struct)``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import text as TX
from ..session import cut_lineage, written
from .fuzzy_index import best_indexed
from .joins import MAX_SHARED_BYTES, frame_bytes, spread
from .matching import POOL_KEY


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence length, bit-parallel over Python ints."""
    if not a or not b:
        return 0
    if len(b) > len(a):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    s = full
    for ch in a:
        u = s & masks.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return len(b) - bin(s).count("1")


def token_set_ratio(s1: str, s2: str) -> float:
    """Reference implementation in plain Python (used by tests and the UDF)."""
    if not s1 or not s2:
        return 0.0
    a, b = set(s1.split()), set(s2.split())
    if not a or not b:
        return 0.0
    inter = a & b
    dab, dba = a - b, b - a
    if inter and (not dab or not dba):
        return 100.0
    ab, ba = " ".join(sorted(dab)), " ".join(sorted(dba))
    sect = len(" ".join(inter))
    sab = sect + (sect != 0) + len(ab)
    sba = sect + (sect != 0) + len(ba)
    lensum = sab + sba
    dist = len(ab) + len(ba) - 2 * lcs_length(ab, ba)
    result = 100 - 100 * dist / lensum if lensum else 100.0
    if not sect:
        return float(result)
    r2 = 100 - 100 * ((sect != 0) + len(ab)) / (sect + sab)
    r3 = 100 - 100 * ((sect != 0) + len(ba)) / (sect + sba)
    return float(max(result, r2, r3))


def choices(catalog: DataFrame) -> DataFrame:
    """Per category, the first product (catalog order) of each processed
    name; plus the pooled list for queries without a category: ordered by
    first appearance, holding the product of the LAST category that has the
    name (the reference builds it as a dict merge)."""
    c = catalog.select("product_id", "canonical_name", "category", "ord",
                       TX.fuzzy_normalize(F.col("canonical_name")).alias("choice"))
    first = catalog.groupBy(F.col("category").alias("_c")).agg(F.min("ord").alias("cat_first"))
    c = c.join(first, F.col("category").eqNullSafe(F.col("_c"))).drop("_c")
    per_cat = (c.groupBy("category", "choice")
                .agg(F.min(F.struct("ord", "product_id", "canonical_name")).alias("b"), F.min("cat_first").alias("cf"))
                .select(F.col("category").alias("key"), "choice", F.col("cf").alias("o1"),
                        F.col("b.ord").alias("o2"), F.col("b.product_id").alias("product_id"),
                        F.col("b.canonical_name").alias("canonical_name"), F.col("category").alias("pcat")))
    pooled = (per_cat.groupBy("choice")
                     .agg(F.min(F.struct("o1", "o2")).alias("pos"),
                          F.max(F.struct("o1", "product_id", "canonical_name", "pcat")).alias("last"))
                     .select(F.lit(POOL_KEY).alias("key"), "choice", F.col("pos.o1").alias("o1"),
                             F.col("pos.o2").alias("o2"), F.col("last.product_id").alias("product_id"),
                             F.col("last.canonical_name").alias("canonical_name"),
                             F.col("last.pcat").alias("pcat")))
    # a product without a category is found through the pool only
    return per_cat.where(F.coalesce("key", F.lit(POOL_KEY)) != POOL_KEY).unionByName(pooled)


def _prepare_pool(rows) -> dict:
    """Per category key: ordered choices with an inverted index over tokens."""
    by_key: dict = {}
    for r in sorted(rows, key=lambda r: (r["key"], r["o1"], r["o2"])):
        by_key.setdefault(r["key"], []).append(r)
    pools = {}
    for key, rs in by_key.items():
        sets = [frozenset(r["choice"].split()) for r in rs]
        postings: dict = {}
        for i, ts in enumerate(sets):
            for t in ts:
                postings.setdefault(t, []).append(i)
        pools[key] = {
            "sets": sets,
            "sizes": np.array([len(x) for x in sets], dtype=np.int64),
            "lens": np.array([sum(len(t) for t in x) for x in sets], dtype=np.int64),
            "post": {t: np.asarray(v, dtype=np.int64) for t, v in postings.items()},
            "rows": [(r["product_id"], r["canonical_name"], r["pcat"]) for r in rs],
        }
    return pools


def best_in_pool(q: str, pool: dict, exclude: int | None = None):
    """Exact first-maximum of token_set_ratio over an ordered pool.

    Intersection sizes / lengths for every candidate come from the postings
    (numpy ``bincount``); the first subset candidate answers 100 at once (no
    other candidate can reach 100); otherwise LCS runs only for candidates,
    in decreasing upper-bound order, whose bound reaches the running best.
    Returns (score, index or None)."""
    n = len(pool["sets"]) if pool else 0
    if n == 0:
        return 0.0, None
    qa = frozenset(q.split()) if q else frozenset()
    if not qa:
        return 0.0, 0
    sizes, lens = pool["sizes"], pool["lens"]
    if exclude is not None and n == 1:
        return 0.0, None
    hit_idx = [pool["post"][t] for t in qa if t in pool["post"]]
    if hit_idx:
        idx = np.concatenate(hit_idx)
        w = np.concatenate([np.full(len(pool["post"][t]), len(t), dtype=np.float64)
                            for t in qa if t in pool["post"]])
        hits = np.bincount(idx, minlength=n)
        ilen = np.bincount(idx, weights=w, minlength=n).astype(np.int64)
    else:
        hits = np.zeros(n, dtype=np.int64)
        ilen = np.zeros(n, dtype=np.int64)
    nq, qlen = len(qa), sum(len(t) for t in qa)
    na, nb = nq - hits, sizes - hits
    empty = sizes == 0
    if exclude is not None:
        empty = empty.copy()
        empty[exclude] = True
    subset = (hits > 0) & ((na == 0) | (nb == 0)) & ~empty
    if subset.any():
        return 100.0, int(np.argmax(subset))
    sect = np.where(hits > 0, ilen + hits - 1, 0)
    la = np.where(na > 0, qlen - ilen + na - 1, 0)
    lb = np.where(nb > 0, lens - ilen + nb - 1, 0)
    has = (sect > 0).astype(np.int64)
    sab, sba = sect + has + la, sect + has + lb
    lensum = sab + sba
    with np.errstate(divide="ignore", invalid="ignore"):
        r2 = np.where(sect > 0, 100 - 100 * (has + la) / (sect + sab), 0.0)
        r3 = np.where(sect > 0, 100 - 100 * (has + lb) / (sect + sba), 0.0)
        r1_ub = np.where(lensum > 0, 100 - 100 * np.abs(la - lb) / lensum, 100.0)
        r1_lb = np.where(lensum > 0, 100 - 100 * (la + lb) / lensum, 100.0)
    base = np.maximum(r2, r3)
    known = np.where(empty, 0.0, np.maximum(base, r1_lb))
    ub = np.where(empty, 0.0, np.maximum(base, r1_ub))
    best = known.max()
    need = np.nonzero(~empty & (r1_ub > base) & (r1_ub > r1_lb) & (ub >= best))[0]
    scores = known.copy()
    for i in need[np.argsort(-ub[need], kind="stable")]:
        if ub[i] < best:
            break
        cb = pool["sets"][i]
        ab = " ".join(sorted(qa - cb))
        ba = " ".join(sorted(cb - qa))
        d = int(la[i] + lb[i]) - 2 * lcs_length(ab, ba)
        r1 = 100 - 100 * d / int(lensum[i])
        scores[i] = max(float(base[i]), r1)
        best = max(best, scores[i])
    if exclude is not None:
        scores[exclude] = -1.0
    j = int(np.argmax(scores))
    return float(max(scores[j], 0.0)), j


def _final_broadcast(q: DataFrame, ch: DataFrame, id_type: str, threshold: float) -> DataFrame:
    """Broadcast plan: one pass over the distinct queries emitting the final
    FuzzyMatchResult columns (accessory / no-candidate rows skip scoring)."""
    spark = q.sparkSession
    bc = spark.sparkContext.broadcast(_prepare_pool([r.asDict() for r in ch.collect()]))
    schema = (f"qproc string, qcat string, product_id {id_type}, canonical_name string, "
              "product_category string, match_score double, raw_score double, match_method string")

    def score(batches):
        pools = bc.value
        for b in batches:
            out = []
            for cat, qp, acc in zip(b["qcat"], b["qproc"], b["is_accessory"]):
                pool = pools.get(cat)
                if acc:
                    out.append((qp, cat, None, None, None, 0.0, 0.0, "accessory_filter"))
                    continue
                if pool is None:
                    out.append((qp, cat, None, None, None, 0.0, 0.0, "no_candidates"))
                    continue
                s, i = best_in_pool(qp, pool)
                if i is not None and s >= threshold:
                    c = pool["rows"][i]
                    out.append((qp, cat, c[0], c[1], c[2], s / 100.0, s, "token_set_ratio"))
                else:
                    out.append((qp, cat, None, None, None, s / 100.0, s, "below_threshold"))
            yield pd.DataFrame(out, columns=["qproc", "qcat", "product_id", "canonical_name",
                                             "product_category", "match_score", "raw_score", "match_method"])

    return spread(q.select("qcat", "qproc", "is_accessory"), "qproc").mapInPandas(score, schema)


DEFAULT_POOL_BLOCK = 20_000
DEFAULT_QUERY_BLOCK = 20_000


def _blocks(df: DataFrame, key: str, col: str, size: int, name: str) -> DataFrame:
    """Hash block number per row so that every (key, block) holds about
    ``size`` rows; the per-key counts are a small aggregate."""
    n = df.groupBy(key).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(float(size))))
                            .cast("long").alias("_nb"))
    return (df.join(n, key).withColumn(name, F.pmod(F.xxhash64(F.col(col)), F.col("_nb"))).drop("_nb"))


def best_blocked(q: DataFrame, ch: DataFrame, id_type: str, pool_block: int = DEFAULT_POOL_BLOCK,
                 query_block: int = DEFAULT_QUERY_BLOCK, exclude_self: bool = False) -> DataFrame:
    """Exact best choice per query for pools too large to broadcast.

    Block nested loop on Spark: choices are hash-chunked per category key,
    queries are hash-salted per key; each (key, chunk, salt) block meets in
    one ``cogroup.applyInPandas`` task that scores its queries against its
    chunk with ``best_in_pool``.  Pairs are evaluated but never emitted as
    rows, task memory is bounded by the block sizes, and a hot category is
    spread over its salts.  The best per query across chunks is a
    partial-aggregable ``max(struct(score, -position, ...))``.
    q: (qcat, qproc); ch: choices() rows."""
    qb = _blocks(q.select("qcat", "qproc").withColumnRenamed("qcat", "key"), "key", "qproc", query_block, "salt")
    cb = _blocks(ch, "key", "choice", pool_block, "chunk")
    # fresh expressions (not the original columns) keep the two sides of the
    # cogroup free of shared lineage
    chunks = cb.select(F.concat(F.col("key"), F.lit("")).alias("key"), (F.col("chunk") + 0).alias("chunk")).distinct()
    salts = qb.select(F.concat(F.col("key"), F.lit("")).alias("key"), (F.col("salt") + 0).alias("salt")).distinct()
    left = qb.join(chunks, "key")                      # each query once per chunk of its key
    right = cb.join(salts, "key")                      # each chunk once per query salt of its key
    schema = (f"key string, qproc string, raw_score double, o1 long, o2 long, product_id {id_type}, "
              "canonical_name string, pcat string")

    def run(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame(columns=schema_cols)
        cs = cs.sort_values(["o1", "o2"], kind="stable")
        pool = _prepare_pool(cs.to_dict("records"))[cs["key"].iloc[0]]
        where = {c: i for i, c in enumerate(cs["choice"])} if exclude_self else {}
        out = []
        for qp in qs["qproc"]:
            sc, i = best_in_pool(qp, pool, exclude=where.get(qp))
            if i is None:
                continue
            r = cs.iloc[i]
            out.append((qs["key"].iloc[0], qp, sc, int(r["o1"]), int(r["o2"]), r["product_id"],
                        r["canonical_name"], r["pcat"]))
        return pd.DataFrame(out, columns=schema_cols)

    schema_cols = ["key", "qproc", "raw_score", "o1", "o2", "product_id", "canonical_name", "pcat"]
    per_chunk = (left.groupBy("key", "chunk", "salt")
                     .cogroup(right.select("key", "chunk", "salt", "choice", "o1", "o2", "product_id",
                                           "canonical_name", "pcat").groupBy("key", "chunk", "salt"))
                     .applyInPandas(run, schema))
    best = F.max(F.struct("raw_score", (-F.col("o1")).alias("n1"), (-F.col("o2")).alias("n2"),
                          "product_id", "canonical_name", "pcat"))
    return (per_chunk.groupBy("key", "qproc").agg(best.alias("b"))
                     .select(F.col("key").alias("qcat"), "qproc", F.col("b.raw_score").alias("raw_score"),
                             F.col("b.product_id").alias("best_product_id"),
                             F.col("b.canonical_name").alias("best_canonical_name"),
                             F.col("b.pcat").alias("best_category")))


def match_queries(listings: DataFrame, catalog: DataFrame, threshold: float = K.FUZZY_THRESHOLD,
                  name_col: str = "product_name_clean", category_col: str = "category",
                  plan: str = "auto", max_pool_bytes: int = MAX_SHARED_BYTES,
                  pool_block: int = DEFAULT_POOL_BLOCK, query_block: int = DEFAULT_QUERY_BLOCK) -> DataFrame:
    """One FuzzyMatchResult row per distinct (qproc, qcat)."""
    if threshold is not None and threshold <= 1.0:
        threshold = threshold * 100          # P31: fractions are scaled
    q = (listings.select(TX.fuzzy_normalize(F.col(name_col)).alias("qproc"),
                         F.coalesce(F.col(category_col), F.lit("")).alias("qcat"))
                 .distinct()
                 .withColumn("is_accessory", TX.is_accessory(F.col("qproc"))))
    ch = choices(catalog)
    if plan == "auto":
        plan = "broadcast" if frame_bytes(ch) <= max_pool_bytes else "index"
    if plan == "broadcast":
        return _final_broadcast(q, ch, catalog.schema["product_id"].dataType.simpleString(), float(threshold))
    keys = ch.select(F.col("key").alias("qcat")).distinct().withColumn("has_pool", F.lit(True))
    q = q.join(keys, "qcat", "left")
    cand = q.where(~F.col("is_accessory") & F.col("has_pool").isNotNull())
    id_type = catalog.schema["product_id"].dataType.simpleString()
    if plan == "index":
        done = cut_lineage(best_indexed(cand, ch, id_type).where("settled").drop("settled"))
        cand = cand.join(done.select("qcat", "qproc"), ["qcat", "qproc"], "left_anti")
        b = done.unionByName(best_blocked(cand, ch, id_type, pool_block, query_block))
    else:
        b = best_blocked(cand, ch, id_type, pool_block, query_block)
    r = q.join(b, ["qcat", "qproc"], "left")
    raw = F.coalesce(F.col("raw_score"), F.lit(0.0))
    acc = F.col("is_accessory")
    nocand = F.col("has_pool").isNull()
    ok = ~acc & ~nocand & (raw >= F.lit(float(threshold)))
    return r.select(
        "qproc", "qcat",
        F.when(ok, F.col("best_product_id")).alias("product_id"),
        F.when(ok, F.col("best_canonical_name")).alias("canonical_name"),
        F.when(ok, F.col("best_category")).alias("product_category"),
        F.when(acc | nocand, F.lit(0.0)).otherwise(raw / 100.0).alias("match_score"),
        F.when(acc | nocand, F.lit(0.0)).otherwise(raw).alias("raw_score"),
        F.when(acc, F.lit("accessory_filter")).when(nocand, F.lit("no_candidates"))
         .when(ok, F.lit("token_set_ratio")).otherwise(F.lit("below_threshold")).alias("match_method"))


def attach(listings: DataFrame, matches: DataFrame, name_col: str = "product_name_clean",
           category_col: str = "category") -> DataFrame:
    keyed = listings.select("*", TX.fuzzy_normalize(F.col(name_col)).alias("qproc"),
                            F.coalesce(F.col(category_col), F.lit("")).alias("qcat"))
    return keyed.join(matches, ["qproc", "qcat"], "left").drop("qproc", "qcat")


def match_fuzzy(listings: DataFrame, catalog: DataFrame, threshold: float = K.FUZZY_THRESHOLD,
                plan: str = "auto") -> DataFrame:
    """Listings with the FuzzyMatchResult columns of their names; each different raw name is normalised once."""
    names = cut_lineage(listings.select(F.col("product_name_clean").alias("_name"), F.col("category").alias("_cat")).distinct())
    matches = match_queries(names, catalog, threshold, "_name", "_cat", plan)
    # of a known size: where it is small, the listings needn't be shuffled to meet it
    found = written(attach(names, matches, "_name", "_cat"), "matches")
    same = F.col("product_name_clean").eqNullSafe(F.col("_name")) & F.col("category").eqNullSafe(F.col("_cat"))
    return listings.join(found, same, "left").drop("_name", "_cat")
