"""Catalog matching by token overlap.

score(q, p) = |tokens(q) ∩ sig(p)| / |sig(p)|; the best product per query wins,
ties go to the first product in catalog order; accept at >= threshold.

Plan shape:
* queries are the DISTINCT (lower(name), category) pairs of the listings; the
  result is joined back, so repeated listings are scored once;
* the accessory test (JVM regex) runs before any scoring;
* listings without a category are matched against all categories, in the
  catalog's category order (first appearance), then catalog order;
* scoring is exact in both plans:
  - ``broadcast``: the catalog's inverted index is broadcast (only when its
    size is within a measured bound) and each Arrow batch of queries is
    scored over the postings of its tokens;
  - ``join``: an equi-join of exploded query tokens with exploded catalog
    signatures on (category key, token), pair dedupe, overlap by
    ``array_intersect`` and a partial-aggregable ``max(struct)`` argmax;
* ``prefix`` is exact for accepted rows: only the rarest tokens of a signature
  have postings, so many that no product reaches the threshold without one.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import text as TX
from ..session import cut_lineage
from .joins import MAX_SHARED_BYTES, frame_bytes, spread

POOL_KEY = ""          # category key of listings without a category
MATCH_COLUMNS = ["product_id", "canonical_name", "product_category", "match_score", "match_method"]


def query_key(name_col: str = "product_name_clean", category_col: str = "category"):
    return (F.lower(F.coalesce(F.col(name_col), F.lit(""))).alias("qname"),
            F.coalesce(F.col(category_col), F.lit("")).alias("qcat"))


def indexed_catalog(catalog: DataFrame) -> DataFrame:
    """Catalog rows keyed twice: by their category and by the pool key.

    ``cat_first`` (the first catalog position of the category) + ``ord``
    give the pooled order; within one category it reduces to ``ord``.
    Products with an empty signature are skipped; among products with the
    same (key, signature) only the first can ever win, so only it is kept.
    """
    # of equal names in a category the first product stands for all, so a name is cut into tokens once
    named = catalog.groupBy("category", "canonical_name").agg(F.min(F.struct("ord", "product_id")).alias("f"))
    c = (named.select("f.product_id", "canonical_name", "category", "f.ord")
              .withColumn("sig", F.array_sort(TX.token_signature(F.col("canonical_name"))))
              .where(F.size("sig") > 0))
    # a product without a category is found through the pool only
    first = catalog.groupBy(F.col("category").alias("_c")).agg(F.min("ord").alias("cat_first"))
    c = c.join(first, F.col("category").eqNullSafe(F.col("_c"))).drop("_c")
    own = c.where(F.coalesce("category", F.lit(POOL_KEY)) != POOL_KEY)
    idx = own.withColumn("key", F.col("category")).unionByName(c.withColumn("key", F.lit(POOL_KEY)))
    best = F.min(F.struct("cat_first", "ord", "product_id", "canonical_name", "category"))
    return (idx.groupBy("key", "sig").agg(best.alias("b"))
               .select("key", "sig", F.size("sig").alias("sig_size"), "b.cat_first", "b.ord",
                       "b.product_id", "b.canonical_name", "b.category"))


def _distinct_queries(listings: DataFrame, name_col: str, category_col: str,
                      accessory_text=None, intended_display_part: bool = False) -> DataFrame:
    q = listings.select(*query_key(name_col, category_col)).distinct()
    acc_on = accessory_text if accessory_text is not None else F.col("qname")
    return q.withColumn("is_accessory", TX.is_accessory(acc_on, intended_display_part))


# --------------------------------------------------------------- join plan
DEFAULT_HOT_POSTINGS = 128


def _score_join(q: DataFrame, idx: DataFrame, hot_postings: int = DEFAULT_HOT_POSTINGS) -> DataFrame:
    """Exact argmax without enumerating pairs through hot tokens.

    A token whose posting list in a category key is longer than
    ``hot_postings`` is *hot*.  Candidate pairs come from the equi-join on
    cold tokens only; their score uses the full signatures, so shared hot
    tokens still count.  Products that share only hot tokens with a query
    are covered by hot profiles: products grouped by (hot-token subset,
    signature size) score alike against a query's hot tokens, so the first
    one in catalog order stands for the group.  A representative that also
    shares cold tokens appears in both branches and the larger (true) score
    wins, so the overall argmax is exact.
    """
    # the distinct queries are used in several branches: computed once, known by a number from here on
    q = cut_lineage(q.select("qname", "qcat").withColumn("qid", F.monotonically_increasing_id()))
    qx = q.select("qid", "qcat", F.explode(TX.token_signature(F.col("qname"))).alias("token"))
    ix = idx.select(F.col("key").alias("qcat"), "product_id", F.explode("sig").alias("token"))
    product = idx.select(F.col("key").alias("qcat"), "product_id", "sig_size", "cat_first", "ord")
    hot = ix.groupBy("qcat", "token").count().where(F.col("count") > hot_postings).select("qcat", "token")
    pairs = (qx.join(ix.join(hot, ["qcat", "token"], "left_anti"), ["qcat", "token"])
               .groupBy("qid", "qcat", "product_id").agg(F.count(F.lit(1)).alias("n_cold")))
    qhot = (qx.join(hot, ["qcat", "token"], "left_semi")
              .groupBy("qid", "qcat").agg(F.array_sort(F.collect_set("token")).alias("hq")))
    phot = (ix.join(hot, ["qcat", "token"], "left_semi")
              .groupBy("qcat", "product_id").agg(F.array_sort(F.collect_set("token")).alias("hot_sig")))
    shared_hot = F.coalesce(F.size(F.array_intersect("hq", "hot_sig")), F.lit(0))
    cold = (pairs.join(product, ["qcat", "product_id"]).join(qhot, ["qid", "qcat"], "left")
                 .join(phot, ["qcat", "product_id"], "left")
                 .select("qid", "qcat", ((F.col("n_cold") + F.greatest(shared_hot, F.lit(0))) / F.col("sig_size")).alias("score"),
                         "cat_first", "ord", "product_id"))
    # hot profiles
    prof = (phot.join(product, ["qcat", "product_id"]).groupBy("qcat", "hot_sig", "sig_size")
                .agg(F.min(F.struct("cat_first", "ord", "product_id")).alias("rep")))
    hq = qhot.select("qcat", "hq").distinct()
    hits = (hq.select("qcat", "hq", F.explode("hq").alias("token"))
              .join(prof.select("qcat", "hot_sig", "sig_size", "rep", F.explode("hot_sig").alias("token")),
                    ["qcat", "token"])
              .groupBy("qcat", "hq", "hot_sig", "sig_size")
              .agg(F.count(F.lit(1)).alias("n"), F.first("rep").alias("rep")))
    best = F.max(F.struct("score", (-F.col("cat_first")).alias("ncf"), (-F.col("ord")).alias("nord"), "product_id"))
    hot_best = (hits.select("qcat", "hq", (F.col("n") / F.col("sig_size")).alias("score"), "rep.cat_first", "rep.ord", "rep.product_id")
                    .groupBy("qcat", "hq").agg(best.alias("b")))
    hot_scored = qhot.join(hot_best, ["qcat", "hq"]).select(
        "qid", "qcat", "b.score", (-F.col("b.ncf")).alias("cat_first"), (-F.col("b.nord")).alias("ord"), "b.product_id")
    top = cold.unionByName(hot_scored).groupBy("qid", "qcat").agg(best.alias("b")).select("qid", "qcat", "b.score", "b.product_id")
    names = idx.select(F.col("key").alias("qcat"), "product_id", F.col("canonical_name").alias("best_canonical_name"),
                       F.col("category").alias("best_category"))
    return (q.join(top, ["qid", "qcat"]).join(names, ["qcat", "product_id"])
             .select("qname", "qcat", F.col("score").alias("best_score"), F.col("product_id").alias("best_product_id"),
                     "best_canonical_name", "best_category"))


# ------------------------------------------------------------- prefix plan
def prefix_postings(idx: DataFrame, threshold: float) -> DataFrame:
    """key, token, product_id: the ``n - ceil(t n) + 1`` rarest of a signature's ``n`` tokens, by their frequency
    in the key. A query that shares ``t n`` tokens with the product shares one of these."""
    ix = idx.select("key", "product_id", F.explode("sig").alias("token"))
    df = ix.groupBy("key", "token").agg(F.count(F.lit(1)).alias("df"))
    ranked = ix.join(df, ["key", "token"]).groupBy("key", "product_id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("r"))
    n = F.size("r")
    # the score is a division of doubles: a hair more postings, never one too few
    lead = n - F.greatest(F.lit(1), F.ceil(n * F.lit(float(threshold)) - F.lit(1e-9))) + 1
    return ranked.select("key", "product_id", F.explode(F.slice("r", F.lit(1), F.greatest(lead, F.lit(1)).cast("int"))["token"]).alias("token"))


def _score_prefix(q: DataFrame, idx: DataFrame, threshold: float) -> DataFrame:
    """Best product of each query among those that reach the threshold."""
    q = cut_lineage(q.select("qname", "qcat", TX.token_signature(F.col("qname")).alias("toks")).withColumn("qid", F.monotonically_increasing_id()))
    lead = prefix_postings(idx, threshold).withColumnRenamed("key", "qcat")
    pairs = q.select("qid", "qcat", F.explode("toks").alias("token")).join(lead, ["qcat", "token"]).select("qid", "qcat", "product_id").distinct()
    product = idx.select(F.col("key").alias("qcat"), "product_id", "sig", "sig_size", "cat_first", "ord")
    score = F.size(F.array_intersect("toks", "sig")) / F.col("sig_size")
    scored = pairs.join(product, ["qcat", "product_id"]).join(q.select("qid", "toks"), "qid").withColumn("score", score).where(F.col("score") >= F.lit(threshold))
    best = F.max(F.struct("score", (-F.col("cat_first")).alias("ncf"), (-F.col("ord")).alias("nord"), "product_id"))
    top = scored.groupBy("qid", "qcat").agg(best.alias("b")).select("qid", "qcat", "b.score", "b.product_id")
    names = idx.select(F.col("key").alias("qcat"), "product_id", F.col("canonical_name").alias("best_canonical_name"),
                       F.col("category").alias("best_category"))
    return (q.select("qid", "qname", "qcat").join(top, ["qid", "qcat"]).join(names, ["qcat", "product_id"])
             .select("qname", "qcat", F.col("score").alias("best_score"), F.col("product_id").alias("best_product_id"),
                     "best_canonical_name", "best_category"))


# ---------------------------------------------------------- broadcast plan
def _build_index(rows: pd.DataFrame) -> dict:
    out = {}
    for key, g in rows.groupby("key", sort=False):
        g = g.sort_values(["cat_first", "ord"], kind="stable").reset_index(drop=True)
        postings: dict[str, list[int]] = {}
        for i, sig in enumerate(g["sig"]):
            for t in sig:
                postings.setdefault(t, []).append(i)
        out[key] = (
            {t: np.asarray(v, dtype=np.int64) for t, v in postings.items()},
            g["sig_size"].to_numpy(dtype=np.float64),
            g["product_id"].to_numpy(),
            g["canonical_name"].to_numpy(),
            g["category"].to_numpy(),
        )
    return out


def _final_broadcast(q: DataFrame, idx: DataFrame, threshold: float, id_type: str) -> DataFrame:
    """Broadcast plan for distinct queries: the scorer emits the final
    MatchResult columns (accessory rows skip scoring), no join back."""
    spark = q.sparkSession
    bc = spark.sparkContext.broadcast(_build_index(idx.toPandas()))
    schema = (f"qname string, qcat string, product_id {id_type}, canonical_name string, "
              "product_category string, match_score double, match_method string")

    def run(batches):
        index = bc.value
        memo: dict = {}
        for b in batches:
            res = _score_rows(index, b["qcat"], b["_qt"], memo)
            acc = b["is_accessory"].to_numpy(dtype=bool)
            score = np.array([r[0] for r in res], dtype=np.float64)
            ok = ~acc & (score >= threshold) & np.array([r[1] is not None for r in res])
            yield pd.DataFrame({
                "qname": b["qname"], "qcat": b["qcat"],
                "product_id": pd.Series([r[1] if o else None for r, o in zip(res, ok)], dtype="object"),
                "canonical_name": [r[2] if o else None for r, o in zip(res, ok)],
                "product_category": [r[3] if o else None for r, o in zip(res, ok)],
                "match_score": np.where(acc, 0.0, score),
                "match_method": np.where(acc, "accessory_filter",
                                         np.where(ok, "token_overlap", "below_threshold"))})

    x = spread(q, "qname").withColumn("_qt", F.when(~F.col("is_accessory"), TX.token_signature(F.col("qname"))))
    return x.mapInPandas(run, schema)


def match_queries(listings: DataFrame, catalog: DataFrame, threshold: float = K.RULE_THRESHOLD,
                  name_col: str = "product_name_clean", category_col: str = "category",
                  plan: str = "auto", max_index_bytes: int = MAX_SHARED_BYTES,
                  intended_display_part: bool = False,
                  hot_postings: int = DEFAULT_HOT_POSTINGS) -> DataFrame:
    """One result row per distinct (qname, qcat): MatchResult columns.

    With ``plan="prefix"`` only rows that reach the threshold are scored: the others' ``match_score`` is 0."""
    q = _distinct_queries(listings, name_col, category_col,
                          intended_display_part=intended_display_part)
    idx = cut_lineage(indexed_catalog(catalog))
    if plan == "auto":
        plan = "broadcast" if frame_bytes(idx) <= max_index_bytes else "join"
    id_type = catalog.schema["product_id"].dataType.simpleString()
    if plan == "broadcast":
        return _final_broadcast(q, idx, threshold, id_type)
    cand = q.where(~F.col("is_accessory")).select("qname", "qcat")
    best = _score_prefix(cand, idx, threshold) if plan == "prefix" else _score_join(cand, idx, hot_postings)
    r = q.join(best, ["qname", "qcat"], "left")
    s = F.coalesce(F.col("best_score"), F.lit(0.0))
    ok = ~F.col("is_accessory") & (s >= F.lit(threshold)) & F.col("best_product_id").isNotNull()
    return r.select(
        "qname", "qcat",
        F.when(ok, F.col("best_product_id")).alias("product_id"),
        F.when(ok, F.col("best_canonical_name")).alias("canonical_name"),
        F.when(ok, F.col("best_category")).alias("product_category"),
        F.when(F.col("is_accessory"), F.lit(0.0)).otherwise(s).alias("match_score"),
        F.when(F.col("is_accessory"), F.lit("accessory_filter"))
         .when(ok, F.lit("token_overlap")).otherwise(F.lit("below_threshold")).alias("match_method"))


def attach(listings: DataFrame, matches: DataFrame, name_col: str = "product_name_clean",
           category_col: str = "category") -> DataFrame:
    """Every listing gets its query's result (left equi-join on the query key)."""
    keyed = listings.select("*", *query_key(name_col, category_col))
    return keyed.join(matches, ["qname", "qcat"], "left").drop("qname", "qcat")


#: Different token sets that a task remembers the result of.
MEMO_ROWS = 100_000
NO_HIT = (0.0, None, None, None)
TOKENS = re.compile(K.TOKEN_PATTERN)


def _best_hit(entry: tuple, toks: tuple) -> tuple:
    """Best (score, product_id, canonical_name, category) of a category key's entry for the tokens, all of which
    have postings."""
    postings, sizes, pids, names, pcats = entry
    at = np.concatenate([postings[t] for t in toks])
    # only products that share a token; the first best in catalog order
    if len(sizes) <= 8 * len(at):
        shared = np.bincount(at, minlength=len(sizes))
        j = int(np.argmax(shared / sizes))
        score = shared[j] / sizes[j]
    else:
        at, shared = np.unique(at, return_counts=True)
        scores = shared / sizes[at]
        k = int(np.argmax(scores))
        j, score = int(at[k]), scores[k]
    return float(score), pids[j], names[j], pcats[j]


def _hit(index: dict, cat, toks, memo: dict) -> tuple:
    """The best product of a query's different tokens. Those that no product of the category key has don't count,
    so queries that share the others are scored once in a task."""
    entry = index.get(cat)
    if entry is None or toks is None:
        return NO_HIT
    key = (cat, tuple(sorted(t for t in toks if t in entry[0])))
    if not key[1]:
        return NO_HIT
    hit = memo.get(key)
    if hit is None:
        hit = _best_hit(entry, key[1])
        if len(memo) >= MEMO_ROWS:
            memo.clear()
        memo[key] = hit
    return hit


def _score_rows(index: dict, cats, toks_list, memo: dict):
    """Best (score, product_id, canonical_name, category) per row."""
    return [_hit(index, cat, toks, memo) for cat, toks in zip(cats, toks_list)]


def _score_names(index: dict, cats: pd.Series, names: pd.Series, memo: dict) -> pd.DataFrame:
    """score, product_id, canonical_name and pcat per row: each different (category key, lower-cased name) of a
    batch is looked up once."""
    cat, _ = pd.factorize(cats)
    name, found = pd.factorize(names)
    _, first, at = np.unique(cat * (len(found) + 1) + name, return_index=True, return_inverse=True)
    hits = [_hit(index, c, set(TOKENS.findall(n)), memo) for c, n in zip(cats.iloc[first], names.iloc[first])]
    out = pd.DataFrame({"score": [h[0] for h in hits], "product_id": pd.Series([h[1] for h in hits], dtype="object"),
                        "canonical_name": pd.Series([h[2] for h in hits], dtype="object"),
                        "pcat": pd.Series([h[3] for h in hits], dtype="object")})
    return out.iloc[at].reset_index(drop=True)


def _attach_broadcast(listings: DataFrame, idx: DataFrame, threshold: float, id_type: str,
                      name_col: str, category_col: str, intended_display_part: bool) -> DataFrame:
    """Map-side matching: a scalar Arrow UDF scores each listing row against
    the broadcast index.  Only the category key and the lower-cased name cross
    into Python; Spark keeps the other columns and zips the result back, so
    there is no shuffle and no join.  A per-task memo serves repeated names."""
    spark = listings.sparkSession
    bc = spark.sparkContext.broadcast(_build_index(idx.toPandas()))
    out_type = T.StructType([T.StructField("score", T.DoubleType()),
                             T.StructField("product_id", T._parse_datatype_string(id_type)),
                             T.StructField("canonical_name", T.StringType()),
                             T.StructField("pcat", T.StringType())])
    memo: dict = {}

    @F.pandas_udf(out_type)
    def best_product(cats: pd.Series, names: pd.Series) -> pd.DataFrame:
        return _score_names(bc.value, cats, names, memo)

    qname, qcat = query_key(name_col, category_col)
    acc = TX.is_accessory(qname, intended_display_part)
    x = listings.withColumn("_acc", acc).withColumn(
        "_m", best_product(qcat, F.when(F.col("_acc"), F.lit("")).otherwise(qname)))
    s = F.coalesce(F.col("_m.score"), F.lit(0.0))
    ok = ~F.col("_acc") & (s >= F.lit(threshold)) & F.col("_m.product_id").isNotNull()
    return x.select(
        *listings.columns,
        F.when(ok, F.col("_m.product_id")).alias("product_id"),
        F.when(ok, F.col("_m.canonical_name")).alias("canonical_name"),
        F.when(ok, F.col("_m.pcat")).alias("product_category"),
        F.when(F.col("_acc"), F.lit(0.0)).otherwise(s).alias("match_score"),
        F.when(F.col("_acc"), F.lit("accessory_filter")).when(ok, F.lit("token_overlap"))
         .otherwise(F.lit("below_threshold")).alias("match_method"))


def match_rule(listings: DataFrame, catalog: DataFrame, threshold: float = K.RULE_THRESHOLD,
               plan: str = "auto", name_col: str = "product_name_clean", category_col: str = "category",
               max_index_bytes: int = MAX_SHARED_BYTES, intended_display_part: bool = False) -> DataFrame:
    """Listings with their MatchResult columns.

    ``broadcast`` plan (index within ``max_index_bytes``): map-side scoring of
    every row, no shuffle.  ``join`` plan: distinct queries scored by the
    inverted-index join, then joined back to the listings."""
    idx = cut_lineage(indexed_catalog(catalog))
    if plan == "auto":
        plan = "broadcast" if frame_bytes(idx) <= max_index_bytes else "join"
    if plan == "broadcast":
        return _attach_broadcast(listings, idx, threshold,
                                 catalog.schema["product_id"].dataType.simpleString(),
                                 name_col, category_col, intended_display_part)
    m = match_queries(listings, catalog, threshold, name_col, category_col, plan="join",
                      intended_display_part=intended_display_part)
    return attach(listings, m, name_col, category_col)


def matched_only(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("product_id").isNotNull())
