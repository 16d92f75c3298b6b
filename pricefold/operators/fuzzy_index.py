"""Best token-set-ratio choice by an inverted index with a proven bound (J3 for pools of any size).

A query is *settled* when its best candidate's score is above what any choice that was not looked at
could have; only the other queries need a scan of their category. All lengths are in characters, ``L`` is
that of a name's different tokens joined by blanks. A choice scores the largest of three ratios (and 100
where one side's tokens are all in the other), so each needs a bound:

* ``r3 = 2 I / (2 I + 1 + rest of the choice)``, ``I`` the joined length of the shared tokens: every choice
  is indexed by its rarest tokens, so many that the others alone can't reach ``LEAST``. A query that
  looks up all its tokens sees every choice whose r3 is at least that.
* ``r2``, the same with the rest of the query: the query looks up its rarest tokens, so many that the
  others alone stay below the score it has.
* ``r1 = 1 - d / (L + L')``, ``d`` the insertions and deletions between the two names: take the different
  padded trigrams of the query's tokens. A deletion spoils three of them at most, an insertion two. If
  ``n`` trigrams were looked up and a choice has none of them, ``3 del + 2 ins >= n``; with
  ``ins - del = L' - L`` and ``d >= |L' - L|`` this gives ``r1 <= 1 - n / (6 L - n)``. So a query that
  scores ``s`` looks up its rarest trigrams until that is below ``s``: one for 100, 0.29 L for 95.

Posting lists longer than ``hot`` are never joined; a query that needs one is left open. Everything up to
the scoring of candidate pairs is joins on (category, token or trigram) and aggregates per query.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Scores below this are never settled; it bounds r3 of choices that were not looked at.
LEAST = 80.0
#: Longest posting list of a token or trigram that is joined, and rarest tokens that find first candidates.
HOT, SEEDS = 500, 2
#: Scores are doubles of a few operations each; bounds must be below them by more than their error.
MARGIN = 1e-6


def name_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"\s+"), lambda t: t != ""))


def name_grams(tokens: Column) -> Column:
    """The different trigrams of tokens with two blanks before each, so a token has as many as characters."""
    return F.array_distinct(F.flatten(F.transform(tokens, lambda t: F.transform(
        F.sequence(F.lit(1), F.length(t)), lambda i: F.substring(F.concat(F.lit("  "), t), i, 3)))))


def _ratio(shared: int, rest: int) -> float:
    """r2 or r3 in percent for the joined lengths of the shared tokens and of the others of one side."""
    return 200 * shared / (2 * shared + 1 + rest) if shared and rest else 100.0 * (rest == 0)


def _joined(tokens: list[str]) -> int:
    return sum(map(len, tokens)) + max(0, len(tokens) - 1)


def rarest_needed(tokens: list[str], score: float) -> int:
    """How many leading ``tokens`` (rarest first) it takes until the others alone give a ratio below ``score``."""
    for n in range(1, len(tokens)):
        if _ratio(_joined(tokens[n:]), _joined(tokens[:n])) < score - MARGIN:
            return n
    return len(tokens)


def grams_needed(length: int, score: float) -> int:
    """The least n with ``100 (1 - n / (6 length - n)) < score``; a name may have fewer, then it stays open."""
    miss = 1 - (score - MARGIN) / 100
    return int(6 * length * miss / (1 + miss)) + 1


def _counted(rows: DataFrame, df: DataFrame, *keys: str) -> DataFrame:
    """Per ``keys`` the array ``items`` of (df, item); unknown items have a df of 0."""
    return rows.join(df, ["key", "item"], "left").groupBy(*keys) \
               .agg(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "item")).alias("items"))


def best_indexed(q: DataFrame, ch: DataFrame, id_type: str, hot: int = HOT) -> DataFrame:
    """Each query's best choice of those looked at, and whether it is settled: then it is the best of all.

    q: (qcat, qproc), different; ch: ``choices()`` rows. Returns qcat, qproc, raw_score, best_product_id,
    best_canonical_name, best_category, settled; queries without a candidate are missing.
    """
    from .fuzzy import token_set_ratio
    names = cut_lineage(ch.withColumn("tokens", name_tokens(F.col("choice"))))
    asked = cut_lineage(q.select(F.col("qcat").alias("key"), "qproc").withColumn("tokens", name_tokens(F.col("qproc"))))
    by_token = names.select("key", "choice", F.explode("tokens").alias("item"))
    df = by_token.groupBy("key", "item").agg(F.count(F.lit(1)).alias("df"))
    df = cut_lineage(df)
    query_tokens = cut_lineage(_counted(asked.select("key", "qproc", F.explode("tokens").alias("item")), df, "key", "qproc"))

    # first candidates: choices by their own rarest tokens, and by the query's rarest ones
    @F.pandas_udf("array<string>")
    def driving(items: pd.Series) -> pd.Series:
        ranked = [[t for _, t in sorted((r["df"], r["item"]) for r in row)] for row in items]
        return pd.Series([r[:rarest_needed(r, LEAST)] for r in ranked], dtype="object")
    index = _counted(by_token, df, "key", "choice").select("key", "choice", F.explode(driving("items")).alias("item"))
    index = cut_lineage(index)
    posted = index.groupBy("key", "item").agg(F.count(F.lit(1)).alias("n"))
    each = query_tokens.select("key", "qproc", F.explode("items.item").alias("item")).join(posted, ["key", "item"])
    blocked = each.where(F.col("n") > hot).select("key", "qproc").distinct()
    rarest = F.slice(F.filter(F.array_sort("items"), lambda r: (r["df"] > 0) & (r["df"] <= hot)), 1, SEEDS)
    seeds = query_tokens.select("key", "qproc", F.explode(rarest["item"]).alias("item")).join(by_token, ["key", "item"])
    first = each.where(F.col("n") <= hot).join(index, ["key", "item"]).select("key", "qproc", "choice")
    first = first.unionByName(seeds.select("key", "qproc", "choice")).distinct()

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], dtype="float64")
    first = cut_lineage(first.withColumn("score", score("qproc", "choice")))
    reached = first.groupBy("key", "qproc").agg(F.max("score").alias("score")).where(F.col("score") >= LEAST + MARGIN)

    # what a query of that score has to look up before nothing unseen can be as good
    @F.pandas_udf("array<string>")
    def tokens_for(items: pd.Series, reached: pd.Series) -> pd.Series:
        out = []
        for row, s in zip(items, reached):
            ranked = sorted((r["df"], r["item"]) for r in row)
            ranked = ranked[:rarest_needed([t for _, t in ranked], s)]
            out.append([t for n, t in ranked if n] if all(n <= hot for n, _ in ranked) else None)
        return pd.Series(out, dtype="object")

    @F.pandas_udf("array<string>")
    def grams_for(items: pd.Series, length: pd.Series, reached: pd.Series) -> pd.Series:
        out = []
        for row, size, s in zip(items, length, reached):
            n = grams_needed(int(size), s)
            ranked = sorted((r["df"], r["item"]) for r in row)[:n]
            out.append([g for m, g in ranked if m] if len(ranked) == n and ranked[-1][0] <= hot else None)
        return pd.Series(out, dtype="object")
    length = F.aggregate("tokens", F.lit(-1), lambda n, t: n + 1 + F.length(t))
    open_ = reached.join(blocked, ["key", "qproc"], "left_anti").join(asked, ["key", "qproc"])
    wanted = open_.select("key", "qproc", "score", length.alias("length"), name_grams(F.col("tokens")).alias("grams"))
    by_gram = cut_lineage(names.select("key", "choice", F.explode(name_grams(F.col("tokens"))).alias("item")))
    gram_df = by_gram.groupBy("key", "item").agg(F.count(F.lit(1)).alias("df"))
    grams = _counted(wanted.select("key", "qproc", F.explode("grams").alias("item")), gram_df, "key", "qproc").withColumnRenamed("items", "gram_items")
    plan = wanted.select("key", "qproc", "score", "length").join(query_tokens, ["key", "qproc"]).join(grams, ["key", "qproc"])
    plan = plan.select("key", "qproc", tokens_for("items", "score").alias("t"), grams_for("gram_items", "length", "score").alias("g"))
    plan = cut_lineage(plan.where("t is not null and g is not null"))
    more = plan.select("key", "qproc", F.explode("t").alias("item")).join(by_token, ["key", "item"]).select("key", "qproc", "choice")
    more = more.unionByName(plan.select("key", "qproc", F.explode("g").alias("item")).join(by_gram, ["key", "item"]).select("key", "qproc", "choice"))
    more = more.distinct().join(first.select("key", "qproc", "choice"), ["key", "qproc", "choice"], "left_anti")
    pairs = first.unionByName(more.withColumn("score", score("qproc", "choice")))

    product = names.select("key", "choice", "o1", "o2", "product_id", "canonical_name", "pcat")
    best = F.max(F.struct("score", (-F.col("o1")).alias("n1"), (-F.col("o2")).alias("n2"), "product_id", "canonical_name", "pcat"))
    found = pairs.join(product, ["key", "choice"]).groupBy("key", "qproc").agg(best.alias("b"))
    done = plan.select("key", "qproc", F.lit(True).alias("_done"))
    return found.join(done, ["key", "qproc"], "left").select(
        F.col("key").alias("qcat"), "qproc", F.col("b.score").alias("raw_score"), F.col("b.product_id").cast(id_type).alias("best_product_id"),
        F.col("b.canonical_name").alias("best_canonical_name"), F.col("b.pcat").alias("best_category"), F.coalesce("_done", F.lit(False)).alias("settled"))
