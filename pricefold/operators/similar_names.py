"""All pairs of names with a token-set ratio from a threshold on, as links for components.

A self-join with the bounds of ``fuzzy_index`` at a fixed threshold, over each category's different names:

* a pair whose ratio comes from shared tokens (r2 or r3) shares one of the rarest tokens of that side,
  so many that its others alone can't reach the threshold: each name's *leading* tokens meet all tokens;
* a pair whose ratio comes from the characters (r1) shares one of the rarest trigrams of either side, so
  many that having none of them puts r1 below the threshold: each name's leading trigrams meet all
  trigrams of names of admissible length. A name with too few trigrams, or one of whose leading trigrams
  is very frequent, is *open*; open names meet each other in blocks, others find them by their own.

Components need no pair inside of them: first each (leading) posting is compared with its first member;
what then is one component is not compared any further, so a large group of variants costs its size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import connected_components
from .fuzzy_index import _counted, grams_needed, name_grams, name_tokens, rarest_needed

#: Longest posting list of a leading trigram, and names of a block of open names.
HOT_GRAM, OPEN_BLOCK = 2000, 500


def _scored(pairs: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    from .fuzzy import token_set_ratio

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(x, y) >= threshold for x, y in zip(a, b)], dtype=bool)
    a, b = (names.select(F.col("node").alias(x), F.col("name").alias(f"_{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").where(near("_a", "_b")).select("a", "b")


def _with_comps(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = connected_components(links).select("node", F.col("component").alias("_c"))
    return cut_lineage(nodes.join(found, "node", "left").select("node", F.coalesce("_c", "node").alias("comp")))


def _open_blocks(names: DataFrame, threshold: float) -> DataFrame:
    """Links that connect what is connected among ``names`` (key, node, name): blocks meet blocks of their key,
    and a pair of blocks gives no more links than it has names."""
    from .fuzzy import token_set_ratio
    n = names.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / OPEN_BLOCK).alias("blocks"))
    rows = names.join(n, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "name").distinct()

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        nodes, texts, blocks = group["node"].to_numpy(), group["name"].to_list(), group["block"].to_numpy()
        comp, found = np.arange(len(nodes)), []
        lone = blocks.min() == blocks.max() and group["i"].iat[0] != group["j"].iat[0]
        for x in range(len(nodes) if not lone else 0):
            for y in range(x + 1, len(nodes)):
                if comp[x] != comp[y] and token_set_ratio(texts[x], texts[y]) >= threshold:
                    comp[comp == comp[y]] = comp[x]
                    found.append((nodes[x], nodes[y]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return rows.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")


def similar_links(names: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of the nodes of ``names`` (key, node, name) whose components are those of all pairs within a
    key with a token-set ratio of at least ``threshold`` (50 to 100). Names without a token have no link."""
    threshold = float(threshold)
    rows = names.select("key", "node", "name").withColumn("tokens", name_tokens(F.col("name"))).where("size(tokens) > 0")
    rows = cut_lineage(rows.withColumn("length", F.aggregate("tokens", F.lit(-1), lambda n, t: n + 1 + F.length(t))))
    by_token = cut_lineage(rows.select("key", "node", F.explode("tokens").alias("item")))
    by_gram = cut_lineage(rows.select("key", "node", "length", F.explode(name_grams(F.col("tokens"))).alias("item")))
    token_df, gram_df = (cut_lineage(t.groupBy("key", "item").agg(F.count(F.lit(1)).alias("df"))) for t in (by_token, by_gram))

    @F.pandas_udf("array<string>")
    def leading_tokens(items: pd.Series) -> pd.Series:
        ranked = [sorted((r["df"], r["item"]) for r in row) for row in items]
        return pd.Series([[t for n, t in r[:rarest_needed([t for _, t in r], threshold)] if n > 1] for r in ranked], dtype="object")

    @F.pandas_udf("array<string>")
    def leading_grams(items: pd.Series, length: pd.Series) -> pd.Series:
        out = []
        for row, size in zip(items, length):
            n = grams_needed(int(size), threshold)
            ranked = sorted((r["df"], r["item"]) for r in row)[:n]
            out.append([g for m, g in ranked if m > 1] if len(ranked) == n and ranked[-1][0] <= HOT_GRAM else None)
        return pd.Series(out, dtype="object")
    tokens = _counted(by_token, token_df, "key", "node").select("key", "node", F.explode(leading_tokens("items")).alias("item"))
    tokens = cut_lineage(tokens)
    grams = cut_lineage(_counted(by_gram.drop("length"), gram_df, "key", "node").join(rows.select("node", "length"), "node")
                        .select("key", "node", "length", leading_grams("items", "length").alias("g")))
    lead_grams = grams.where("g is not null").select("key", "node", "length", F.explode("g").alias("item"))

    # every posting's members with its first one: stars of what is alike
    def stars(lead: DataFrame, every: DataFrame) -> DataFrame:
        first = every.join(lead.select("key", "item").distinct(), ["key", "item"]).groupBy("key", "item").agg(F.min("node").alias("a"))
        return every.join(first, ["key", "item"]).where("a <> node").select("a", F.col("node").alias("b"))
    pairs = stars(tokens, by_token).unionByName(stars(lead_grams, by_gram.drop("length"))).distinct()
    links = cut_lineage(_scored(pairs, rows, threshold))
    comps = _with_comps(rows.select("node"), links)

    # what is left between components
    def between(lead: DataFrame, every: DataFrame, fits: Column) -> DataFrame:
        a = lead.join(comps, "node").select("key", "item", F.col("node").alias("a"), F.col("comp").alias("_ca"), *([F.col("length").alias("_la")] if "length" in lead.columns else []))
        b = every.join(comps, "node").select("key", "item", F.col("node").alias("b"), F.col("comp").alias("_cb"), *([F.col("length").alias("_lb")] if "length" in every.columns else []))
        return a.join(b, ["key", "item"]).where((F.col("_ca") != F.col("_cb")) & fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # r1 is at most twice the shorter length over both
    fits = 200 * F.least("_la", "_lb") >= threshold * (F.col("_la") + F.col("_lb"))
    pairs = between(tokens, by_token, F.lit(True)).unionByName(between(lead_grams, by_gram, fits)).distinct()
    links = links.unionByName(cut_lineage(_scored(pairs, rows, threshold)))
    left = grams.where("g is null").join(rows.select("node", "name"), "node").select("key", "node", "name")
    return links.unionByName(_open_blocks(left, threshold))
