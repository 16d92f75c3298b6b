"""Cross-source entity grouping (J7) feeding the group merge (A3).

Stages, each on records not yet grouped:
1. rule: records with the same token signature in the same category;
2. fuzzy: every record still alone links to its best token-set-ratio partner
   among the other names of its category (one edge per record, never all
   pairs), kept when the score reaches the threshold; with ``links="all"`` every
   pair of names of a category from the threshold on is linked (``similar_names``);
then connected components over the name graph, until nothing changes.  A name
without signature tokens has no stage-1 edge, and blank names stay alone.
3. cosine (with an ``encoder``): every record without an edge so far links to the
   nearest other name of its category, from the threshold on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as TX
from ..session import cut_lineage, written
from . import fuzzy, vector
from .components import connected_components
from .encoder import Encoder
from .joins import MAX_SHARED_BYTES, frame_bytes, spread
from .similar_names import similar_links


def _names(records: DataFrame, name_col: str, category_col: str) -> DataFrame:
    """Different (cat, name) of the records with their rows ``n``; each is normalised and cut into tokens once."""
    names = records.groupBy(F.coalesce(F.col(category_col), F.lit("")).alias("cat"), F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return written(names.select("cat", "name", "n", TX.fuzzy_normalize(F.col("name")).alias("proc"),
                                F.array_join(F.array_sort(TX.token_signature(F.col("name"))), " ").alias("sig")), "names")


def _name_nodes(names: DataFrame) -> DataFrame:
    nodes = names.groupBy("cat", "proc").agg(F.min("sig").alias("sig"), F.sum("n").alias("n_rows"))
    return cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))


def _fuzzy_edges_join(nodes: DataFrame, singles: DataFrame, threshold: float) -> DataFrame:
    """Beyond the broadcast bound: the blocked fuzzy scan (bounded blocks,
    no pair rows), best partner per record excluding itself."""
    pool = nodes.select(F.col("cat").alias("key"), F.col("proc").alias("choice"), F.lit(0).cast("long").alias("o1"),
                        F.col("node").alias("o2"), F.col("node").alias("product_id"),
                        F.col("proc").alias("canonical_name"), F.col("cat").alias("pcat"))
    q = singles.select(F.col("cat").alias("qcat"), F.col("proc").alias("qproc"), "node")
    best = fuzzy.best_blocked(q.select("qcat", "qproc"), pool, "bigint", exclude_self=True)
    return (q.join(best, ["qcat", "qproc"]).where(F.col("raw_score") >= threshold)
             .select(F.col("node").alias("src"), F.col("best_product_id").alias("dst"),
                     F.col("raw_score").alias("score")))


def _fuzzy_edges(nodes: DataFrame, singles: DataFrame, threshold: float, max_pool_bytes: int,
                 plan: str = "auto") -> DataFrame:
    pool_rows = nodes.select("cat", "proc", "node")
    if plan == "join" or frame_bytes(pool_rows) > max_pool_bytes:
        return _fuzzy_edges_join(nodes, singles, threshold)
    spark = nodes.sparkSession
    rows = [r.asDict() for r in pool_rows.collect()]
    pools = fuzzy._prepare_pool([{"key": r["cat"], "choice": r["proc"], "o1": 0, "o2": r["node"],
                                  "product_id": r["node"], "canonical_name": r["proc"], "pcat": r["cat"]}
                                 for r in rows])
    pos = {(k, row[1]): i for k, pl in pools.items() for i, row in enumerate(pl["rows"])}
    bc = spark.sparkContext.broadcast((pools, pos))

    def run(batches):
        import pandas as pd
        pl, where = bc.value
        for b in batches:
            out = []
            for cat, proc, node in zip(b["cat"], b["proc"], b["node"]):
                pool = pl.get(cat)
                s, i = fuzzy.best_in_pool(proc, pool, exclude=where.get((cat, proc)))
                if i is not None and s >= threshold:
                    out.append((int(node), int(pool["rows"][i][0]), float(s)))
            yield pd.DataFrame(out, columns=["src", "dst", "score"])

    return spread(singles.select("cat", "proc", "node"), "proc").mapInPandas(
        run, "src long, dst long, score double")


def _group_nodes(nodes: DataFrame, fuzzy_threshold: float = K.CATALOG_BUILD_FUZZY_THRESHOLD,
                 max_pool_bytes: int = MAX_SHARED_BYTES, plan: str = "auto", encoder: Encoder | None = None,
                 vector_threshold: float = K.CATALOG_BUILD_VECTOR_THRESHOLD, links: str = "best") -> DataFrame:
    """``nodes`` (cat, proc, sig, n_rows, node) with group_node, the smallest node of the group."""
    # stage 1: one edge per node to the first node of its signature group
    rep = (nodes.where("sig <> ''").groupBy("cat", "sig")
                .agg(F.min("node").alias("rep"), F.sum("n_rows").alias("sig_rows")))
    n1 = nodes.join(rep, ["cat", "sig"], "left")
    e1 = n1.where(F.col("node") != F.col("rep")).select(F.col("node").alias("a"), F.col("rep").alias("b"))
    # stage 2: named records still alone after stage 1
    alone = F.coalesce(F.col("sig_rows"), F.col("n_rows")) == 1
    singles = n1.where(alone & (F.col("proc") != "")).select("cat", "proc", "node")
    named = nodes.where(F.col("proc") != "")
    if links == "all":
        e2 = similar_links(named.select(F.col("cat").alias("key"), "node", F.col("proc").alias("name")), fuzzy_threshold)
    else:
        e2 = _fuzzy_edges(named, singles, fuzzy_threshold, max_pool_bytes, plan).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    edges = e1.unionByName(e2)
    if encoder is not None:
        edges = cut_lineage(edges)
        linked = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        vectors = encoder(named.select(F.col("node").alias("id"), F.col("cat").alias("category"), F.col("proc").alias("text")))
        near = vector.best_others(vectors.select("id", "category", "embedding"), vector_threshold)
        edges = edges.unionByName(near.join(linked, near["a"] == linked["node"], "left_anti"))
    found = connected_components(edges)
    return nodes.join(found, "node", "left").select(
        "cat", "proc", "n_rows", "node", F.coalesce("component", "node").alias("group_node"))


def entity_groups(records: DataFrame, name_col: str = "product_name_clean", category_col: str = "category", **options) -> DataFrame:
    """(cat, proc, node, group_node) per name node; records join on (cat, proc). ``options`` are of ``_group_nodes``."""
    return _group_nodes(_name_nodes(_names(records, name_col, category_col)), **options).drop("n_rows")


def grouped_records(records: DataFrame, name_col: str = "product_name_clean", category_col: str = "category",
                    **kw) -> DataFrame:
    """(group_id, row_id) for records in groups of two or more (A3 input); blank names group with nothing.

    Groups are sized by their names' rows, and records find theirs by their unchanged name."""
    names = _names(records, name_col, category_col)
    g = _group_nodes(_name_nodes(names), **kw).where(F.col("proc") != "")
    sizes = g.groupBy("group_node").agg(F.sum("n_rows").alias("n_group")).where(F.col("n_group") > 1)
    groups = names.join(g.join(sizes, "group_node"), ["cat", "proc"]).select(
        "cat", "name", F.concat(F.lit("g"), F.col("group_node").cast("string")).alias("group_id"))
    rows = records.select("row_id", F.coalesce(F.col(category_col), F.lit("")).alias("cat"), F.col(name_col).alias("name"))
    return rows.join(groups, ["cat", "name"]).select("group_id", "row_id")
