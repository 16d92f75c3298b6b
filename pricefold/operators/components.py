"""Connected components by contraction: no round limit, and the rounds are logarithmic in the nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _roots(parents: DataFrame) -> DataFrame:
    """Each node's root in the forest ``node -> parent``, by pointer doubling."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_up"))
        step = parents.join(up, "parent", "left").select(
            "node", F.coalesce("_up", "parent").alias("parent"), (F.col("_up") != F.col("parent")).alias("_moved"))
        step = cut_lineage(step)
        parents = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            return parents


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b).

    Each round links every node to its smallest neighbour, follows those links to their roots and
    keeps the edges between different roots, which at least halves the nodes that have edges left.
    Loops and repeated edges are fine; edges with a null end are left out; no edges give no rows.
    A node with very many edges meets pre-aggregated minima and joins that adaptive execution splits.
    """
    edges = cut_lineage(edges.select("a", "b").where("a is not null and b is not null").distinct())
    result = None
    while True:
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        parents = cut_lineage(parents.select("node", F.least("node", "_least").alias("parent")))
        roots = _roots(parents)
        if result is None:
            result = roots.select("node", F.col("parent").alias("component"))
        else:
            moved = roots.select(F.col("node").alias("component"), F.col("parent").alias("_root"))
            result = cut_lineage(result.join(moved, "component", "left")
                                 .select("node", F.coalesce("_root", "component").alias("component")))
        a = roots.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        b = roots.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        edges = cut_lineage(edges.join(a, "a").join(b, "b").where("_a != _b")
                            .select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
        if edges.isEmpty():
            return result
