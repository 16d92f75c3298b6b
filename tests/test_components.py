import random

from pricefold.operators.components import connected_components


def components(spark, edges):
    return {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}


def test_long_chain_is_one_component(spark):
    order = list(range(500))
    random.Random(1).shuffle(order)
    got = components(spark, list(zip(order, order[1:])))
    assert set(got) == set(order) and set(got.values()) == {0}


def test_stars_loops_repeats_and_nulls(spark):
    edges = [(9, k) for k in range(10, 200)] + [(5, 6), (6, 5), (6, 5), (7, 7), (None, 3), (3, None), (300, 301), (301, 9)]
    got = components(spark, edges)
    assert got == {**{k: 9 for k in [9, *range(10, 200), 300, 301]}, 5: 5, 6: 5, 7: 7}


def test_no_edges(spark):
    assert components(spark, []) == {}
