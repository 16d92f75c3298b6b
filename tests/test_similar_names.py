"""All pairs above a threshold: components equal those of a comparison of every pair."""

import random

import pytest

from pricefold.operators import entity, similar_names
from pricefold.operators.components import connected_components
from pricefold.operators.fuzzy import token_set_ratio


def brute(rows, threshold):
    """Partition of the nodes of (key, node, name)."""
    comp = {n: n for _, n, _ in rows}

    def root(x):
        while comp[x] != x:
            comp[x] = comp[comp[x]]
            x = comp[x]
        return x
    by = {}
    for k, n, t in rows:
        by.setdefault(k, []).append((n, t))
    for group in by.values():
        for i, (a, x) in enumerate(group):
            for b, y in group[:i]:
                if root(a) != root(b) and token_set_ratio(x, y) >= threshold:
                    comp[root(a)] = root(b)
    out = {}
    for n in comp:
        out.setdefault(root(n), set()).add(n)
    return sorted(map(sorted, out.values()))


def found(spark, rows, threshold):
    df = spark.createDataFrame(rows, "key string, node long, name string")
    out = {n: {n} for _, n, _ in rows}
    for r in connected_components(similar_names.similar_links(df, threshold)).collect():
        out[r["component"]].add(r["node"])
        if r["node"] != r["component"]:
            out.pop(r["node"], None)
    return sorted(map(sorted, out.values()))


def names(rng, n):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(220)]
    base = [" ".join(["brand" + str(rng.randrange(3)), *rng.sample(words, rng.randint(2, 5)), str(rng.randrange(90))]) for _ in range(n // 2)]
    out = list(base)
    while len(out) < n:
        t = rng.choice(out)
        at = rng.randrange(len(t))
        t = rng.choice([t[:at] + rng.choice("xyz") + t[at:], t[:at] + t[at + 1:], t + " " + rng.choice(words), " ".join(t.split()[1:])])
        out.append(" ".join(t.split()) or "x")
    return out


def test_components_equal_all_pairs_on_2000_names(spark):
    rng = random.Random(1)
    rows = [("phones" if k % 4 else "laptops", k, t) for k, t in enumerate(names(rng, 2000))]
    want = brute(rows, 88)
    assert found(spark, rows, 88) == want and 200 < len(want) < 1700


@pytest.mark.parametrize("threshold,hot,block", [(75, 2000, 500), (88, 4, 7), (100, 2000, 500)])
def test_thresholds_open_names_and_blocks(spark, monkeypatch, threshold, hot, block):
    monkeypatch.setattr(similar_names, "HOT_GRAM", hot)
    monkeypatch.setattr(similar_names, "OPEN_BLOCK", block)
    rng = random.Random(threshold)
    rows = [("k", k, t) for k, t in enumerate(names(rng, 150) + ["", "a", "b", "a b", "aa", "ab"])]
    assert found(spark, rows, threshold) == brute(rows, threshold)


def test_best_partners_alone_split_a_group(spark):
    # two pairs of near twins: each name's best partner is its twin, the link between the pairs is weaker
    rows = [(1, "alpha beta gamma delta epsilon one", "c"), (2, "alpha beta gamma delta epsilon ons", "c"),
            (3, "alpha beta gamma delta epsxlon twos", "c"), (4, "alpha beta gamma delta epsxlon twoz", "c")]
    df = spark.createDataFrame(rows, "row_id long, product_name_clean string, category string")
    groups = lambda links: sorted(sorted(x) for x in by(entity.grouped_records(df, links=links)).values())

    def by(records):
        out = {}
        for r in records.collect():
            out.setdefault(r["group_id"], set()).add(r["row_id"])
        return out
    scores = {(a, b): token_set_ratio(x, y) for a, x, _ in rows for b, y, _ in rows if a < b}
    assert max(v for k, v in scores.items() if k not in {(1, 2), (3, 4)}) >= 88 < min(scores[1, 2], scores[3, 4])
    assert groups("best") == [[1, 2], [3, 4]] and groups("all") == [[1, 2, 3, 4]]
