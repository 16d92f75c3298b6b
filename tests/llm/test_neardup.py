import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import neardup

SF = "/root/testdata/sf0.001"


def weighted(text):
    w = neardup.find_words((text or "").lower())
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(x, y):
    """Probability Jaccard by its definition."""
    every = set(x) | set(y)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in every) for d in x if d in y)


def brute(rows):
    """{doc_id: class_id} by comparing all pairs of texts that share a shingle."""
    usable = [(i, weighted(t)) for i, t in rows if i is not None and weighted(t)]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(usable):
        for j, y in usable[:a]:
            if min(len(x), len(y)) * 2 >= max(len(x), len(y)) and len(x.keys() & y.keys()) * 2 > len(x) and similarity(x, y) >= 0.8:
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i, _ in rows}


def test_register_agreement_estimates_the_index():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    a = np.sort(items[:50]), rng.integers(1, 5, 50)
    b = np.sort(items[10:]), rng.integers(1, 5, 50)
    x, y = Counter(dict(zip(a[0].tolist(), a[1].tolist()))), Counter(dict(zip(b[0].tolist(), b[1].tolist())))
    want = similarity(x, y)
    assert abs(neardup.probability_jaccard(a, b) - want) < 1e-12
    s = neardup.prob_minhash([a, b], 8192)
    assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / 8192) ** 0.5
    assert (neardup.prob_minhash([a])[0] == neardup.prob_minhash([b, a])[1]).all()


def test_registers_hold_items_by_weight():
    s = neardup.prob_minhash([(np.arange(4, dtype=np.uint64), np.array([1, 2, 3, 4]))], 20_000)[0]
    assert np.abs(np.bincount(s.astype(int)) / 20_000 - np.array([0.1, 0.2, 0.3, 0.4])).max() < 0.02


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(d["doc_id"], d["text"]) for d in table(SF, "documents")]
    for n, edits in ((60, 6), (5, 2), (4, 0)):
        base = [f"w{rng.randrange(500)}" for _ in range(150)]
        rows += [(10_000 + len(rows) + k, t) for k, t in enumerate(family(rng, base, n, edits))]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, rows)).collect()}
    assert got == brute(rows)


def test_what_leaders_miss_is_found_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEADER_ROUNDS", 1)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "OTHERS", 16)
    monkeypatch.setattr(neardup, "GROUP", 64)
    rng = random.Random(7)
    base = [f"w{k}" for k in range(200)]
    chain, rows = base[:], []
    for k in range(70):  # each like the one before, the ends unlike
        rows.append((k, " ".join(chain)))
        chain = chain[:]
        for _ in range(2):
            chain[rng.randrange(200)] = f"x{rng.randrange(10 ** 6)}"
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, rows)).collect()}
    assert got == brute(rows)


CASES = [(1, "one two three"), (2, "One, two; THREE!"), (3, "one two"), (4, None), (5, ""), (6, ""), (7, "..."),
         (None, "one two three"), (8, "one two three"), (8, "one two three"), (9, "other text here"), (9, "one two three"),
         (10, "a b c d e " * 4000), (11, "a b c d e " * 4001)]


def test_cases(spark):
    d = docs(spark, CASES).withColumn("key", F.lit("clash")).withColumn("node", F.lit(1)).withColumn("class_id", F.lit(2))
    got = sorted((str(r["doc_id"]), r["class_id"]) for r in neardup.classes(d).collect())
    want = [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (None, None), (8, 1), (8, 1), (9, 9), (9, 1), (10, 10), (11, 10)]
    assert got == sorted((str(i), c) for i, c in want)
    kept = neardup.deduplicate(d)
    assert kept.columns == d.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, [1, 3, 4, 5, 6, 7, None, 9, 10]))
    assert neardup.classes(docs(spark, [])).collect() == [] and neardup.deduplicate(docs(spark, [])).collect() == []
    alone = neardup.classes(docs(spark, [(1, "no copies of this one here"), (2, "something else, quite different")])).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in alone) == [(1, 1), (2, 2)]


def test_one_id_with_two_texts_keeps_both_and_splits_the_classes(spark):
    a, b, c = "the first text has words of its own", "another one that shares not a single shingle", "and a third text, alone in the world"
    lone = docs(spark, [(1, a), (1, b), (4, c)])
    assert sorted((r["doc_id"], r["text"]) for r in neardup.deduplicate(lone).collect()) == sorted([(1, a), (1, b), (4, c)])
    rows = docs(spark, [(1, a), (1, b), (2, b), (3, a), (1, a), (5, c), (None, c), (5, None), (5, "")])
    found = [(r["doc_id"], r["class_id"], r["class_key"]) for r in neardup.classes(rows).collect()]
    assert sorted((d, k) for d, k, key in found if key and d) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (5, 5)]
    keys = {}
    for d, _, key in found:
        if key:
            keys.setdefault(key, set()).add(d)
    assert sorted(map(sorted, keys.values())) == [[1, 2], [1, 3], [5]]
    kept = sorted(((r["doc_id"], r["text"]) for r in neardup.deduplicate(rows).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (5, c), (None, c), (5, None), (5, "")], key=str)


def test_recall_by_similarity(spark):
    # pairs of a text and an edited copy of it; the similarity that counts is the exact one
    rng = random.Random(11)
    rows, pairs = [], []
    for k in range(400):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(30, 200))]
        copy = base[:]
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = "new"
        pairs.append((2 * k, 2 * k + 1))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    text = dict(rows)
    cut = {i: np.unique(neardup.shingles(t), return_counts=True) for i, t in rows}
    like = {p: neardup.probability_jaccard(cut[p[0]], cut[p[1]]) for p in pairs}
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, rows)).collect()}
    assert len(text) == 800 and all((got[a] == got[b]) == (s >= neardup.SIMILARITY) for (a, b), s in like.items())
    assert min(sum(lo <= s < lo + 0.1 for s in like.values()) for lo in (0.6, 0.8, 0.9)) > 15
