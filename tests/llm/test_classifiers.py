import zlib

import numpy as np
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import preference, toxicity

SF = "/root/testdata/sf0.1"


def judged(rows, label, modulus, remainder):
    given = {r["doc_id"]: r[label] for r in table(SF, "labels") if r[label] is not None}
    assert len(rows) == len(table(SF, "documents")) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in given]
    return [r for r in held if given[r["doc_id"]] == 1], [r for r in held if given[r["doc_id"]] == 0]


def auc(good, bad):
    a, b = np.array([r["score"] for r in good]), np.array([r["score"] for r in bad])
    return (a[:, None] > b[None, :]).mean()


def test_quality_held_out(spark):
    good, bad = judged(preference.op8_query(spark, SF).collect(), "quality", 4, 2)
    assert auc(good, bad) > 0.98
    assert np.mean([r["predicted"] for r in good]) > 0.97 and np.mean([r["predicted"] for r in bad]) < 0.1


def test_toxicity_held_out(spark):
    toxic, clean = judged(toxicity.op10_query(spark, SF).collect(), "toxic", 3, 1)
    assert auc(toxic, clean) > 0.95
    assert np.mean([r["predicted"] for r in toxic]) > 0.85 and np.mean([r["predicted"] for r in clean]) < 0.01


def test_bradley_terry_fit_recovers_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    better = x @ [2.0, -1.0, 0.0] + rng.logistic(size=2000) > 0
    w = preference.fit(x[better], x[~better])
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.2 * abs(w[0])
    assert preference.fit(x[:0], x) is None


def test_cut_comes_from_all_labelled_documents(spark, monkeypatch):
    # of 400 documents with the mixed phrase 20 are toxic: in the sample it is even, over all labels it is not
    rows = [(i, "vile scum", 1) for i in range(30)] + [(i, "mixed phrase", int(i < 50)) for i in range(30, 430)]
    rows += [(i, "plain words here", 0) for i in range(430, 1500)]
    d = docs(spark, [r[:2] for r in rows])
    some = labels(spark, [(i, y) for i, _, y in rows])
    monkeypatch.setattr(toxicity.train, "__defaults__", (50,))
    found = {r["text"]: r["toxicity"] for r in toxicity.score(d, some).collect()}
    assert found["vile scum"] >= 0.7 > max(found["mixed phrase"], found["plain words here"])
    seen = spark.createDataFrame([(2.0, 1), (2.0, 1), (1.0, 0), (1.0, 1), (1.0, 0), (1.0, 0), (-3.0, 0)], "raw double, label int")
    assert toxicity.labelled_cut(seen) == 1.5
    assert toxicity.labelled_cut(seen.where("label = 0")) is None


def test_machine_learns_a_pair_that_no_weights_can():
    one = lambda *t: (np.array(sorted(t)), np.ones(len(t), np.float32))
    rows = [one(1), one(2), one(1, 2), one(3)] * 300
    labels = np.array([0, 0, 1, 0] * 300, dtype=float)
    m = toxicity.fit(rows, labels)
    assert m.score(one(1, 2)) > 0.7 > max(m.score(one(1)), m.score(one(2)), m.score(one(3)))


def test_machine_learns_a_pair_of_terms_that_tell_nothing_alone():
    one = lambda *t: (np.array(sorted(t)), np.ones(len(t), np.float32))
    rng = np.random.default_rng(5)
    pick = rng.integers(0, 2, (1200, 2))
    rows = [one(10 + 20 * a, 20 + 20 * b, *rng.choice(np.arange(100, 400), 8, replace=False)) for a, b in pick]
    labels = (pick[:, 0] == pick[:, 1]).astype(float)
    assert not set(toxicity.telling(rows, labels)) & {10, 20, 30, 40}
    m = toxicity.fit(rows, labels)
    assert np.mean([(m.score(r) >= 0.7) == y for r, y in zip(rows, labels)]) > 0.95
    assert min(m.score(one(10, 20)), m.score(one(30, 40))) > 0.7 > max(m.score(one(10, 40)), m.score(one(30, 20)))


def test_machine_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(0.1, rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, toxicity.FACTORS)))
    at, x = np.array([3, 70, 999]), np.array([1.0, 2.0, 0.5])
    z = 0.1 + sum(m.weights[i] * v for i, v in zip(at, x))
    z += sum(m.factors[at[a]] @ m.factors[at[b]] * x[a] * x[b] for a in range(3) for b in range(a))
    assert abs(m.score((at, x)) - 1 / (1 + np.exp(-z))) < 1e-9


CASES = [(1, None), (2, ""), (3, "good words here. " * 30), (3, "good words here. " * 30), (4, "BAD!! $$$ ### BAD!!"),
         (None, "idiot"), (5, "x " * 50_000), (6, "\n\n | | ퟿")]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, label int")


def test_cases(spark):
    d = docs(spark, CASES).withColumn("raw", F.lit("clash")).withColumn("toxicity", F.lit("clash")).withColumn("label", F.lit(7))
    some = labels(spark, [(3, 1), (4, 0), (4, 1), (5, None), (None, 1), (99, 0), (3, 1)])
    for run, column in ((preference.rank, "score"), (toxicity.score, "toxicity")):
        rows = run(d, some).collect()
        assert len(rows) == len(CASES) and all(0 <= r[column] <= 1 for r in rows)
        by = {}
        for r in rows:
            by.setdefault(r["doc_id"], set()).add(r[column])
        assert len(by[3]) == 1 and by[1] == by[2]
        none = run(d, labels(spark, [])).collect()
        assert len({r[column] for r in none}) == 1 and none[0][column] < 0.7 and len(none) == len(CASES)
        assert run(docs(spark, []), some).collect() == []
