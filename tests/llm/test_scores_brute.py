"""The two classifiers' queries against plain Python from each text to its score, given the trained weights."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from brute import table
from pricefold.llm import common, preference, toxicity

SF = "/root/testdata/sf0.001"


def rest(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def trained(spark, module, column, modulus, remainder):
    docs = common.read(spark, SF, "documents").select("doc_id", "text")
    labels = common.read(spark, SF, "labels").filter(~common.held_out(F.col("doc_id"), modulus, remainder)).select("doc_id", F.col(column).alias("label"))
    return module.train(docs, labels)


def learned_from(column, modulus, remainder):
    return [(r["doc_id"], r[column]) for r in table(SF, "labels") if rest(r["doc_id"], modulus) != remainder and r[column] in (0, 1)]


def logistic(z):
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def test_quality_query_equals_plain_scores(spark):
    weights = trained(spark, preference, "quality", 4, 2)
    texts = {d["doc_id"]: d["text"] for d in table(SF, "documents")}
    raw = {i: sum(x * w for x, w in zip(preference.features(t), weights)) for i, t in texts.items()}
    seen = [(raw[i], y) for i, y in learned_from("quality", 4, 2) if i in raw]
    bad = sum(y == 0 for _, y in seen) / len(seen)
    ordered = sorted(z for z, _ in seen)
    level = lambda p: ordered[max(0, math.ceil(min(1, max(0, p)) * len(ordered)) - 1)]
    cut = (level(bad - preference.AROUND) + level(bad + preference.AROUND)) / 2
    width = max((level(0.9) - level(0.1)) / 4, 1e-6)
    got = {r["doc_id"]: r for r in preference.op8_query(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, z in raw.items():
        want = logistic((z - cut) / width + math.log(0.7 / 0.3))
        assert abs(got[i]["score"] - want) < 1e-6 and got[i]["held_out"] == (rest(i, 4) == 2)
        if abs(z - cut) > 1e-9:
            assert got[i]["predicted"] == int(z >= cut)


def test_toxicity_query_equals_plain_scores(spark):
    machine = trained(spark, toxicity, "toxic", 3, 1)
    texts = {d["doc_id"]: d["text"] for d in table(SF, "documents")}

    def raw(text):
        ids, values = toxicity.terms(text)
        z = machine.bias + sum(float(machine.weights[t]) * x for t, x in zip(ids, values))
        v = machine.factors[ids].astype(float) * np.asarray(values, float)[:, None]
        pairs = v @ v.T       # every pair of terms, one by one
        return z + float(np.triu(pairs, 1).sum())
    z = {i: raw(t) for i, t in texts.items()}
    seen = sorted(((z[i], y) for i, y in learned_from("toxic", 3, 1) if i in z), reverse=True)
    total, best, cut = sum(y for _, y in seen), -1.0, None
    for k in range(len(seen)):      # the cut of best F1 among all, in the middle of its gap
        f1 = 2 * sum(y for _, y in seen[:k + 1]) / (k + 1 + total)
        if f1 > best + 1e-12 and (k + 1 == len(seen) or seen[k][0] - seen[k + 1][0] > 1e-9):
            best, cut = f1, seen[k][0] - 0.1 if k + 1 == len(seen) else (seen[k][0] + seen[k + 1][0]) / 2
    got = {r["doc_id"]: r for r in toxicity.op10_query(spark, SF).collect()}
    assert got.keys() == texts.keys() and total > 3
    shift = [math.log(r["score"] / (1 - r["score"])) - z[i] for i, r in got.items() if 1e-9 < r["score"] < 1 - 1e-9]
    assert max(shift) - min(shift) < 1e-3      # one shift for all: the cut that the query took
    own = math.log(0.7 / 0.3) - float(np.median(shift))
    f1 = lambda c: 2 * sum(y for s, y in seen if s >= c) / (sum(s >= c for s, _ in seen) + total)
    assert f1(own) >= best - 0.02              # its cut comes from bins of the scores
    for i, r in got.items():
        assert r["held_out"] == (rest(i, 3) == 1) and r["predicted"] == int(r["score"] >= 0.7)
        assert abs(r["score"] - logistic(z[i] + float(np.median(shift)))) < 1e-3
