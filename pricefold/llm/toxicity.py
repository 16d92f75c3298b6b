"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their beginnings of 4 and 6 letters (for inflected and
compound words), hashed to ``BUCKETS`` numbers, each with the value log2(1 + occurrences). The machine
adds a weight per term and, for each pair of terms that occur together, the product of their factor
vectors; an insult and the mention of a group thus count together for more than both alone. It is
fitted by mini-batches with the logistic loss and adaptive steps, until a tenth that was set aside no
longer gains: first the terms whose mean differs clearly between the labels, then, from there, all
terms of the sample, so that a pair counts whose terms tell nothing alone. Rare ones decay faster.

Fitted on a bounded sample (``SAMPLE`` documents of each label, hash order); every text is scored
whole, in its partition. Scores are then moved so that the cut with the best F1 over all labelled
documents stands at 0.7: toxic and clean ones are counted per bin of the raw score, so the share of
toxic documents is that of the labels, not of the sample.

Defined cases: a null text is an empty one, without terms, and scores by the bias alone; null labels
take no part; a document with both labels is learned as both; without both labels all scores are the
share of toxic labels, or 0 without any; equal texts score equally; repeated rows are scored each;
input columns named as an added one are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SAMPLE = 3000
BUCKETS, FACTORS = 1 << 17, 4
#: A term is learned first if so many sampled documents have it and its means differ by so many standard errors.
MIN_DOCS, MIN_Z = 4, 3.0
EPOCHS, BATCH, DECAY = 60, 64, 1e-3
#: Steps of weights and of factors for the telling terms, then for all.
STEPS = ((0.05, 0.0125), (0.01, 0.01))
#: Another term decays by 1 + RARE / (sampled documents that have it) times as much.
RARE = 20
THRESHOLD = 0.7
#: Bins of the raw score per unit of its inverse hyperbolic sine: fine around 0, and few for extreme scores.
BINS = 4096

find_words = re.compile(r"[^\W_]+").findall


def _hashed(word: str) -> tuple[int, int, int]:
    crc = lambda x: zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS
    return crc(word), crc("^" + word[:4]), crc("^" + word[:6])


_terms_of = common.Memo(_hashed)


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, different term numbers of a whole text, and their values."""
    counts = Counter(find_words(text.lower())) if text else {}
    found = np.array(list(map(_terms_of.__getitem__, counts)), dtype=np.int32).reshape(-1, 3)
    number, at = np.unique(found, return_inverse=True)
    times = np.repeat(np.fromiter(counts.values(), dtype=float, count=len(counts)), 3)
    return number, np.log2(1 + np.bincount(at.ravel(), times, len(number))).astype(np.float32)


TERMS = T.StructType().add("terms", T.ArrayType(T.IntegerType())).add("values", T.ArrayType(T.FloatType()))


@F.arrow_udf(TERMS)
def text_terms(texts: pa.Array) -> pa.Array:
    rows = [terms(t) for at in range(0, len(texts), common.SLICE_ROWS)
            for t in texts[at:at + common.SLICE_ROWS].to_pylist()]
    return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], type=pa.list_(pa.int32())),
                                       pa.array([r[1] for r in rows], type=pa.list_(pa.float32()))], names=["terms", "values"])


class Machine:
    """bias, weights (one a term) and factors (``FACTORS`` a term); 0 for terms that weren't learned."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def raw(self, found: tuple[np.ndarray, np.ndarray]) -> float:
        """The score before the logistic function."""
        at, x = found
        v = self.factors[at] * x[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum())
        return self.bias + float(self.weights[at] @ x) + pairs

    def score(self, found: tuple[np.ndarray, np.ndarray]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(found), -30, 30))))


def telling(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Terms of enough documents whose mean value differs clearly between the labels."""
    flat, x = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]).astype(float)
    y = np.repeat(labels, [len(r[0]) for r in rows])
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    s1, s0 = np.bincount(flat, x * y, BUCKETS) / n1, np.bincount(flat, x * (1 - y), BUCKETS) / n0
    q1, q0 = np.bincount(flat, x * x * y, BUCKETS) / n1, np.bincount(flat, x * x * (1 - y), BUCKETS) / n0
    error = np.sqrt((q1 - s1 ** 2 + 1 / n1) / n1 + (q0 - s0 ** 2 + 1 / n0) / n0)
    return np.flatnonzero((np.bincount(flat, minlength=BUCKETS) >= MIN_DOCS) & (np.abs(s1 - s0) / error >= MIN_Z))


def best_cut(z: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap at which calling all above it toxic has the best F1 on the sample."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], labels[order]
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    return float(z[k] - 0.1 if k + 1 == len(z) else (z[k] + z[k + 1]) / 2)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 11) -> Machine:
    """A machine for the terms and values of texts and their labels 0 or 1."""
    n = len(labels)
    share = float(labels.mean()) if n else 0.0
    bias = float(np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
    none = Machine(bias, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))
    if not 0 < share < 1:
        return none
    flat, ends = np.concatenate([r[0] for r in rows]), np.cumsum([0] + [len(r[0]) for r in rows])
    used, flat = np.unique(flat, return_inverse=True)
    x = np.concatenate([r[1] for r in rows]).astype(float)
    tells = np.isin(used, telling(rows, labels))
    decay = DECAY * np.where(tells, 1, 1 + RARE / np.bincount(flat, minlength=len(used)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    held, learned = order[:n // 10], order[n // 10:]
    w, start = np.zeros(len(used)), rng.normal(0, 0.01, (len(used), FACTORS))
    v = np.where(tells[:, None], start, 0)

    def batch(ids, data):
        flat, x, ends = data
        at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in ids])
        doc, val = np.repeat(np.arange(len(ids)), ends[ids + 1] - ends[ids]), x[at]
        vx = v[flat[at]] * val[:, None]
        sums = np.stack([np.bincount(doc, vx[:, f], len(ids)) for f in range(FACTORS)], axis=1)
        squares = np.bincount(doc, (vx ** 2).sum(axis=1), len(ids))
        return flat[at], doc, val, vx, sums, bias + np.bincount(doc, w[flat[at]] * val, len(ids)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)

    def raw(ids, data):
        return np.concatenate([batch(ids[at:at + 512], data)[-1] for at in range(0, len(ids), 512)])

    def loss(ids, data):
        if not len(ids):
            return 0.0
        z = np.clip(raw(ids, data), -30, 30)
        return float(np.mean(np.log1p(np.exp(-z)) * labels[ids] + np.log1p(np.exp(z)) * (1 - labels[ids])))

    some = tells[flat]
    data = (flat[some], x[some], np.concatenate([[0], np.cumsum(some)])[ends]), (flat, x, ends)
    for part, (w_step, v_step) in zip(data, STEPS):
        best, kept, worse = loss(held, part), (bias, w.copy(), v.copy()), 0
        if part is data[1]:
            v = np.where(tells[:, None], v, start)
        gw, gv, gb = np.full(len(used), 1e-6), np.full(v.shape, 1e-6), 1e-6
        for _ in range(EPOCHS):
            rng.shuffle(learned)
            for at in range(0, len(learned), BATCH):
                ids = learned[at:at + BATCH]
                terms_, doc, val, vx, sums, z = batch(ids, part)
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[ids]) / len(ids)
                t, k = np.unique(terms_, return_inverse=True)
                slope = e[doc][:, None] * val[:, None] * (sums[doc] - vx)
                dw = np.bincount(k, e[doc] * val, len(t)) + decay[t] * w[t]
                dv = np.stack([np.bincount(k, slope[:, f], len(t)) for f in range(FACTORS)], axis=1) + decay[t][:, None] * v[t]
                gw[t] += dw ** 2
                gv[t] += dv ** 2
                gb += e.sum() ** 2
                w[t] -= w_step * dw / np.sqrt(gw[t])
                v[t] -= v_step * dv / np.sqrt(gv[t])
                bias -= w_step * e.sum() / np.sqrt(gb)
            now = loss(held, part)
            worse = 0 if now < best - 1e-4 else worse + 1
            if now < best or not len(held):
                best, kept = now, (bias, w.copy(), v.copy())
            if worse >= 5:
                break
        bias, w, v = kept
    none.bias = float(bias - best_cut(raw(np.arange(n), data[1]), labels) + np.log(THRESHOLD / (1 - THRESHOLD)))
    none.weights[used], none.factors[used] = w, v
    return none


def usable(labels: DataFrame) -> DataFrame:
    """Different (doc_id, label) with an id and a label 0 or 1."""
    return labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()) \
                 .select("doc_id", F.col("label").cast("int").alias("label")).distinct()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine from ``labels`` (doc_id, label 0 or 1) of ``docs`` (doc_id, text)."""
    labels = usable(labels)
    ids = common.bounded_sample(labels, sample, "label", "doc_id")
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .select("doc_id", "label", text_terms("text").alias("x")))
    rows = common.bounded_sample(rows, sample, "label", "doc_id")  # an id may have many rows
    found = rows.select("doc_id", "label", "x.terms", "x.values").orderBy("doc_id", "label", F.xxhash64("terms")).toArrow().combine_chunks()
    parts = [found.column(c).combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32())) for c in ("terms", "values")]
    ends = parts[0].offsets.to_numpy()
    terms_, values = (p.values.to_numpy(zero_copy_only=False) for p in parts)
    return fit([(terms_[i:j], values[i:j]) for i, j in zip(ends, ends[1:])],
               np.array(found.column("label").to_pylist(), dtype=float))


def labelled_cut(seen: DataFrame) -> float | None:
    """The raw score at which calling all above it toxic has the best F1 over all of ``seen`` (raw, label).

    Rows are counted per bin of the raw score (equal scores share one); the cut is the middle of the gap
    between two bins, or None without both labels.
    """
    bins = (seen.groupBy(F.floor(F.asinh("raw") * BINS).alias("bin"))
            .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
            .orderBy(F.desc("bin")).collect())
    toxic, n = np.array([b["toxic"] for b in bins], dtype=float), np.array([b["n"] for b in bins], dtype=float)
    if not 0 < toxic.sum() < n.sum():
        return None
    k = int(np.argmax(2 * np.cumsum(toxic) / (np.cumsum(n) + toxic.sum())))
    return bins[k]["low"] - 0.1 if k + 1 == len(bins) else (bins[k]["low"] + bins[k + 1]["high"]) / 2


def score(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or these ``columns`` of it and doc_id) with toxicity (0 to 1), learned from ``labels`` (doc_id, label)."""
    spark = docs.sparkSession
    common.prepare(spark)
    labels = usable(labels)
    machine = train(docs, labels)
    shared = common.Shared(spark, machine)

    @F.arrow_udf(T.DoubleType())
    def raw(texts: pa.Array) -> pa.Array:
        machine, out = shared.value, []
        for at in range(0, len(texts), common.SLICE_ROWS):
            out += [machine.raw(terms(t)) for t in texts[at:at + common.SLICE_ROWS].to_pylist()]
        return pa.array(out, type=pa.float64())

    kept = docs if columns is None else docs.select(*dict.fromkeys(["doc_id", *columns]), "text")
    scored = kept.withColumn("toxicity", raw("text"))
    scored = common.written(scored if columns is None else scored.drop("text"), "scores")
    logit = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    z, cut = F.col("toxicity"), None
    if machine.factors.any():
        cut = labelled_cut(scored.select("doc_id", F.col("toxicity").alias("raw")).join(labels, "doc_id"))
    if cut is not None:
        z = z - cut + logit
    toxicity = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
    if cut is not None:  # the cut itself counts as toxic, whatever the last digit
        toxicity = F.when(F.col("toxicity") >= cut, F.greatest(toxicity, F.lit(THRESHOLD))).otherwise(F.least(toxicity, F.lit(THRESHOLD - 1e-9)))
    return scored.withColumn("toxicity", toxicity)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that aren't held out."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = common.held_out(F.col("doc_id"), 3, 1)
    labels = common.read(spark, sf_dir, "labels").filter(~out).select("doc_id", F.col("toxic").alias("label"))
    return score(docs, labels, ["doc_id"]).select("doc_id", out.alias("held_out"), F.col("toxicity").alias("score"),
                                      (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
