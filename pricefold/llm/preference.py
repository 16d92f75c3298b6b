"""Quality by Bradley-Terry ranking of documents.

Pairs of a better and a worse document say which of two is preferred. The model is a linear score of
text features; the probability that one document is preferred is the logistic function of the
difference of scores, so its weights are a logistic regression on feature differences, found by
Newton steps. The threshold is a quantile of scores: it leaves as large a share of all labelled
training documents below it as the labels call bad. Scores are shifted so that it stands at 0.7.

The weights are fitted on a bounded sample (``SAMPLE`` documents of each label, ``PAIRS`` pairs);
the quantile covers all labelled training documents, and every text is read whole.

Defined cases: a null text is an empty one; both score like a text without words; labels that are
null take no part; a document with both labels stands on both sides; without pairs all scores are
0.5 and nothing is predicted good; equal texts get equal scores; repeated rows are scored each; input
columns named as an added one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Sampled documents of each label, and preference pairs between them.
SAMPLE, PAIRS = 3000, 30_000
THRESHOLD = 0.7
#: Half the width, as a share of documents, over which the quantile is averaged.
AROUND = 0.004
RIDGE = 1e-3

find_upper = re.compile(r"[A-ZÀ-ÖØ-Þ]").findall
find_odd = re.compile(r"[^\w\s.,;:'\"!?()-]").findall
find_link = re.compile(r"https?://|www\.|@").findall


def features(text: str | None) -> list[float]:
    """Shares and rates of a whole text: case, symbols, repetition, lines, length."""
    text = text or ""
    tokens, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, chars = max(1, len(tokens)), max(1, len(text))
    words = Counter(tokens)
    runs = len(set(zip(tokens, tokens[1:], tokens[2:])))
    repeated_lines = sum(c - 1 for c in Counter(lines).values())
    ends = sum(x[-1] in ".!?\"'" for x in map(str.rstrip, lines))
    odd, upper = len(find_odd(text)), len(find_upper(text))
    shout, bar = text.count("!"), text.count("|")
    digits = sum(map(text.count, "0123456789"))
    length = np.log1p(len(tokens))
    return [
        upper / chars, odd / chars, min(1.0, odd / n), shout / n, bar / n, digits / chars,
        1 - runs / max(1, len(tokens) - 2) if len(tokens) > 2 else 0.0,
        repeated_lines / max(1, len(lines)),
        max(words.values(), default=0) / n, len(words) / n, chars / n / 10,
        1 - ends / max(1, len(lines)), len(lines) / n, len(find_link(text)) / n,
        sum(map(text.count, ".,")) / n, length / 10, (length / 10) ** 2, float(len(tokens) < 5),
    ]


N_FEATURES = len(features(""))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def text_features(texts: pa.Array) -> pa.Array:
    rows = [features(t) for at in range(0, len(texts), common.SLICE_ROWS)
            for t in texts[at:at + common.SLICE_ROWS].to_pylist()]
    return pa.array(rows, type=pa.list_(pa.float64()))


def fit(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS) -> np.ndarray | None:
    """Weights, first standardised, of the features; None without pairs."""
    if not len(good) or not len(bad):
        return None
    both = np.vstack([good, bad])
    scale = both.std(axis=0)
    scale[scale < 1e-9] = np.inf
    pick = np.random.default_rng(17)
    x = (good[pick.integers(len(good), size=pairs)] - bad[pick.integers(len(bad), size=pairs)]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (1 - p) / pairs - RIDGE * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return w / scale


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Weights from ``labels`` (doc_id, label 0 or 1) of ``docs`` (doc_id, text)."""
    ids = common.bounded_sample(labels, sample, "label", "doc_id")
    # two times ``sample`` ids at most
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .select("doc_id", "label", text_features("text").alias("x")))
    rows = common.bounded_sample(rows, sample, "label", "doc_id").collect()  # an id may have many rows
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    of = [np.array([r["x"] for r in rows if r["label"] == k]).reshape(-1, N_FEATURES) for k in (0, 1)]
    return fit(of[1], of[0])


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, raw (the Bradley-Terry score) and score (0.7 at the threshold) of each document.

    ``labels`` (doc_id, label) are those to learn from; ids and labels are no input of a score.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    labels = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()) \
                   .select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    weights = train(docs, labels)
    if weights is None:
        return docs.select("doc_id", F.lit(0.0).alias("raw"), F.lit(0.5).alias("score"))

    @F.arrow_udf(T.DoubleType())
    def raw_score(texts: pa.Array) -> pa.Array:
        out = [float(np.dot(features(t), weights)) for at in range(0, len(texts), common.SLICE_ROWS)
               for t in texts[at:at + common.SLICE_ROWS].to_pylist()]
        return pa.array(out, type=pa.float64())

    scored = common.written(docs.select("doc_id", raw_score("text").alias("raw")), "scores")
    seen = scored.join(labels, "doc_id")
    bad = seen.agg(F.avg((F.col("label") == 0).cast("double"))).first()[0]
    levels = [min(1.0, max(0.0, (bad or 0.0) + d)) for d in (-AROUND, AROUND)]
    low, high, left, right = seen.agg(F.percentile_approx("raw", levels + [0.1, 0.9], 20_000)).first()[0]
    cut, width = (low + high) / 2, max((right - left) / 4, 1e-6)
    logit = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    score = 1 / (1 + F.exp(-F.least(F.greatest((F.col("raw") - cut) / width + logit, F.lit(-30.0)), F.lit(30.0))))
    # the threshold itself counts as good, whatever the last digit
    score = F.when(F.col("raw") >= cut, F.greatest(score, F.lit(THRESHOLD))).otherwise(F.least(score, F.lit(THRESHOLD - 1e-9)))
    return scored.select("doc_id", "raw", score.alias("score"))


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels that aren't held out."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = common.held_out(F.col("doc_id"), 4, 2)
    labels = common.read(spark, sf_dir, "labels").filter(~out).select("doc_id", F.col("quality").alias("label"))
    return rank(docs, labels).select("doc_id", out.alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
