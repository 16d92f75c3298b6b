"""A text encoder that is learned from the catalog: latent directions of its n-gram weights.

The catalog's names are rows of a sparse matrix of hashed character n-grams (word starts and ends
count), weighted by inverse document frequency. The encoder keeps the ``rank`` directions that hold the
most of it (a truncated singular value decomposition): a text is projected onto them and made unit
length. What the catalog never says (advertising words, conditions of a sale) has no weight or lies
outside of these directions, so it hardly moves a listing away from its product.

The decomposition is found by subspace iteration. Each round is one pass over the names: a task
multiplies its rows with the current directions and back, and adds the result up by blocks of n-grams;
the driver holds ``FEATURES x (rank + SPARE)`` numbers, whatever the catalog's size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoder import Encoder

#: Hashed n-grams, latent directions, directions more than that while they are sought, rounds of iteration.
FEATURES, RANK, SPARE, ROUNDS = 4096, 192, 32, 3
GRAMS = (3, 4)
#: N-grams of a block that tasks add up, and names that a task multiplies at once.
BLOCK, ROWS = 256, 512

find_words = re.compile(r"[^\W_]+").findall


def features(text: str | None) -> Counter:
    """Hashed n-grams of a text's lower-cased words, with their counts."""
    out: Counter = Counter()
    for word in find_words(text.lower()) if text else []:
        padded = f" {word} "
        for n in GRAMS:
            out.update(zlib.crc32(padded[i:i + n].encode()) % FEATURES for i in range(max(1, len(padded) - n + 1)))
    return out


def weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of a text's n-grams: damped counts times inverse document frequency, unit length."""
    found = features(text)
    at = np.fromiter(found, np.int64, len(found))
    w = (1 + np.log(np.fromiter(found.values(), float, len(found)))) * idf[at]
    size = np.sqrt((w * w).sum())
    return at, w / size if size else w


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(FEATURES + 1, np.int64)  # the last one counts the names
        for batch in batches:
            for text in batch["text"]:
                df[list(features(text))] += 1
                df[-1] += 1
        yield pd.DataFrame({"at": np.arange(FEATURES + 1), "n": df})
    rows = texts.mapInPandas(count, "at int, n long").groupBy("at").agg(F.sum("n")).collect()
    df = np.zeros(FEATURES + 1, np.int64)
    for at, n in rows:
        df[at] = n
    return df[:-1], int(df[-1])


def _times_gram(texts: DataFrame, idf, directions) -> np.ndarray:
    """(A'A) Q for the matrix A of all names and the broadcast ``directions`` Q."""
    width = directions.value.shape[1]

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, weights = directions.value, idf.value
        total = np.zeros((FEATURES, width))
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                names = batch["text"].iloc[start:start + ROWS]
                a = np.zeros((len(names), FEATURES))
                for k, text in enumerate(names):
                    at, w = weighted(text, weights)
                    a[k, at] = w
                total += a.T @ (a @ q)
        for k in range(0, FEATURES, BLOCK):
            yield pd.DataFrame({"block": [k], "part": [total[k:k + BLOCK].tobytes()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in rows["part"])
        return pd.DataFrame({"block": [rows["block"].iat[0]], "part": [total.tobytes()]})
    parts = texts.mapInPandas(multiply, "block int, part binary").groupBy("block").applyInPandas(add, "block int, part binary").collect()
    out = np.zeros((FEATURES, width))
    for block, part in parts:
        out[block:block + BLOCK] = np.frombuffer(part).reshape(-1, width)
    return out


def latent_ngrams(catalog_texts: DataFrame, rank: int = RANK, seed: int = 7) -> Encoder:
    """An encoder learned from ``catalog_texts`` (text); ``ROUNDS + 2`` passes over them.

    A text without an n-gram of the catalog becomes the zero vector, which is near to nothing.
    """
    spark = catalog_texts.sparkSession
    texts = catalog_texts.select("text")
    df, n = _document_frequencies(texts)
    idf = np.where(df > 0, np.log((n + 1) / (df + 1)) + 1, 0.0)
    shared_idf = spark.sparkContext.broadcast(idf)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((FEATURES, rank + SPARE)))[0]
    for k in range(ROUNDS + 1):
        directions = spark.sparkContext.broadcast(q)
        z = _times_gram(texts, shared_idf, directions)
        directions.destroy()
        if k < ROUNDS:
            q = np.linalg.qr(z)[0]
    values, turn = np.linalg.eigh(q.T @ z)
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-9 * max(values.max(), 1e-300)]
    model = spark.sparkContext.broadcast((idf, (q @ turn[:, keep]).astype(np.float32)))

    @F.pandas_udf("array<float>")
    def encode(column: pd.Series) -> pd.Series:
        weights, basis = model.value
        out = []
        for text in column:
            at, w = weighted(text, weights)
            v = w @ basis[at] if len(at) else np.zeros(basis.shape[1])
            size = np.sqrt((v * v).sum())
            out.append((v / size if size > 1e-9 else v * 0).astype(np.float32))
        return pd.Series(out, dtype="object")
    return lambda frame: frame.withColumn("embedding", encode("text"))
