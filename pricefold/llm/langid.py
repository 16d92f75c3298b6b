"""Language identification: known words first, then shorter and shorter character n-grams.

The model holds, per language, the relative frequencies of its most frequent words and of its most
frequent character n-grams (1 to 5 characters, with the word's edges as blanks). A word that any
language knows is scored by minus the logarithm of its frequency in each, a fixed penalty where a
language lacks it; an unknown word is scored by the mean over its longest n-grams that any language
knows. A text's score is the mean over all its words, the least wins.

The model is learned from a bounded sample (``SAMPLE`` documents of each language, by hash of the id)
and has ``MODEL_ROWS`` entries at most, so it can be sent to all executors. Predictions read the text only.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text with letters that
no language knows gets the most frequent language at score 1/languages; without any training text
all are ``und``; ties go to the language with more training documents, then to the smaller name;
repeated rows get the same prediction each; input columns named as an added one are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Training documents of a language, and the longest n-grams.
SAMPLE, LONGEST = 3000, 5
#: Entries of the whole model over all languages, and of one language: words, n-grams of one length.
MODEL_ROWS, WORDS, GRAMS = 400_000, 10_000, 4_000
MAX_LANGUAGES = 1000
PENALTY = 7.0
UNKNOWN = "und"
#: The pipeline's stage drops what scores below this.
MIN_SCORE = 0.5

find_words = re.compile(r"[^\W\d_]+").findall


@F.arrow_udf(T.ArrayType(T.StringType()))
def _words(texts: pa.Array) -> pa.Array:
    return pa.array([find_words(t.lower()) if t else [] for t in texts.to_pylist()], type=pa.list_(pa.string()))


class Model:
    """Scores per language of words, from the counts of words and n-grams."""

    def __init__(self, languages: list[str], counts: Iterable[tuple[int, int, str, int]]):
        """``languages`` in order of preference at ties; counts: (length or 0 for a word, language, gram, count)."""
        self.languages = languages
        rows: dict[int, dict[str, int]] = {n: {} for n in range(LONGEST + 1)}
        found = [(n, lang, gram, c) for n, lang, gram, c in counts]
        totals = np.zeros((LONGEST + 1, len(languages)))
        for n, lang, gram, c in found:
            totals[n, lang] += c
            rows[n].setdefault(gram, len(rows[n]))
        self.rows = rows
        self.scores = [np.full((len(rows[n]), len(languages)), PENALTY) for n in range(LONGEST + 1)]
        for n, lang, gram, c in found:
            self.scores[n][rows[n][gram], lang] = min(PENALTY, -np.log10(c / totals[n, lang]))
        self.known: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(languages)))

    def word(self, w: str) -> np.ndarray:
        if (k := self.rows[0].get(w)) is not None:
            return self.scores[0][k]
        padded = f" {w} "
        for n in range(min(LONGEST, len(padded)), 0, -1):
            grams = (padded[i:i + n] for i in range(len(padded) - n + 1))
            if found := [k for g in grams if g != " " and (k := self.rows[n].get(g)) is not None]:
                return self.scores[n][found].mean(axis=0)
        return np.full(len(self.languages), PENALTY)

    def row(self, w: str) -> int:
        """Where ``matrix`` has the scores of a word; they are kept, up to a bound."""
        k = self.known.get(w)
        if k is None:
            k = self.known[w] = len(self.known)
            if k >= len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.matrix[k] = self.word(w)
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        words = find_words(text.lower()) if text else []
        if not self.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        if len(self.known) > 150_000:
            self.known.clear()
        at = np.fromiter(map(self.row, words), dtype=np.int64, count=len(words))
        score = self.matrix[at].mean(axis=0)
        best = int(np.argmin(np.round(score, 12)))
        # the probability of the best against the others, with at most 20 words taken as independent
        return self.languages[best], float(1 / np.exp((score[best] - score) * np.log(10) * min(len(words), 20)).sum())


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[tuple]]:
    """Languages and counts of the model, from documents with ``lang`` (doc_id, text, lang)."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return [], []
    languages = [r["lang"] for r in sorted(sizes, key=lambda r: (-r["count"], r["lang"]))]
    # a hash threshold thins a language out before its first ``sample`` by hash are taken exactly
    room = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, 1.5 * sample / r["count"]))])
    thin = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < room[F.col("lang")] * (1 << 20)
    some = common.bounded_sample(usable.filter(thin), sample, "lang", "doc_id")
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    words = (some.select(number[F.col("lang")].alias("l"), F.explode(_words("text")).alias("g"))
             .groupBy("l", "g").agg(F.count(F.lit(1)).alias("c")))
    words = common.written(words, "words")
    padded = F.concat(F.lit(" "), F.col("g"), F.lit(" "))
    tables, share = [words.select(F.lit(0).alias("n"), "l", "g", "c")], max(1, MODEL_ROWS // len(languages))
    for n in range(1, LONGEST + 1):
        cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: padded.substr(i, F.lit(n)))
        grams = words.select("l", "c", F.explode(cuts).alias("g")).filter((F.length("g") == n) & (F.col("g") != " "))
        tables.append(grams.groupBy("l", "g").agg(F.sum("c").alias("c")).select(F.lit(n).alias("n"), "l", "g", "c"))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    rank = F.row_number().over(Window.partitionBy("n", "l").orderBy(F.desc("c"), "g"))
    limit = F.when(F.col("n") == 0, min(WORDS, share // 2)).otherwise(min(GRAMS, share // (2 * LONGEST)))
    top = every.withColumn("r", rank).filter((F.col("r") <= WORDS) & (F.col("r") <= limit)).select("n", "l", "g", "c")
    found = top.toArrow()
    return languages, list(zip(*(found.column(c).to_pylist() for c in ("n", "l", "g", "c"))))


def _predictor(shared: common.Shared):
    @F.arrow_udf(T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType()))
    def predict(texts: pa.Array) -> pa.Array:
        model, out = shared.value, []
        for at in range(0, len(texts), common.SLICE_ROWS):
            out += map(model.predict, texts[at:at + common.SLICE_ROWS].to_pylist())
        return pa.StructArray.from_arrays([pa.array([p for p, _ in out], type=pa.string()),
                                           pa.array([s for _, s in out], type=pa.float64())], names=["lang_pred", "score"])
    return predict


def identify(docs: DataFrame, training: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with lang_pred and score; ``training`` (doc_id, text, lang) is ``docs`` unless given."""
    common.prepare(docs.sparkSession)
    model = common.Shared(docs.sparkSession, train(docs if training is None else training, sample), lambda x: Model(*x))
    found = docs.withColumn("_found", _predictor(model)("text"))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is told with ``min_score``; unlabelled ones too."""
    training = docs.filter(~common.held_out(F.col("doc_id"), 4, 2))
    found = identify(docs, training)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(*docs.columns)


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = common.held_out(F.col("doc_id"), 4, 2)
    found = identify(docs.select("doc_id", "text"), docs.filter(~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
