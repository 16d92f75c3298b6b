"""Text encoder for the vector matcher (the hook that a pretrained model would take).

Hashed character n-grams weighted by inverse document frequency over the
catalog, of unit length, built with Spark ML.  Anything that maps a frame with
a ``text`` column to the same frame with an ``embedding`` column fits in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[DataFrame], DataFrame]
DIMENSIONS, GRAM = 512, 3


def _grams(df: DataFrame) -> DataFrame:
    """Character n-grams of the lower-cased words with blanks at their ends."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    chars = F.when(F.size(words) > 0, F.split(padded, "")).otherwise(F.array().cast("array<string>"))
    return NGram(n=GRAM, inputCol="_chars", outputCol="_grams").transform(df.withColumn("_chars", chars)).drop("_chars")


def hashed_ngrams(catalog_texts: DataFrame, dimensions: int = DIMENSIONS) -> Encoder:
    """An encoder whose weights come from ``catalog_texts`` (text); one aggregation over the catalog."""
    tf = HashingTF(numFeatures=dimensions, inputCol="_grams", outputCol="_tf")
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(tf.transform(_grams(catalog_texts.select("text"))))
    unit = Normalizer(inputCol="_idf", outputCol="_unit")

    def encode(df: DataFrame) -> DataFrame:
        out = unit.transform(idf.transform(tf.transform(_grams(df))))
        return out.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_grams", "_tf", "_idf", "_unit")
    return encode
