"""Token ids in ORC files.

A row per document: its ids as ``array<int>``, which ORC stores with integer run-length encoding, and
row indexes plus a Bloom filter on ``doc_id``, so a reader that asks for some documents skips files,
stripes and row groups by metadata, and stripes are read in parallel. Documents are range-partitioned
and sorted by id; a file is one partition, and within it each row knows how many ids precede it in
the file (``local_start``). A document's global ``start`` is that plus the ids of all files before,
a sum over one number per file.

Defined cases: a null text is an empty one and yields the end id alone; a text that spells an added token
of the tokenizer (such as <|endoftext|>) has that token's id there, as the library gives it; a null id sorts first;
repeated rows are written once each, next to each other; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

END_ID = 2
END = np.int32(END_ID).tobytes()
ORC_OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
               "orc.row.index.stride": "2000", "orc.stripe.size": str(64 << 20), "compression": "snappy"}
SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"

#: Fixed value: how the byte-level tokenizer cuts a text before it merges bytes; merges never cross a cut.
#: This form holds for the characters up to U+024F, but for some signs that are neither letter nor digit here.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: A text with any other character, or with an added token, is encoded whole.
UNUSUAL = r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]"


def byte_letters() -> dict[int, str]:
    """Fixed value: the letter that stands for each byte in a byte-level vocabulary (printable ones for themselves)."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts. Each piece of a text is encoded once and remembered, up to a bound."""

    loaded: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # a token that the file adds to the vocabulary is one id wherever it stands: such texts are encoded whole, too
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.unusual = re.compile(PIECES).findall, re.compile("|".join([UNUSUAL, *added])).search
        letters, tokenize = byte_letters(), self.tokenizer.model.tokenize
        self.known = common.Memo(lambda piece: array("i", [
            t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))]).tobytes(), 700_000)

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def ids(self, text: str) -> np.ndarray:
        if self.unusual(text):
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32).tobytes()
        else:
            found = b"".join(map(self.known.__getitem__, self.pieces(text)))
        return np.frombuffer(found + END, dtype=np.int32)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = Encoder.of(path or tokenizer_path()), TaskContext.get().partitionId(), 0
        for batch in common.slices(batches):
            rows = [encoder.ids(t or "") for t in batch.column("text").to_pylist()]
            counts = np.array([len(r) for r in rows], dtype=np.int64)
            ends = np.cumsum(counts)
            ids = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), np.concatenate(rows))
            yield pa.record_batch([pa.array(np.full(len(rows), part, dtype=np.int32)), batch.column("doc_id"),
                                   pa.array(start + ends - counts), pa.array(counts), ids],
                                  names=["part", "doc_id", "local_start", "n_tokens", "ids"])
            start += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write them as ORC in ascending doc_id order.

    ``vocabulary`` is the tokenizer's file on every executor; None: the installed byte_bpe_50k.json.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    tie = F.xxhash64("text")  # a document id that many rows share is still cut into many partitions
    ordered = (rows.withColumn("_tie", tie).repartitionByRange("doc_id", "_tie")
               .sortWithinPartitions("doc_id", "_tie").select("doc_id", "text"))
    ordered.mapInArrow(_encode(vocabulary), SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids from the files; ``where`` on doc_id is pushed down to the ORC reader."""
    files = spark.read.schema(SCHEMA).orc(path)
    before, base = 0, []
    for part, n in sorted(files.groupBy("part").agg(F.sum("n_tokens")).collect()):  # one row per file
        base.append((part, before))
        before += n
    bases = F.broadcast(spark.createDataFrame(base, "part int, _base long"))
    rows = files if where is None else files.filter(where)
    return rows.join(bases, "part").select(
        "doc_id", (F.col("_base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


@F.arrow_udf(T.LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    values, at = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
    return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])], type=pa.int64())


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, count and checksum of every document's ids, from the written ORC files."""
    path = common.scratch(spark, "tokens")
    write_tokens(common.read(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))
