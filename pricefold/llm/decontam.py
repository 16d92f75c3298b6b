"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark: 10 consecutive words of an item, or all words of a shorter
one. Per window length, a shift table over blocks of two words tells how far the search may skip;
blocks that end a window lead to a bucket by the window's first block, and the words themselves are
compared there. Texts are searched whole, in their partition: no shuffle.

The windows are sent to all executors, in chunks of at most ``MAX_WORDS`` benchmark words each. A
larger benchmark takes several passes over the documents, each joining its hits to those before, and
every pass is written so that an executor's loss repeats one pass only.

Defined cases: a null or wordless text has no words and no hits; a null or wordless item has no
windows; a null item id counts as the item with an empty id; equal item ids are one item; repeated
documents are judged each; an empty benchmark hits nothing; input columns named as an added one are
replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 10
#: Benchmark words searched for in one pass, which bounds the broadcast (some 100 bytes a word).
MAX_WORDS = 1_000_000
#: Words of an item in one row, which bounds a row whatever the item's length.
PIECE = 5_000

#: Fixed value: a word, after A-Z are lower-cased. As bytes it is the same, for UTF-8 bytes of other letters are above 7F.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
find_words = re.compile(rb"[0-9a-z\x80-\xff]+").findall

SPANS = T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType()))
RESULT = T.StructType().add("n_words", T.LongType()).add("spans", SPANS).add("items", T.ArrayType(T.StringType()))


def words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), 0)


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item (text) and words: runs of an item's words that together hold each of its windows once."""
    item = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last, F.lit(PIECE)))
    return (item.withColumn("at", starts)
            .select("item", F.slice("words", F.col("at") + 1, PIECE + window - 1).alias("words")))


class WuManber:
    """Shift tables and buckets for windows, which are tuples of words, grouped by their length."""

    def __init__(self, runs: list[tuple[str, list[str]]], window: int = WINDOW):
        items: dict[tuple, set] = {}
        for item, found in runs:
            found = [w.encode() for w in found]
            for i in range(max(1, len(found) - window + 1)):
                items.setdefault(tuple(found[i:i + window]), set()).add(item)
        self.items = items
        self.tables = []
        for size in sorted({len(w) for w in items}):
            block = min(2, size)
            shift: dict[tuple, int] = {}
            bucket: dict[tuple, dict] = {}
            for w in (w for w in items if len(w) == size):
                for end in range(block, size + 1):
                    b = w[end - block:end]
                    shift[b] = min(shift.get(b, size), size - end)
                bucket.setdefault(w[-block:], {}).setdefault(w[:block], []).append(w)
            self.tables.append((size, block, shift, bucket))

    def search(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words [start, end) that windows cover, merged, and the items whose windows occur."""
        spans, found = [], set()
        n = len(text)
        for size, block, shift, bucket in self.tables:
            skip, end, lookup = size - block + 1, size, shift.get
            while end <= n:
                step = lookup(tuple(text[end - block:end]), skip)
                if step:
                    end += step
                    continue
                start = end - size
                for w in bucket[tuple(text[end - block:end])].get(tuple(text[start:start + block]), ()):
                    if w == tuple(text[start:end]):
                        spans.append((start, end))
                        found |= self.items[w]
                end += 1
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _searcher(shared: common.Shared):
    @F.arrow_udf(RESULT)
    def search(texts: pa.Array) -> pa.Array:
        engine, out = shared.value, []
        for at in range(0, len(texts), common.SLICE_ROWS):
            for t in texts[at:at + common.SLICE_ROWS].cast(pa.binary()).to_pylist():
                found = find_words(t.lower()) if t else []
                spans, items = engine.search(found)
                out.append({"n_words": len(found), "spans": [{"start": a, "end": b} for a, b in spans],
                            "items": sorted(items)})
        return pa.array(out, type=pa.struct([
            ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string()))]))
    return search


@F.arrow_udf(SPANS)
def _joined(left: pa.Array, right: pa.Array) -> pa.Array:
    out = [[{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in x + y])]
           for x, y in zip(left.to_pylist(), right.to_pylist())]
    return pa.array(out, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with n_words, spans (of hit words), items (sorted ids as text) and n_hit."""
    spark = docs.sparkSession
    common.prepare(spark)
    runs = windows(benchmark, window)
    total = runs.agg(F.sum(F.size("words"))).first()[0] or 0
    passes = -(-total // max_words) if total > max_words else 1
    if passes > 1:
        passes *= 2  # chunks by hash are uneven
        runs = common.written(runs, "windows")
    out = docs.drop("n_words", "spans", "items", "n_hit")
    for k in range(passes):
        mine = runs if passes == 1 else runs.filter(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == k)
        shared = common.Shared(spark, ([(r["item"], r["words"]) for r in mine.collect()], window), lambda x: WuManber(*x))
        out = out.withColumn("_new", _searcher(shared)("text"))
        new = {"n_words": F.col("_new.n_words"), "spans": F.col("_new.spans"), "items": F.col("_new.items")}
        if k:
            new |= {"spans": _joined("spans", "_new.spans"), "items": F.array_sort(F.array_union("items", "_new.items"))}
        out = out.withColumns(new).drop("_new")
        if passes > 1:
            out = common.written(out, "hits")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.withColumn("n_hit", covered)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with their columns."""
    return find(docs, benchmark).filter("n_hit = 0").select(*docs.columns)


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each document the benchmark's windows cover."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find(docs, common.read(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
