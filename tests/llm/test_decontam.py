import hashlib
import re

from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import decontam

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(documents, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in documents:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (items_ := windows.get(tuple(w[i:i + n]))):
                    hit |= set(range(i, i + n))
                    found |= items_
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_query_equals_brute_force(spark):
    want = brute([(d["doc_id"], d["text"]) for d in table(SF, "documents")],
                 [(b["item_id"], b["text"]) for b in table(SF, "benchmark")])
    got = [tuple(r) for r in decontam.op5_query(spark, SF).collect()]
    assert sorted(got) == sorted(want) and any(r[5] for r in got)


CASES = [(1, "x a b c d e f g h i j y"), (2, "A B C D E F G H I J"), (3, "a b c d e f g h i"), (4, None), (5, ""),
         (6, "... --"), (7, "one É two"), (8, "É É é"), (1, "tiny"), (None, "q a b c d e f g h i j k l m"),
         (9, "z " * 4000 + "a b c d e f g h i j")]
ITEMS = [(10, "a b c d e f g h i j"), (2, "É"), (3, None), (4, ""), (None, "tiny"), (10, "c d e f g h i j k l m"),
         (7, "b c d e f g h i j k z"), (8, "one é two")]


def check(spark, max_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    d = docs(spark, CASES).withColumn("items", F.lit("clash")).withColumn("n_words", F.lit(-1))
    got = decontam.find(d, items, max_words=max_words).select(
        "doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256), F.col("n_hit") > 0)
    assert sorted(map(str, got.collect())) == sorted(
        str(r) for r in spark.createDataFrame(brute(CASES, ITEMS), got.schema).collect())


def test_cases(spark):
    check(spark, decontam.MAX_WORDS)


def test_many_passes_find_the_same(spark):
    check(spark, 12)


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE", 7)
    check(spark, decontam.MAX_WORDS)


def test_empty_tables_and_clean(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    d = docs(spark, CASES)
    assert decontam.clean(d, items).count() == len(CASES)
    assert decontam.find(docs(spark, []), items).collect() == []
    full = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.clean(d, full)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 6}
