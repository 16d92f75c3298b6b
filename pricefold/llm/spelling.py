"""Spelling variants by finite-state composition: vocabulary o one edit o vocabulary.

Words are counted over whole texts. The vocabulary's minimised acyclic acceptor is composed with a
one-edit transducer and with itself; what the composition accepts are the pairs of words that differ by
exactly one inserted, deleted or replaced code point. It is enumerated per partition of initial states:
a partition starts both acceptors in the state that one prefix leads to, so its pairs share that prefix
and the edit lies behind it. A second pass runs over the reversed words, where the pairs share a suffix.
A pair that shares neither its prefix nor its suffix has its edit in what both leave of a word; these
words (there are some only where a prefix and a suffix are both very frequent) meet by the word without
the code point at the place of the edit, which is the composition's state behind that edit.

Prefixes are as long as it takes that few words share one, so a prefix of a third of all words is split
and a task holds an acceptor of bounded size. Each pass knows what the passes before it have found (the
two words' prefixes, then suffixes, are equal), so each pair counts once and no pair is a row.

Defined cases: null texts have no words; a null doc_id counts as ''; rows with equal ids each count; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEAST_LENGTH, LEAST_COUNT, SLIP, TIMES = 7, 2, 31, 10
#: Code points of the shortest prefix, words that share one at most, rows of a task, words a map task holds.
FIRST_DEPTH, PARTITION, TASK_ROWS, HELD_WORDS = 3, 2048, 8192, 400_000

#: Runs that may give a word, in Latin-1 with A-Z lower-cased: all its letters are one byte there.
find_runs = re.compile(rb"[a-z\xC0-\xFF]{%d,}" % LEAST_LENGTH).findall

WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = "word string, n_near long, best_n long, best string"


def words_of(doc_id: str, text: str) -> Counter:
    """Occurrences of the words of a text, slips (a deleted code point) included."""
    seed, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in Counter(find_runs(text.encode("latin-1", "replace").lower())).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LENGTH:
            out[run] += n
    return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the words, added up within the task."""
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                           pa.array(list(held.values()), pa.int64())], schema=WORDS)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            held.update(words_of(doc_id, text))
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
    yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of the words of ``docs`` (doc_id, text) that occur often enough."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").where("text is not null")
    words = texts.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= LEAST_COUNT)


def minimised(words: list[str]) -> tuple[list[dict], list[bool]]:
    """Arcs and final states of the minimal acceptor of sorted, different words; it starts in state 0."""
    arcs, final, known = [{}], [False], {}
    path, last = [0], ""

    def settle(depth: int) -> None:
        # states of the last word beyond ``depth`` change no more: each becomes the first that is equal to it
        while len(path) - 1 > depth:
            state = path.pop()
            same = known.setdefault((final[state], tuple(arcs[state].items())), state)
            if same != state:
                arcs[path[-1]][last[len(path) - 1]] = same
    for word in words:
        shared = len(os.path.commonprefix((last, word)))
        settle(shared)
        for c in word[shared:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][c] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    settle(0)
    return arcs, final


def composed(words: list[str]) -> Iterator[tuple[str, str]]:
    """Unordered pairs of ``words`` (sorted, different) that differ by exactly one edit, each pair once.

    States of the composition are (left state, whether the edit is made, right state). Until the edit
    both sides are in the same state. The edit is a replacement (two different arcs), or one that only
    the left side reads; then the right side goes on with another code point, so that of several
    alignments only the one at the end of the common prefix is taken.
    """
    head = os.path.commonprefix((words[0], words[-1])) if len(words) > 1 else ""
    arcs, final = minimised([w[len(head):] for w in words])
    apart = set()  # pairs of states that accept no string in common

    def both(x: int, y: int, other_than: str | None = None) -> list[str]:
        if (x, y, other_than) in apart:
            return []
        found, stack = [], [(x, y, "")]
        while stack:
            p, q, s = stack.pop()
            if final[p] and final[q]:
                found.append(s)
            here, there = arcs[p], arcs[q]
            stack += [(here[c], there[c], s + c) for c in here if c in there and (s or c != other_than)]
        if not found:
            apart.add((x, y, other_than))
        return found

    stack = [(0, head)]
    while stack:
        state, prefix = stack.pop()
        ways = list(arcs[state].items())
        for k, (c, x) in enumerate(ways):
            for d, y in ways[k + 1:]:
                for rest in both(x, y):
                    yield prefix + c + rest, prefix + d + rest
            for rest in both(x, state, c):
                yield prefix + c + rest, prefix + rest
            stack.append((x, prefix + c))


def near_in_partitions(rows: pd.DataFrame) -> pd.DataFrame:
    """n_near, best_n and best that the words of whole partitions have there.

    ``rows``: key, seen (the partition of an earlier pass; pairs that share it were found there), n and
    word, reversed where ``back``.
    """
    near: dict[str, list] = {}
    for _, part in rows.groupby(["back", "key"], sort=False):
        if len(part) < 2:
            continue
        back = bool(part["back"].iat[0])
        held = {(w[::-1] if back else w): (w, int(n), seen) for w, n, seen in zip(part["word"], part["n"], part["seen"])}
        for x, y in composed(sorted(held)):
            u, v = held[x], held[y]
            if back and u[2] == v[2]:
                continue
            for (word, _, _), (other, n, _) in ((u, v), (v, u)):
                best = near.setdefault(word, [0, 0, ""])
                best[0] += 1
                if n > best[1] or n == best[1] and other < best[2]:
                    best[1:] = n, other
    return pd.DataFrame([(w, *x) for w, x in near.items()], columns=["word", "n_near", "best_n", "best"]) \
             .astype({"n_near": "int64", "best_n": "int64"})


def partitions(words: DataFrame, name: str, most: int) -> DataFrame:
    """``words`` with ``depth`` and the prefix ``key`` of column ``name`` that at most ``most`` words share."""
    depth, done, left = FIRST_DEPTH, None, words
    while True:
        keyed = left.withColumn("key", F.substring(name, 1, depth)).withColumn("depth", F.lit(depth))
        hot = common.written(keyed.groupBy("key").count().where(F.col("count") > most).select("key"), "hot")
        if hot.isEmpty():
            return keyed if done is None else done.unionByName(keyed)
        cold = keyed.join(hot, "key", "left_anti")
        done = cold if done is None else done.unionByName(cold)
        left = common.written(keyed.join(hot, "key", "left_semi").drop("key", "depth"), "left")
        depth = max(depth + 1, depth * 4 // 3)


def behind_edit(words: DataFrame) -> DataFrame:
    """Near words of pairs that share neither prefix nor suffix: they meet behind the edit.

    ``words``: word, n, head and tail keys and their depths. The edit's place is at or behind the end of
    the word less its tail's depth, and before its head's depth; most words have no such place.
    """
    size = F.length("word")
    deep = words.withColumn("first", F.greatest(F.lit(0), size - F.col("tail_depth"))) \
                .withColumn("last", F.least(size, F.col("head_depth")) - 1).where("first <= last")
    deep = deep.withColumn("at", F.explode(F.sequence("first", "last")))
    deep = deep.select("word", "n", "head", "tail", "at", F.concat(F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 2)")).alias("rest"))
    deep = common.written(deep, "deep")
    if deep.isEmpty():
        return None
    a = deep.select("at", "rest", *(F.col(c).alias(f"{c}_a") for c in ("word", "n", "head", "tail")))
    b = deep.select("at", "rest", *(F.col(c).alias(f"{c}_b") for c in ("word", "n", "head", "tail")))
    shorter = words.select(F.col("word").alias("rest"), *(F.col(c).alias(f"{c}_b") for c in ("word", "n", "head", "tail")))
    kept = ["word_a", "n_a", "word_b", "n_b"]
    new = (F.col("head_a") != F.col("head_b")) & (F.col("tail_a") != F.col("tail_b"))
    pairs = a.join(b, ["at", "rest"]).where(new & (F.col("word_a") < F.col("word_b"))).select(*kept)
    pairs = pairs.unionByName(a.join(shorter, "rest").where(new).select(*kept)).distinct()
    way = lambda x, y: pairs.select(F.col(f"word_{x}").alias("word"), F.lit(1).cast("long").alias("n_near"),
                                    F.col(f"n_{y}").alias("best_n"), F.col(f"word_{y}").alias("best"))
    return way("a", "b").unionByName(way("b", "a"))


def near_words(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """word, n_near and the near word of largest n (ties: the smallest) of ``words`` (word, n) that have one."""
    spark = words.sparkSession
    heads = partitions(words, "word", most).withColumnRenamed("key", "head").withColumnRenamed("depth", "head_depth")
    heads = common.written(heads.withColumn("drow", F.reverse("word")), "heads")
    tails = partitions(heads, "drow", most).withColumnRenamed("key", "tail").withColumnRenamed("depth", "tail_depth")
    tails = common.written(tails.drop("drow"), "tails")
    ahead = tails.select("word", "n", F.lit(False).alias("back"), F.col("head").alias("key"), F.lit("").alias("seen"))
    back = tails.select("word", "n", F.lit(True).alias("back"), F.col("tail").alias("key"), F.col("head").alias("seen"))
    tasks = 1 + 2 * words.count() // TASK_ROWS
    dealt = ahead.unionByName(back).withColumn("task", F.pmod(F.xxhash64("back", "key"), F.lit(tasks)))
    # few bytes, much work: an own number of partitions, which adaptive execution leaves as it is
    slots = max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(int(min(slots, tasks)), "task")
    found = dealt.groupBy("task").applyInPandas(lambda rows: near_in_partitions(rows), NEAR)
    if (more := behind_edit(tails)) is not None:
        found = found.unionByName(more)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
                .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and the end of its chain of forms, by pointer doubling; a form's n is ten times its word's at
    least, so chains end and are short."""
    chain = common.written(forms.select("word", F.col("form").alias("root")), "chain")
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        step = chain.join(on, "root", "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved"))
        step = common.written(step, "chain")
        chain = step.drop("moved")
        if step.where("moved").isEmpty():
            return chain


def variants(docs: DataFrame, most: int = PARTITION) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``docs`` (doc_id, text)."""
    common.prepare(docs.sparkSession)
    words = common.written(vocabulary(docs), "words")
    form = F.col("best_n") >= TIMES * F.col("n")
    out = words.join(near_words(words, most), "word", "left")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best")).alias("form"),
                     F.when(form, F.col("best_n")).alias("form_n"))
    out = common.written(out, "forms")
    ends = roots(out.where("form is not null"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(common.read(spark, sf_dir, "documents"))
