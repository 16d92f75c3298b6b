"""Near duplicates by ProbMinHash over weighted word shingles.

A text's shingles are runs of five words, weighted by how often they occur; similarity is the
probability Jaccard index of two weighted sets, which for equal weights is the Jaccard index. Each
shingle sends exponential arrivals, at a rate of its weight, to registers drawn uniformly; a register
keeps the shingle that arrives first, and a shingle stops when its next arrival is later than every
register's. Two texts agree in a register with a probability of their similarity.

Texts that agree in a whole band of registers are candidates. In each bucket, candidates are first
compared with one leader (three rounds: the smallest id, then pseudo-random ones), on their whole
texts. What is not yet in one class is then compared within its buckets, in blocks: a pair is looked
at in the first band it shares, and pairs whose signatures leave a similarity of 0.8 possible are
verified on their texts. So a group of copies is never expanded into its pairs, and no candidate
pair between classes goes untested. Classes are the connected components of verified pairs.

Bounds: at a similarity of 0.8 two texts miss all 32 bands of 5 with a probability of 3e-6, and the
signature filter with less than 3e-4; both fall steeply above it.

What is compared is different texts (by a 128-bit hash), never ids, so rows with equal ids are judged by
their own texts and link nothing through the id.

Defined cases: equal texts are one class; a text of fewer than five words is one shingle; a null or
wordless text, or a null id, is in a class of its own (class_id is the id, class_key null); the class id
is the smallest id in the class; where an id has several texts, classes may share it, and class_key, the
least hash of the class's texts, tells them apart; an empty table gives an empty result; other input
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from . import common

SHINGLE, SIMILARITY = 5, 0.8
REGISTERS, BANDS, ROWS = 256, 32, 5
#: Pairs below this share of equal registers are taken as dissimilar: 3.5 standard errors under 0.8.
LEAST_SHARE = SIMILARITY - 3.5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
LEADER_ROUNDS = 3
#: Rows of a block on either side when what is left of a bucket is compared, and rows of one task's group.
BLOCK, OTHERS, GROUP = 256, 1024, 4096
#: Up to so many ids are broadcast to pick their texts; beyond, Spark joins by shuffle.
MAX_BROADCAST_IDS = 1_000_000

find_words = re.compile(r"[^\W_]+").findall
U64 = np.uint64


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit number for each run of ``size`` words, in order; one for all words of a shorter text."""
    words = find_words(text.lower()) if text else []
    if not words:
        return np.zeros(0, U64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))
    size = min(size, len(w))
    out = np.full(len(w) - size + 1, U64(size))
    for k in range(size):
        out = common.mix64(out ^ w[k:len(w) - size + 1 + k])
    return out


def prob_minhash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """First-arrived shingle of each register, a row per (shingles, weights); empty sets give zeros."""
    first = np.full(len(sets) * registers, np.inf)
    which = np.zeros(len(sets) * registers, U64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    item = np.concatenate([s for s, _ in sets]) if len(doc) else np.zeros(0, U64)
    rate = np.concatenate([w for _, w in sets]).astype(float) if len(doc) else np.zeros(0)
    seen = np.zeros(len(doc))
    step = 0
    while len(doc):
        step += 1
        draw = common.mix64(item ^ U64(step * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        seen = seen - np.log(((draw >> U64(11)).astype(float) + 1) * 2.0 ** -53) / rate
        at = doc * registers + (common.mix64(draw) % U64(registers)).astype(np.int64)
        earlier = np.flatnonzero(seen < first[at])
        earlier = earlier[np.argsort(-seen[earlier], kind="stable")]  # of several, the first to arrive is written last
        first[at[earlier]] = seen[earlier]
        which[at[earlier]] = item[earlier]
        latest = first.reshape(-1, registers).max(axis=1)
        on = seen < latest[doc]
        doc, item, rate, seen = doc[on], item[on], rate[on], seen[on]
    return which.reshape(-1, registers)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands, different for equal registers of different bands."""
    keys = np.tile(np.arange(BANDS, dtype=U64), (len(signature), 1))
    for r in range(ROWS):
        keys = common.mix64(keys ^ signature[:, r:BANDS * ROWS:ROWS])
    return keys.astype(np.int64)


SIGNATURE = T.StructType().add("n", T.IntegerType()).add("bands", T.ArrayType(T.LongType())).add("sketch", T.BinaryType())


@F.arrow_udf(SIGNATURE)
def _signature(texts: pa.Array) -> pa.Array:
    counts, keys, sketches = [], [], []
    for at in range(0, len(texts), common.SLICE_ROWS):
        sets = [np.unique(shingles(t), return_counts=True) for t in texts[at:at + common.SLICE_ROWS].to_pylist()]
        found = prob_minhash(sets)
        counts += [len(s) for s, _ in sets]
        keys.append(band_keys(found).ravel())
        sketches += [row.tobytes() for row in (common.mix64(found) >> U64(56)).astype(np.uint8)]
    bands = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), BANDS)
    return pa.StructArray.from_arrays([pa.array(counts, type=pa.int32()), bands.cast(pa.list_(pa.int64())),
                                       pa.array(sketches, type=pa.binary())], names=["n", "bands", "sketch"])


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard index of two weighted sets (sorted items, weights), exactly."""
    items = np.union1d(a[0], b[0])
    if not len(items):
        return 0.0
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, a[0])], y[np.searchsorted(items, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    common_ = np.flatnonzero((x > 0) & (y > 0))
    upto = np.searchsorted(ratio, ratio[common_], side="right")  # there x'/x is the larger share, beyond it y'/y
    below, above = np.concatenate([[0], np.cumsum(x)])[upto], y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]
    return float((1 / (below / x[common_] + above / y[common_])).sum())


@F.arrow_udf(T.DoubleType())
def _similarity(left: pa.Array, right: pa.Array) -> pa.Array:
    out, last = [], (None, None)
    for at in range(0, len(left), common.SLICE_ROWS):
        cut = slice(at, at + common.SLICE_ROWS)
        for a, b in zip(left[cut].to_pylist(), right[cut].to_pylist()):
            if last[0] != a:
                last = a, np.unique(shingles(a), return_counts=True)
            out.append(probability_jaccard(last[1], np.unique(shingles(b), return_counts=True)))
    return pa.array(out, type=pa.float64())


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("_b"))
    both = pairs.join(b, "b").join(a, "a")
    return both.where(_similarity("_a", "_b") >= SIMILARITY).select("a", "b")


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, comp of all ``nodes``."""
    found = connected_components(edges).select("node", F.col("component").alias("_c"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("_c", "node").alias("comp"))


def compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of different classes that first meet in their bucket and may be similar.

    ``rows`` are of whole blocks: bkey, rb, gb, rest (on the side whose class is not the bucket's
    largest), band, node, comp, in_rest, place, bands, sketch. The result has a row per node ``a`` and
    pair of places ``p`` and ``q``, with its partners ``b``.
    """
    out = []
    for _, block in rows.groupby(["bkey", "rb", "gb"], sort=False):
        side = block["rest"].to_numpy()
        l, r = block[side], block[~side]
        if not len(l) or not len(r):
            continue
        ln, rn = l["node"].to_numpy(), r["node"].to_numpy()
        ok = l["comp"].to_numpy()[:, None] != r["comp"].to_numpy()[None, :]
        ok &= ~r["in_rest"].to_numpy()[None, :] | (ln[:, None] < rn[None, :])
        lk, rk = np.stack(l["bands"].to_list()), np.stack(r["bands"].to_list())
        for k in range(int(block["band"].iat[0])):
            ok &= lk[:, k][:, None] != rk[:, k][None, :]
        i, j = np.nonzero(ok)
        ls = np.frombuffer(b"".join(l["sketch"]), np.uint8).reshape(len(l), -1)
        rs = np.frombuffer(b"".join(r["sketch"]), np.uint8).reshape(len(r), -1)
        for at in range(0, len(i), 20_000):
            x, y = i[at:at + 20_000], j[at:at + 20_000]
            near = (ls[x] == rs[y]).mean(axis=1) >= LEAST_SHARE
            out.append(pd.DataFrame({"a": ln[x[near]], "b": rn[y[near]], "p": l["place"].to_numpy()[x[near]], "q": r["place"].to_numpy()[y[near]]}))
    if not any(map(len, out)):
        return pd.DataFrame({"p": [], "q": [], "a": [], "b": []}).astype({"p": "int64", "q": "int64", "a": "int64"})
    found = pd.concat(out)
    return found.groupby(["p", "q", "a"], sort=False)["b"].agg(list).reset_index()


def verify_blocks(pairs: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """The pairs (a, one of b) whose texts reach the similarity; a text is cut into shingles once."""
    at = texts.groupby("node")["text"].agg(list)  # more than one text where an id has several
    cut = common.Memo(lambda node: [np.unique(shingles(t), return_counts=True) for t in at[node]], 20_000)
    found = [(a, b) for a, others in zip(pairs["a"], pairs["b"]) for b in others
             if any(probability_jaccard(x, y) >= SIMILARITY for x in cut[a] for y in cut[b])]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _places(buckets: DataFrame) -> DataFrame:
    """node, place: nodes that share their least leader are dealt to places of about ``BLOCK`` nodes."""
    least = buckets.groupBy("node").agg(F.min("leader").alias("lead"))
    n = least.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n"))
    return least.join(n, "lead").select("node", F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("n"))).alias("place"))


def _left_over(buckets: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified pairs (a, b) between classes of the same bucket: candidates by blocks of signatures, then
    blocks of texts, so that neither a pair nor its texts are a row of their own."""
    rows = buckets.select("bkey", "band", "node").join(comps, "node")
    sizes = rows.groupBy("bkey", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bkey").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all")) \
                 .where("comps > 1").select("bkey", F.col("top.comp").alias("_top"), "all", (F.col("all") - F.col("top.n")).alias("left"))
    rows = common.written(rows.join(sizes, "bkey").withColumn("in_rest", F.col("comp") != F.col("_top")), "open")
    n = rows.count()
    blocks = lambda size, per: F.ceil(F.col(size) / per).cast("int")
    mine = lambda size, per, salt: F.pmod(F.xxhash64("node", F.lit(salt)), blocks(size, per)).cast("int")
    each = lambda size, per: F.explode(F.sequence(F.lit(0), blocks(size, per) - 1))
    rest = rows.where("in_rest").select("*", F.lit(True).alias("rest"), mine("left", BLOCK, 1).alias("rb")).withColumn("gb", each("all", OTHERS))
    others = rows.select("*", F.lit(False).alias("rest"), mine("all", OTHERS, 2).alias("gb")).withColumn("rb", each("left", BLOCK))
    dealt = rest.unionByName(others).select("bkey", "rb", "gb", "rest", "band", "node", "comp", "in_rest")
    places = common.written(_places(buckets), "places")
    dealt = dealt.join(reps.select("node", "bands", "sketch"), "node").join(places, "node")
    group = F.pmod(F.xxhash64("bkey", "rb", "gb"), F.lit(1 + 2 * n // GROUP))
    near = dealt.groupBy(group.alias("g")).applyInPandas(compare_blocks, "p long, q long, a long, b array<long>")
    near = common.written(near, "near")
    # a task verifies the pairs of some pairs of places, and gets the texts of these places once
    size = near.count()
    task = F.pmod(F.xxhash64(F.least("p", "q"), F.greatest("p", "q")), F.lit(1 + size // 256)).alias("task")
    pairs = near.select(task, "a", "b")
    meet = near.select(task, F.col("p").alias("place")).union(near.select(task, F.col("q").alias("place"))).distinct()
    held = texts.join(places, "node").join(meet, "place").select("task", "node", "text")
    return pairs.groupBy("task").cogroup(held.groupBy("task")).applyInPandas(verify_blocks, "a long, b long").distinct()


def _text_key() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, key, text_id, comp (the class), top (the class's first doc_id and key) and class_key of each row of
    ``docs``; the last four are null for rows that aren't compared."""
    spark = docs.sparkSession
    common.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = docs.select("doc_id", _text_key().alias("key"), _signature("text").alias("s")) \
                 .select("doc_id", "key", "s.n", "s.bands", "s.sketch")
    signed = common.written(signed, "signatures")
    usable = signed.where("doc_id is not null and n > 0")
    firsts = usable.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    firsts = common.written(firsts.withColumn("node", F.monotonically_increasing_id()), "nodes")
    reps = usable.join(firsts, ["key", "doc_id"]).dropDuplicates(["node"])
    reps = common.written(reps, "texts")
    rows = reps.select("node", F.posexplode("bands").alias("band", "bkey"))
    ends = rows.groupBy("bkey").agg(F.min("node").alias("leader"), F.max("node").alias("_most")).where("leader < _most").drop("_most")
    buckets = common.written(rows.join(ends, "bkey"), "buckets")
    wanted = buckets.select("node").distinct().join(reps.select("node", "doc_id", "key"), "node")
    wanted = common.written(wanted, "wanted")
    ids = wanted.withColumnRenamed("key", "_key")
    if wanted.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.withColumn("_key", _text_key()).join(ids, ["doc_id", "_key"]).select("node", "text")
    texts = common.written(texts.dropDuplicates(["node"]), "candidates")
    nodes = wanted.select("node").distinct()

    edges = tested = comps = None
    for k in range(LEADER_ROUNDS):
        if k == 0:
            pairs = buckets.where("leader < node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        else:
            rows = buckets.select("bkey", "node").join(comps, "node")
            # the classes of a bucket and a leader picked by hash, as one aggregate per bucket
            lead = rows.groupBy("bkey").agg(F.min(F.struct(F.xxhash64("bkey", "node", F.lit(k)).alias("h"), "node", "comp")).alias("l"),
                                            F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x < _y")
            pairs = rows.join(lead, "bkey").where(F.col("comp") != F.col("l.comp"))
            pairs = pairs.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct()
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = common.written(pairs, "pairs")
        found = common.written(_similar(pairs, texts), "links")
        tested = pairs if tested is None else tested.union(pairs)
        edges = found if edges is None else edges.union(found)
        comps = common.written(_components(nodes, edges), "classes")
    edges = edges.union(common.written(_left_over(buckets, comps, reps, texts), "links"))
    comps = common.written(_components(nodes, edges), "classes")

    # what a class has in common is worked out per different text, and joined to the rows once
    texts = firsts.withColumnRenamed("doc_id", "text_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    tops = texts.groupBy("comp").agg(F.min(F.struct(F.col("text_id").alias("doc_id"), "key")).alias("top"), F.min("key").alias("class_key"))
    rows = signed.select("doc_id", "key", "n").join(texts.join(tops, "comp").drop("node"), "key", "left")
    compared = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.select("doc_id", "key", *(F.when(compared, F.col(c)).alias(c) for c in ("text_id", "comp", "top", "class_key")))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_id (smallest id with the same text), class_id and class_key of each row of ``docs`` (doc_id, text)."""
    rows = _judged(docs)
    return rows.select("doc_id", F.coalesce("text_id", "doc_id").alias("text_id"), F.coalesce("top.doc_id", "doc_id").alias("class_id"),
                       F.lower(F.hex("class_key")).alias("class_key"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id; null ids and wordless texts all stay.

    Where an id has several texts, each text is judged for itself; of rows equal in id and text one stays.
    """
    found = common.written(_judged(docs), "judged")
    small = lambda ids: F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    gone = found.where((F.col("doc_id") != F.col("top.doc_id")) | (F.col("key") != F.col("top.key"))).select("doc_id").distinct()
    again = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    # ids that several rows share are judged by id and text
    again = common.written(again, "again")
    once = docs.join(small(again), "doc_id", "left_anti").join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    shared = docs.join(small(again), "doc_id", "left_semi").select(*docs.columns)
    kept = found.where("comp is null or doc_id = top.doc_id and key = top.key").join(again, "doc_id", "left_semi")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("key").alias("_text"), F.col("comp").isNotNull().alias("_one")).distinct()
    same = (F.col("doc_id") == F.col("_id")) & _text_key().eqNullSafe(F.col("_text"))
    shared = common.written(shared.join(kept, same).drop("_id", "_text"), "shared")
    some = shared.where("_one").withColumn("_text", _text_key()).dropDuplicates(["doc_id", "_text"])
    return once.unionByName(some.select(*docs.columns)).unionByName(shared.where("not _one").select(*docs.columns))


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return classes(common.read(spark, sf_dir, "documents"))
