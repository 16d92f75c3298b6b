"""Source divergence audit: how far the word use of each source is from the others of its language.

Terms are runs of letters (A-Z, a-z and every character beyond ASCII); only A-Z are lower-cased. A
language keeps the ``V`` terms that at least ten of its documents hold. A group (language, source) gives
every kept term a price ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, ``N`` the group's occurrences of
kept terms; the language as a whole does the same (``q``). A term's cost is ``floor((p - q)^2 / (p + q))``.

Pair-task sparse merge: a group is its sorted array of (term id, count), cut into buckets of terms so
that no array grows with the vocabulary. Groups are dealt to tiles; a task co-groups the arrays of two
tiles in one bucket and merges every unordered pair of its groups: a galloping intersection finds the
terms that both hold, terms that one side holds are priced against the other's price of nothing, and
the terms that both lack have one cost in common. The cost is the same both ways, so a merge serves two
rows. Counting is done within the map tasks, so a source with a third of all rows is no hot key.

Defined cases: null text, language or source count as ''; a text without terms adds none, but its group
exists; a language without kept terms has pairs of value 0 and no term rows; a language of one source
has no pairs; repeated rows are documents of their own; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

LEAST_DOCS, SCALE, ADDED, TOP_TERMS = 10, 1_000_000_000, 2, 10
#: Kept terms of a bucket, sources of a tile (on average), and different terms that a map task holds.
BUCKET_TERMS, TILE, HELD_TERMS = 1 << 15, 8, 300_000

#: Bytes of UTF-8 that are no part of a term become blanks, A-Z become a-z.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _rows(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        terms = [b"", *n]  # the empty term says that the group exists
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
             pa.array([0, *(docs[t] for t in n)], pa.int64())], schema=COUNTS)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group, added up within the task."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("lang", "source")]
        for lang, source, text in zip(*columns, batch.column("text").cast(pa.binary()).to_pylist()):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = text.translate(LETTERS).split()
            size -= len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n)
        if size > HELD_TERMS:
            yield from _rows(held)
            held, size = {}, 0
    yield from _rows(held)


def price(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 (count + 2) / (total + 2 terms))`` by decimals, so no product overflows."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + ADDED), wide(total + ADDED * terms)) + 1


def prices(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same prices of an array of counts."""
    below = total + ADDED * terms
    if len(counts) and int(counts.max()) > 9_000_000_000:
        return np.array([1 + SCALE * (int(c) + ADDED) // below for c in counts], dtype=np.int64)
    return 1 + SCALE * (counts + ADDED) // below


def cost(p, q):
    return (p - q) * (p - q) // (p + q)


def gallop(few: np.ndarray, many: np.ndarray, run: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two sorted arrays of the items that both hold.

    Runs of the shorter array stride over the longer one: the stride doubles until it is past the run,
    and only that stretch is searched.
    """
    if len(few) > len(many):
        j, i = gallop(many, few, run)
        return i, j
    left, right, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for start in range(0, len(few), run):
        part = few[start:start + run]
        step = run
        while at + step < len(many) and many[at + step] < part[-1]:
            step *= 2
        stretch = many[at:at + step + 1]
        place = np.searchsorted(stretch, part)
        met = np.flatnonzero(place < len(stretch))
        met = met[stretch[place[met]] == part[met]]
        left.append(start + met)
        right.append(at + place[met])
        at += int(place[-1])
    return np.concatenate(left), np.concatenate(right)


def divergence(a: tuple, b: tuple, terms: int) -> int:
    """Cost of two groups (ids, prices, price of an absent term) over the ``terms`` terms of a bucket."""
    (ids, p, none_p), (others, q, none_q) = a, b
    i, j = gallop(ids, others)
    one_side = cost(p, none_q).sum() - cost(p[i], none_q).sum() + cost(none_p, q).sum() - cost(none_p, q[j]).sum()
    absent = terms - len(ids) - len(others) + len(i)
    return int(cost(p[i], q[j]).sum() + one_side) + absent * cost(none_p, none_q)


def merge_tiles(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Cost of each unordered pair of the groups of two tiles in one bucket."""
    def arrays(rows: pd.DataFrame) -> list[tuple]:
        out = []
        for r in rows.itertuples():
            ids, counts = (np.asarray(x if x is not None else [], np.int64) for x in (r.ids, r.counts))
            none = int(prices(np.zeros(1, np.int64), r.total, r.terms)[0]) if r.terms else 1
            out.append((r.source, (ids, prices(counts, r.total, r.terms) if r.terms else counts, none)))
        return out
    found = []
    if len(left) and len(right):
        same, lang, terms = left["i"].iat[0] == left["j"].iat[0], left["lang"].iat[0], int(left["held"].iat[0])
        others = arrays(right)
        found = [(lang, a, b, divergence(x, y, terms)) for a, x in arrays(left) for b, y in others if not same or a < b]
    return pd.DataFrame(found, columns=["lang", "a", "b", "value"]).astype({"value": "int64"})


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank of ``docs`` (lang, source, text)."""
    spark = docs.sparkSession
    common.prepare(spark)
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = texts.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long") \
                  .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = common.written(counts, "counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = common.written(kept.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")

    # languages and groups with the sizes that their prices need, also those without a kept term
    exist = counts.where("term = ''").select("lang", "source")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    langs = exist.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(sizes, "lang", "left").na.fill(0)
    langs = langs.select("*", F.greatest(F.lit(1), F.ceil(F.col("terms") / BUCKET_TERMS)).cast("int").alias("buckets"),
                         F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"))
    langs = common.written(langs, "langs")
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket")
    terms = kept.join(langs, "lang").select("lang", "term", "lang_n", bucket)
    place = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term"))
    terms = common.written(terms.withColumn("id", place), "terms")
    held = terms.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("held"))
    entries = common.written(counts.where("term <> ''").drop("docs").join(terms, ["lang", "term"]), "entries")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile")
    groups = exist.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    groups = common.written(groups.select("*", tile), "groups")

    # pairs: the groups of a tile meet those of every tile from their own on, a bucket at a time
    arrays = entries.groupBy("lang", "source", "bucket").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("x"))
    arrays = arrays.select("lang", "source", "bucket", F.col("x.id").alias("ids"), F.col("x.n").alias("counts"))
    sides = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))) \
                  .join(held, ["lang", "bucket"], "left").na.fill(0, ["held"]).join(arrays, ["lang", "source", "bucket"], "left") \
                  .select("lang", "source", "bucket", "tile", "tiles", "total", "terms", "held", "ids", "counts")
    sides = common.written(sides, "sides")
    left = sides.withColumn("i", F.col("tile")).withColumn("j", F.explode(F.expr("sequence(tile, tiles - 1)")))
    right = sides.withColumn("j", F.col("tile")).withColumn("i", F.explode(F.expr("sequence(0, tile)")))
    keys = ["lang", "bucket", "i", "j"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(merge_tiles, "lang string, a string, b string, value long")
    merged = common.written(parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "merged")
    way = lambda x, y: merged.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = way("a", "b").unionByName(way("b", "a")).withColumn("rank", F.row_number().over(best))

    # terms: those that a group prices above its language
    priced = entries.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]) \
                    .select("lang", "source", F.col("term").alias("item"), price(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                            price(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")).where("p > q")
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    top = priced.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(best))
    top = top.where(F.col("rank") <= TOP_TERMS)
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return named(pairs, "pair").unionByName(named(top, "term"))


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of all documents."""
    return audit(common.read(spark, sf_dir, "documents"))


OP11_SQL = r"""
with docs as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (select id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct id) >= 10),
langs as (select lang, count(*) as v, sum(n) as total from kept group by lang),
grp as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
cells as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n
          from grp g join kept k using (lang) left join counts c using (lang, source, term)),
priced as (select c.lang, c.source, c.term, c.n, 1 + (1000000000::hugeint * (c.n + 2)) // (sum(c.n) over (partition by c.lang, c.source) + 2 * l.v)::hugeint as p,
             1 + (1000000000::hugeint * (c.lang_n + 2)) // (l.total + 2 * l.v)::hugeint as q
           from cells c join langs l using (lang)),
pairs as (select g.lang, g.source, 'pair' as part, h.source as item,
            coalesce((select sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) from priced a join priced b on a.lang = b.lang and a.term = b.term
                      where a.lang = g.lang and a.source = g.source and b.source = h.source), 0) as value
          from grp g join grp h on g.lang = h.lang and g.source <> h.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // (p + q) as value from priced where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 10
"""
