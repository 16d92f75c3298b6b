import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import docs
from pricefold.llm import divergence

SF = "/root/testdata/sf0.001"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least=divergence.LEAST_DOCS):
    """(lang, source, part, item, value, rank) of (text, lang, source)."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in held:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        own = {s: c for (l, s), c in groups.items() if l == lang}
        total = Counter()
        for c in own.values():
            total.update(c)

        def prices(c):
            below = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // below for t in kept}
        p, q = {s: prices(c) for s, c in own.items()}, prices(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def corpus(n, langs=2, sources=9, words=60, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + k % 26)}{'é' * (k % 3)}{chr(97 + k // 26)}" for k in range(words)]
    return [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))), f"l{rng.randrange(langs)}", f"s{min(rng.randrange(sources * 2), sources - 1)}") for _ in range(n)]


@pytest.mark.parametrize("bucket,tile,held", [(1 << 15, 8, 300_000), (7, 2, 50), (1, 1, 1)])
def test_equals_brute_force_with_any_cut(spark, monkeypatch, bucket, tile, held):
    monkeypatch.setattr(divergence, "BUCKET_TERMS", bucket)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rows = corpus(300)
    d = docs(spark, [(k, *r) for k, r in enumerate(rows)])
    got = divergence.audit(d)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert result(got) == brute(rows)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({divergence.OP11_SQL})").fetchall()
    assert result(divergence.op11_query(spark, SF)) == sorted(got)


def test_galloping_meets_what_both_hold():
    rng = np.random.default_rng(2)
    for n, m in ((0, 5), (5, 0), (3, 5000), (5000, 3), (700, 900), (1, 1)):
        a, b = (np.sort(rng.choice(6000, k, replace=False)) for k in (n, m))
        i, j = divergence.gallop(a, b)
        assert (a[i] == b[j]).all() and a[i].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_counts_beyond_64_bit_products(spark):
    counts = np.array([3, 40_000_000_000, 9_000_000_000_000])
    total, terms = int(counts.sum()), 3
    want = [1 + 10 ** 9 * (int(c) + 2) // (total + 6) for c in counts]
    assert divergence.prices(counts, total, terms).tolist() == want
    df = spark.createDataFrame([(int(c),) for c in counts], "n long")
    assert [r[0] for r in df.select(divergence.price(F.col("n"), F.lit(total), F.lit(terms))).collect()] == want


def test_nulls_empty_ties_repeats_and_clashing_columns(spark):
    rows = [(None, None, None), ("", "x", None), ("Ab ab", "x", "a")] + [("same words here", "x", s) for s in "abc"] * 12 \
        + [("Ünï ünï ÀB àb \U0001F600 a1b2", "y", "one")] * 11 + [("long " * 50_000, "x", "b")]
    d = docs(spark, [(1, *r) for r in rows])
    for c in ("term", "n", "docs", "value", "rank", "bucket", "tile", "terms"):
        d = d.withColumn(c, F.lit("x"))
    assert result(divergence.audit(d)) == brute(rows)
    empty = divergence.audit(docs(spark, []))
    assert empty.collect() == [] and empty.columns == ["lang", "source", "part", "item", "value", "rank"]
    lone = [(f"few {k}", "z", "ab"[k % 2]) for k in range(4)]
    assert result(divergence.audit(docs(spark, [(k, *r) for k, r in enumerate(lone)]))) == [("z", "a", "pair", "b", 0, 1), ("z", "b", "pair", "a", 0, 1)]
