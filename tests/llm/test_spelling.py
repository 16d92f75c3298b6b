import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import spelling

SF = "/root/testdata/sf0.001"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(u, v):
    if len(u) < len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(u) == len(v) + 1 and any(u[:i] + u[i + 1:] == v for i in range(len(u)))


def brute(words):
    near = {w: [] for w in words}
    by = {}
    for w in words:  # words less one code point, or with one blanked, meet their near words
        for i in range(len(w)):
            by.setdefault(w[:i] + w[i + 1:], set()).add(w)
        by.setdefault(w, set()).add(w)
    for group in by.values():
        for u in group:
            near[u] += [v for v in group if u != v and v not in near[u] and one_edit(u, v)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def result(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    want = brute(counted((r["doc_id"], r["text"]) for r in table(SF, "documents")))
    got = spelling.op12_query(spark, SF)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert result(got) == want and any(v[0] for v in want.values())


def test_the_acceptor_is_minimal_and_accepts_its_words():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(200)})
    arcs, final = spelling.minimised(words)
    accepted, stack = [], [(0, "")]
    used = set()
    while stack:
        q, s = stack.pop()
        used.add(q)
        accepted += [s] if final[q] else []
        stack += [(x, s + c) for c, x in arcs[q].items()]
    assert sorted(accepted) == words

    def language(q):
        return frozenset([""] * final[q]) | {c + s for c, x in arcs[q].items() for s in language(x)}
    assert len({language(q) for q in used}) == len(used)


@pytest.mark.parametrize("letters", ["ab", "abcdefg"])
def test_composition_gives_each_pair_once(letters):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 7))) for _ in range(150)})
    got = [tuple(sorted(p)) for p in spelling.composed(words)]
    want = {(u, v) for u in words for v in words if u < v and one_edit(u, v)}
    assert len(got) == len(set(got)) and set(got) == want
    assert list(spelling.composed(["abc"])) == [] and list(spelling.composed(["abc", "abcd"])) == [("abcd", "abc")]


@pytest.mark.parametrize("most", [1, 2, 5, 40])
def test_prefixes_and_suffixes_that_all_words_share(spark, most):
    rng = random.Random(most)
    words = {"pre" * 2 + "".join(rng.choice("abé") for _ in range(rng.randint(1, 5))) + "fix" * 2: rng.randint(2, 60) for _ in range(150)}
    words |= {"prefix" + "a" * k: 2 + k for k in range(1, 12)} | {"b" * k + "prefix": 100 - k for k in range(1, 12)}
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(df, most).collect()}
    want = {}
    for u in words:
        if others := [v for v in words if one_edit(u, v)]:
            best = min(others, key=lambda v: (-words[v], v))
            want[u] = (len(others), words[best], best)
    assert got == want


def test_chains_lead_to_their_root_and_ties_to_the_smallest(spark):
    rows = [(1, "variation " * 1100 + "variatien " * 100 + "varietien " * 8 + "warietien"), (2, "warietien varietien")]
    got = result(spelling.variants(docs(spark, rows)))
    want = brute(counted(rows))
    assert got == want
    tie = [(3, "tablettes " * 30 + "tablettas " * 30 + "tablettos " * 3 + "tablettos")]
    got = result(spelling.variants(docs(spark, tie)))
    assert got == brute(counted(tie))


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    rows = [(None, "Élégance élégance Elegance elegance"), (None, None), (1, ""), (2, "naïveté " * 3), (2, "naïveté " * 3), (3, "z" * 30_000), (4, "z" * 30_000),
            (5, "z" * 29_999 + "y"), (6, "z" * 29_999 + "y"), (7, "İstanbul Ābcdefgh \U0001F600abcdefg " * 2), (8, "kurz")]
    d = docs(spark, rows)
    for c in ("word", "n", "key", "head", "root"):
        d = d.withColumn(c, F.lit("x"))
    assert result(spelling.variants(d)) == brute(counted(rows))
    empty = spelling.variants(docs(spark, []))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
