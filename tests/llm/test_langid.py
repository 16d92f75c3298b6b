import zlib

import numpy as np
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import common, langid

SF = "/root/testdata/sf0.001"


def test_words_come_before_grams_and_grams_get_shorter():
    counts = [(0, 0, "the", 90), (0, 0, "cat", 10), (0, 1, "die", 50), (0, 1, "katze", 50),
              (3, 0, "the", 5), (3, 1, "tze", 5), (2, 1, "tz", 6), (1, 0, "h", 9), (1, 1, "z", 9)]
    m = langid.Model(["en", "de"], counts)
    assert np.allclose(m.word("cat"), [-np.log10(0.1), langid.PENALTY])
    assert np.allclose(m.word("xtze"), [langid.PENALTY, 0.0])  # a 3-gram, though a 2-gram and a letter would do
    assert np.allclose(m.word("tz"), [langid.PENALTY, 0.0])
    assert np.allclose(m.word("qzh"), [langid.PENALTY / 2, langid.PENALTY / 2])
    assert np.allclose(m.word("qq"), [langid.PENALTY] * 2)
    assert m.predict("The cat")[0] == "en" and m.predict("DIE KATZE")[0] == "de"
    assert m.predict("qq") == ("en", 0.5) and m.predict("12 !") == ("und", 0.0) and m.predict(None) == ("und", 0.0)


def plain(model, text):
    """The definition, word by word."""
    words = langid.find_words((text or "").lower())
    if not words:
        return "und", 0.0
    mean = sum(model.word(w) for w in words) / len(words)
    best = min(range(len(mean)), key=lambda i: (round(mean[i], 12), i))
    return model.languages[best], 1 / sum(10 ** ((mean[best] - s) * min(20, len(words))) for s in mean)


def test_query_accuracy_and_brute_force(spark):
    given = {d["doc_id"]: d for d in table(SF, "documents")}
    rows = langid.op1_query(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(given) and len(rows) == len(given)
    d = common.read(spark, SF, "documents")
    model = langid.Model(*langid.train(d.filter(~common.held_out(F.col("doc_id"), 4, 2))))
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        lang, score = plain(model, given[r["doc_id"]]["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9 and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and given[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == given[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)


def test_sample_bounds_training(spark):
    rows = [(i, "the cat sat" if i % 2 else "die katze sass", "en" if i % 2 else "de") for i in range(60)]
    languages, counts = langid.train(docs(spark, rows), sample=5)
    assert sorted(languages) == ["de", "en"]
    assert max(c for n, _, _, c in counts if n == 0) <= 5


def test_cases(spark):
    d = docs(spark, [(1, "the cat", "en"), (2, "die katze", "de"), (3, None, "en"), (4, "", None), (5, "1 ² ½ 3", "de"),
                     (6, "the", None), (6, "the", None), (None, "katze", None), (7, "漢字", None), (8, "the cat " * 5000, None)])
    d = d.withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit("clash"))
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.identify(d).collect()]
    want = [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (None, "de"), (8, "en")]
    assert sorted(map(str, (g for g in got if g[0] != 7))) == sorted(map(str, want))
    assert dict(got)[7] in ("de", "en")
    untaught = langid.identify(docs(spark, [(1, "the", None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in untaught] == [("und", 0.0)]
    assert langid.identify(docs(spark, [])).collect() == []


def test_stage_keeps_what_it_knows(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs(spark, [(10_000, "1234 5678"), (10_001, None), (10_002, "")])
    kept = langid.keep_identified(d.select(*more.columns).unionByName(more))
    assert kept.columns == more.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & {10_000, 10_001, 10_002} and len(ids) >= 0.98 * d.count()
