import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from brute import docs, table
from pricefold.llm import common, langid
from test_decontam import brute as contaminated
from test_mixing import copies
from test_neardup import brute as near_classes

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    given = table(SF, "documents")
    rows = [(d["doc_id"], d["text"], d["source"]) for d in given]
    d = common.read(spark, SF, "documents")
    model = langid.Model(*langid.train(d.filter(~common.held_out(F.col("doc_id"), 4, 2))))
    told = [model.predict(t) for _, t, _ in rows]
    rows = [r for r, (lang, score) in zip(rows, told) if lang != "und" and score >= langid.MIN_SCORE]
    classes = near_classes([r[:2] for r in rows])
    rows = [r for r in rows if classes[r[0]] == r[0]]
    bad = {r[0] for r in contaminated([r[:2] for r in rows], [(b["item_id"], b["text"]) for b in table(SF, "benchmark")]) if r[5]}
    rows = [r for r in rows if r[0] not in bad]
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.encode()) + 1
    roots = sum(v ** 0.5 for v in size.values())
    rate = {s: v ** 0.5 / roots * sum(size.values()) / v for s, v in size.items()}
    want = Counter()
    for i, _, s in rows:
        want[i] += copies(rate[s], i)
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in got) == +want
    texts = {x["doc_id"]: x["text"] for x in given}
    assert all(r["text"] == texts[r["doc_id"]] and r["size"] == len(r["text"].encode()) + 1 for r in got)
    assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) for r in got)
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 0.05 * sum(load.values()) / 8
    for s in load:
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    odd = [(1, "the words of a text here", "en", "a"), (1, "the words of a text here", "en", "a"), (2, None, None, None),
           (None, "some other text in words", None, None), (3, "", "en", "b"), (4, "some other text in words", "en", "b")]
    d = docs(spark, odd)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, d, SF)
        assert out.columns == d.columns if k + 1 < len(corpus_pipeline.STAGES) else set(d.columns) < set(out.columns)
        assert out.count() <= 40
        assert stage(spark, docs(spark, []), SF).collect() == []
