import zlib

import numpy as np
from pyspark.sql import functions as F

from brute import docs, table
from pricefold.llm import common, token_orc

SF = "/root/testdata/sf0.001"


def encode(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_orc.tokenizer_path())
    return [e.ids + [2] for e in t.encode_batch(texts, add_special_tokens=False)]


def expected(rows):
    start, out = 0, []
    for doc_id, ids in rows:
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_text_encoding(spark):
    rows = sorted((d["doc_id"], d["text"] or "") for d in table(SF, "documents"))
    want = expected([(k, ids) for (k, _), ids in zip(rows, encode([t for _, t in rows]))])
    assert sorted(tuple(r) for r in token_orc.op4_query(spark, SF).collect()) == want


def test_pieces_give_the_ids_of_whole_texts():
    texts = ["", " ", "  a  b \n\n c\t", "it's we'll I'D 'so ", "naïve Ñandú 12³ ½ x²", "日本語 text   x", "a\x1cb \x1f c",
             "\xa0\x85 z", "<|endoftext|> end", "hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "<|endoftext", "a <|EndOfText|>", "!!'s ''t  ", "é \U0001f600", "x" * 5000, " " * 300 + "y"]
    encoder = token_orc.Encoder.of(token_orc.tokenizer_path())
    assert [encoder.ids(t).tolist() for t in texts] == encode(texts)
    assert encoder.ids("hello <|endoftext|> world").tolist() == [31373, 220, 50256, 995, 2]


def test_nulls_repeats_empty_and_pruned_read(spark, tmpdir_fresh):
    d = docs(spark, [(5, "five"), (None, "no id"), (3, None), (5, "five"), (4, "")]).withColumn("ids", F.lit("clash"))
    token_orc.write_tokens(d, f"{tmpdir_fresh}/t")
    rows = token_orc.read_tokens(spark, f"{tmpdir_fresh}/t").collect()
    order = [(None, "no id"), (3, ""), (4, ""), (5, "five"), (5, "five")]
    want = expected([(k, ids) for (k, _), ids in zip(order, encode([t for _, t in order]))])
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())) for r in rows),
                 key=lambda r: r[1])
    assert got == want
    some = token_orc.read_tokens(spark, f"{tmpdir_fresh}/t", F.col("doc_id") == 5)
    assert "PushedFilters" in some._jdf.queryExecution().toString() and some.count() == 2
    token_orc.write_tokens(docs(spark, []), f"{tmpdir_fresh}/e")
    assert token_orc.read_tokens(spark, f"{tmpdir_fresh}/e").collect() == []


def test_files_carry_bloom_filters(spark, tmpdir_fresh):
    import pyarrow.orc as orc
    from glob import glob
    token_orc.write_tokens(common.read(spark, SF, "documents"), f"{tmpdir_fresh}/t")
    names = glob(f"{tmpdir_fresh}/t/*.orc")
    assert names and sum(orc.ORCFile(f).nrows for f in names) == 200
