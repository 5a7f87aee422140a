import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cropledger.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, docs, length):
    """Every id in exactly one piece, windows gapless and full."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s, pieces in by_seq.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or s == max(by_seq)


def test_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op2_packing(spark, sf).collect(), docs, 4096)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "Hello <|endoftext|> World's é J̌"), (4, "x" * 5000 + " " + "the " * 3000), (5, "a b\x1cc İI")]
    df = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, n int, part string")
    check(packing.pack(df, PATH, length=64).collect(), docs, 64)
    assert packing.pack(df.limit(0), PATH).count() == 0
    assert packing.pack(df.where("doc_id = 2").unionAll(df.where("doc_id = 2")), PATH).count() == 2


def test_last_window_is_padded_unless_a_power_of_two(spark):
    df = spark.createDataFrame([(1, "the the the"), (2, None)], "doc_id long, text string").coalesce(1)
    assert {r.padded_to for r in packing.pack(df.where("doc_id = 1"), PATH, length=64).collect()} == {4}
    assert {r.padded_to for r in packing.pack(df, PATH, length=64).collect()} == {64}
