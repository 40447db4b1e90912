import hashlib
import random

import numpy as np
import public_tokenizers
import regex

from tessellate.llm import byte_bpe, queries

from .helpers import SF, documents

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SOME = ["word", "  ", "\n\n", " it's", "'r", "é", "漢字", "́", "12 345", "!!", "　", "a" * 90, "   " * 30, "'ll", "\t x"]


def test_stitched_pieces_have_the_pre_tokens_of_the_whole_text():
    compiled, rnd = regex.compile(PATTERN), random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice(SOME) for _ in range(rnd.randrange(1, 120)))
        size, overlap = rnd.choice([(16, 12), (40, 20), (100, 30)])
        starts = byte_bpe.chunk_starts(len(text), size)
        chunks = [text[s:s + size + overlap] for s in starts]
        pieces = byte_bpe.stitch(chunks, [byte_bpe.boundaries(c, compiled) for c in chunks], starts, compiled)
        assert "".join(pieces) == text
        assert [t for p in pieces for t in compiled.findall(p)] == compiled.findall(text)


def test_long_texts_are_cut_into_several_pieces():
    compiled = regex.compile(PATTERN)
    text = "some words of a text. " * 2000
    starts = byte_bpe.chunk_starts(len(text), 1000)
    chunks = [text[s:s + 1100] for s in starts]
    pieces = byte_bpe.stitch(chunks, [byte_bpe.boundaries(c, compiled) for c in chunks], starts, compiled)
    assert len(pieces) == len(starts) and max(map(len, pieces)) < 1200
    run = "x" * 50_000
    chunks = [run[s:s + 1100] for s in byte_bpe.chunk_starts(len(run), 1000)]
    assert byte_bpe.stitch(chunks, [byte_bpe.boundaries(c, compiled) for c in chunks],
                           byte_bpe.chunk_starts(len(run), 1000), compiled) == [run]


def test_encode_and_decode_equal_the_library(spark):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice(SOME) for _ in range(rnd.randrange(200)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "no id " * 50), (7, rows[7][1]), (102, "a" * 3000)]
    docs = documents(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "digest")
    coded = byte_bpe.encode(docs, RANKS, PATTERN, chunk=64, overlap=24)
    got = byte_bpe.decode(coded, RANKS, PATTERN).collect()
    enc = byte_bpe.encoding(RANKS, PATTERN)
    want = [(i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, tuple(r.ids), bytes(r.bytes)) for r in got), key=key) == sorted(want, key=key)
    both = byte_bpe.encode(docs, RANKS, PATTERN, chunk=64, overlap=24, decoded=True).collect()
    assert sorted(((r.doc_id, tuple(r.ids), bytes(r.bytes)) for r in both), key=key) == sorted(want, key=key)
    assert byte_bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_query_returns_digests_of_the_whole_table(spark):
    enc = byte_bpe.encoding(RANKS, PATTERN)
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op6_byte_bpe"](spark, SF).collect()}
    assert got == want
