import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessellate.llm import queries, token_files
from tessellate.session import scratch_path

from .helpers import SF, documents

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(FILE)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("width", [1, 7, 8, 15, 16, 17, 31, 32])
def test_pack_and_unpack(width):
    ids = np.random.default_rng(width).integers(0, 2 ** width, 1001, dtype=np.uint64).astype(np.uint32)
    raw = token_files.pack(ids, width)
    assert len(raw) == -(-1001 * width // 8)
    assert (token_files.unpack(raw, width, 0, 1001) == ids).all()
    assert (token_files.unpack(raw, width, 333, 77) == ids[333:410]).all()
    assert len(token_files.unpack(raw, width, 5, 0)) == 0


def test_words_have_the_ids_of_whole_texts(library):
    rnd, enc = random.Random(3), token_files.WordEncoder(FILE)
    assert enc.pattern is not None
    some = ["It's", "WE'LL", " ", "\n", "ÉTÉ", "é", "ΟΔΟΣ", "İstanbul", "漢字", "42", "½²", "!?", "<|endoftext|>", "<|StartOfText|>", "hello <|startoftext|> world",
            " ", "\x1c", "naïve", "ß", "'s", "x" * 40, "Ⅷ", "ʰ", "ﬁ", "\U0001f600"]
    for i in range(400):
        text = "".join(rnd.choice(some) for _ in range(rnd.randrange(30)))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == library(text), text
    for i in range(200):
        text = "".join(chr(rnd.choice([rnd.randrange(32, 0x600), rnd.randrange(0x1e00, 0x2c00)])) for _ in range(40))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == library(text), ascii(text)


def test_characters_newer_than_python_and_special_names(library):
    enc = token_files.WordEncoder(FILE)
    for text in ["hello <|startoftext|> world", "<|endoftext|>", "a<|ENDOFTEXT|>b", *(f"old {chr(c)}new {chr(c)} 1" for c in (
            0xa7cb, 0xa7da, 0x105c0, 0x1e5f0, 0x16d40, 0x1c89, 0x378, 0xe0080, 0xe000))]:
        for _ in range(2):  # and again, when words are remembered
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == library(text), ascii(text)


def test_files_hold_documents_in_order(spark, library):
    rows = [(9, "nine words of a text"), (3, None), (None, "no id"), (4, ""), (3, "three"), (3, "three"),
            (11, "long text " * 900), (-5, "below")]
    docs = documents(spark, rows).withColumnRenamed("lang", "start").withColumnRenamed("source", "shard_id")
    path = scratch_path(spark, "token-test")
    token_files.write(docs, path, FILE, end_id=2, block_ids=7)
    got = sorted(((r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
                  for r in token_files.read(spark, path).collect()), key=lambda r: r[1])
    want = sorted(((i, library(t) + [2]) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(((g[0], g[3]) for g in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1])) == want
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
    whole = [x for g in got for x in g[3]]
    for start, n in ((0, 5), (3, 20), (len(whole) - 4, 99), (7, 0), (0, len(whole)), (len(whole) + 5, 3)):
        assert token_files.read_at(spark, path, start, n).tolist() == whole[start:start + n]
    empty = scratch_path(spark, "token-test")
    token_files.write(docs.limit(0), empty, FILE, end_id=2)
    assert token_files.read(spark, empty).count() == 0


def test_query_equals_the_library(spark, library):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want, at = {}, 0
    for doc_id, text in rows:
        ids = library(text) + [2]
        want[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op5_token_files"](spark, SF).collect()}
    assert got == want
