"""Each stage against its operator's brute force, and the whole run."""

import hashlib

import public_tokenizers
import pytest
import regex

import corpus_pipeline as cp
from tessellate.llm import byte_bpe, pii, quality
from tessellate.session import scratch_path

from .helpers import DOCS, SF
from .test_decontam import brute
from .test_simhash import slow_components, slow_fingerprint

STAGES = dict(cp.STAGES)
NAMES = [n for n, _ in cp.STAGES]


@pytest.fixture(scope="module")
def chain(spark):
    """The rows that go into each stage, and those that come out of the last."""
    docs, rows = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        rows.append(docs.collect())
        docs = cp.stored(stage(spark, docs, SF), "stage")
    return rows + [docs.collect()]


def test_stage_order_and_columns(chain):
    assert [f.__name__ for _, f in cp.STAGES] == ["drop_bad_text", "drop_near_copies", "drop_benchmark_leaks",
                                                  "replace_personal_data", "to_tokens"]
    for rows in chain[:-1]:
        assert rows and tuple(rows[0].asDict()) == cp.DOCUMENT


def test_quality_keeps_clean_documents(spark, chain):
    kept = {r.doc_id for r in chain[1]}
    accepted = {r.doc_id for r in quality.classify(spark.read.parquet(f"{SF}/documents.parquet"),
                                                   spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.accepted}
    assert kept == accepted and len(kept) < len(chain[0])


def test_one_document_of_each_group_stays(chain):
    rows = sorted((r.doc_id, r.text) for r in chain[1])
    roots = slow_components([slow_fingerprint(t) for _, t in rows], 3)
    assert {r.doc_id for r in chain[2]} == {rows[i][0] for i in set(roots)}


def test_leaks_go(spark, chain):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {doc for doc, _ in brute([(r.doc_id, r.text) for r in chain[2]], bench)}
    assert {r.doc_id for r in chain[3]} == {r.doc_id for r in chain[2]} - leaks


def test_entities_are_replaced_and_other_text_is_kept(chain):
    entity, after = regex.compile(pii.ENTITY), {r.doc_id: r for r in chain[4]}
    assert len(after) == len(chain[3])
    for r in chain[3]:
        new = after[r.doc_id]
        assert new.n_chars == len(new.text) and (new.lang, new.source) == (r.lang, r.source)
        if found := [m[0] for m in entity.finditer(r.text)]:
            assert not any(x in new.text for x in found if len(x) > 8)
        else:
            assert new.text == r.text


def test_tokens_are_those_of_the_library(chain):
    enc = byte_bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in chain[5]}
    assert len(got) == len(chain[4])
    for r in chain[4]:
        assert list(got[r.doc_id].ids) == enc.encode_ordinary(r.text)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_equals_the_chain(spark, chain):
    key = lambda r: (r.doc_id, r.n_tokens, r.decoded_sha256)
    assert sorted(map(key, cp.run(spark, SF).collect())) == sorted(map(key, chain[5]))


def test_documents_with_one_id_or_none_stay_apart(spark):
    folder = scratch_path(spark, "identity")
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdef"]
    rows = [(21, texts[0], "en", "s", 1), (None, None, None, None, None), (5, texts[1], "en", "s", 1), (5, texts[2], "en", "s", 1),
            (5, texts[1], "en", "s", 1), (None, texts[3], "en", "s", 1), (None, texts[4], "en", "s", 1), (9, texts[4], "en", "s", 1),
            *[(8, texts[5], "en", "s", 1)] * 30]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((r.doc_id or 0, r.text or "") for r in cp.drop_near_copies(spark, docs, SF).collect())
    assert got == sorted([(21, texts[0]), (0, ""), (5, texts[1]), (5, texts[2]), (0, texts[3]), (9, texts[4]), (8, texts[5])])
    spark.createDataFrame([(10, texts[2])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = {(r.doc_id, r.text) for r in cp.drop_benchmark_leaks(spark, docs, folder).collect()}
    assert left == {r[:2] for r in rows} - {(5, texts[2])}


def test_edge_rows_pass_all_stages(spark):
    folder = scratch_path(spark, "edge")
    rows = [(1, "Some plain words of a text that is kept here.", "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "Some words of a text that is kept here.", "en", "s", 1), (None, None, None, None, None),
            (1, "Some plain words of a text that is kept here.", "en", "s", 1), (7, "many words and more " * 9000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS key", "2 AS least", "3 AS row", "4 AS accepted")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (7, 1, None), (None, None, None)], "doc_id long, quality long, toxic long").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "x y z")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = sorted((r.doc_id or 0, r.n_tokens > 0) for r in cp.run(spark, folder).collect())
    assert got == [(0, True), (1, True), (2, False), (7, True)]  # 2, 3 and a null text are one group
    empty = scratch_path(spark, "edge")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert cp.run(spark, empty).count() == 0
