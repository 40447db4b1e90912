"""The ``opN_<name>`` queries over the given tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellate.session import scratch_path

from . import byte_bpe, conversation_repair, decontam, fingerprints, html_text, language_id, merkle, pii, preferences, quality, quality_rules, simhash, token_files
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_decontamination")
def op1_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_fingerprints")
def op2_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


@query("op5_token_files")
def op5_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op7_html_text")
def op7_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op8_preferences", preferences.NEIGHBOURS_SQL)
def op8_preferences(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return preferences.format_preferences(turns, preferences.neighbours(turns))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_quality_rules", quality_rules.RULES_SQL)
def op13_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op12_merkle", merkle.MANIFEST_SQL)
def op12_merkle(spark, sf_dir):
    return merkle.tampered_rows(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair", conversation_repair.REPAIR_SQL)
def op11_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns)
