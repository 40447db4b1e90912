"""Corpus pipeline: documents through the stages of STAGES, each read from the
files of the one before it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellate.llm import byte_bpe, decontam, pii, quality, simhash
from tessellate.llm.common import stored, table

ORACLE_SQL = None  # no stage's method can be stated in SQL; tests hold them against brute force
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _key() -> Column:
    """What a document goes by within a stage: a hash of its id and text, so that two texts
    with one id, and texts without an id, are documents of their own."""
    return F.xxhash64(F.struct(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_key().alias("doc_id"), "text", "lang")


def drop_bad_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    docs = docs.select(*DOCUMENT)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("of_id"), "quality", "toxic")
    labels = docs.select("doc_id", _key().alias("key")).distinct().join(labels, F.col("doc_id") == F.col("of_id")).select(
        F.col("key").alias("doc_id"), "quality", "toxic")
    rejected = (quality.classify(_keyed(docs), labels).where(~F.col("accepted"))
                .select(F.col("doc_id").alias("key")).distinct())
    return docs.join(rejected, _key() == F.col("key"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that SimHash links, the document with the least id stays (documents
    without one come last, and of repeated rows one stays)."""
    docs = docs.select(*DOCUMENT)
    groups = simhash.near_duplicates(_keyed(docs), shingle=3, radius=3).select(F.col("doc_id").alias("of_key"), "component_id").distinct()
    ids = docs.select("doc_id", _key().alias("key")).distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    kept = (ids.join(groups, F.col("key") == F.col("of_key")).groupBy("component_id").agg(first)
            .select(F.col("first.key").alias("kept_key")))
    return (docs.withColumn("key", _key()).join(kept, F.col("key") == F.col("kept_key"), "left_semi").groupBy("key")
            .agg(F.min(F.struct(*DOCUMENT)).alias("least")).select("least.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the same or other parameters, go."""
    docs = docs.select(*DOCUMENT)
    leaks = (decontam.contaminated(_keyed(docs), table(spark, sf_dir, "benchmark"))
             .select(F.col("doc_id").alias("key")).distinct())
    return docs.join(leaks, _key() == F.col("key"), "left_anti")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates; n_chars is that of the new text."""
    return pii.pseudonymise(docs.select(*DOCUMENT)).withColumn(
        "n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", drop_bad_text),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("pii surrogates", replace_personal_data),
    ("byte-level bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``. Rows without doc_id, null and
    empty texts, repeated rows and empty tables are treated as the stages'
    operators say; other columns than those of documents are not read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
