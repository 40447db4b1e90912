"""Fixtures of the operator tests."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """Rows of (doc_id, text[, lang]) as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)
