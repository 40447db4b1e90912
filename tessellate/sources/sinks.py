"""Sinks: parquet / CSV writers and the JSON audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..functions.calendar import date_keys


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*as_list(partition_by))
    w.parquet(path)


def write_partitioned_overwrite(df: DataFrame, path: str, partition_by) -> None:
    """Replace the whole dataset (and its schema) partitioned by ``partition_by``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(*as_list(partition_by)).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_audit_log(df: DataFrame, root: str, time_col: str, secret_cols=()) -> None:
    """Append work-list rows as JSON under ``_yearkey/_monthkey/_datekey``.

    Secret columns are replaced by a random token so they never reach storage.
    """
    cols = []
    for c in df.columns:
        if c in secret_cols:
            cols.append(F.expr("uuid()").alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols, *date_keys(time_col))
    out.write.mode("append").partitionBy("_yearkey", "_monthkey", "_datekey").json(root)
