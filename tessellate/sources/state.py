"""Watermark state: an append-only table of ``(name, value, at)`` rows.

The current value per name is the value of the latest row (``max_by``), so
advancing a watermark is an append after the data write succeeded, and a
failed job leaves the previous value in force (at-least-once).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

STATE_SCHEMA = "name string, value bigint, text string, at timestamp_ntz, batch bigint"


def latest_state(history: DataFrame, name: str = "name", value: str = "value",
                 at: str = "at", tie=None) -> DataFrame:
    """Current value per name: the value of the row with the greatest ``at``."""
    order = F.struct(F.col(at), *[F.col(c) for c in (tie or [])]) if tie else F.col(at)
    return history.groupBy(name).agg(F.max_by(value, order).alias(value),
                                     F.max(at).alias(at))


class StateTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def history(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.path)

    def current(self) -> DataFrame:
        h = self.history()
        return (h.groupBy("name")
                .agg(F.max_by("value", F.struct("at", "batch")).alias("value"),
                     F.max_by("text", F.struct("at", "batch")).alias("text"),
                     F.max("at").alias("at")))

    def append(self, rows) -> None:
        """rows: iterable of (name, value, text, batch)."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        data = [(n, v, t, now, b) for n, v, t, b in rows]
        self.spark.createDataFrame(data, STATE_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
