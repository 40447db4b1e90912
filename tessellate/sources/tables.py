"""Lazy access to the parquet tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


class Tables:
    """``Tables(spark, dir).orders`` reads ``dir/orders.parquet`` lazily."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))
