"""Table of published snapshots: plain partitioned Parquet folders and a state row
that names the current ones.

A load writes the partitions that it changes into a new folder with a unique
name and then appends one state row, which names the folder of every partition.
Readers see the old or the new table, and a load that fails leaves nothing but
a folder that no row names. The row can also carry marks of what the load
applied (a stream's batch, a watermark): data and marks become visible
together, which makes a replay after a crash a no-op. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import child_names, stored
from .state import StateTable

CURRENT = "snapshot"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of the null partition


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, partition_col: str = "PartitionId"):
        self.spark, self.root, self.part = spark, root.rstrip("/"), partition_col
        self.loads = StateTable(spark, f"{self.root}/loads")

    def _latest(self):
        rows = self.loads.history().where(F.col("name") == CURRENT)
        return rows.agg(F.max(F.struct("value", "text")).alias("row")).first()["row"]

    def exists(self) -> bool:
        return self._latest() is not None

    def current(self) -> dict:
        """``schema`` and ``partitions``: the load that wrote each partition's folder."""
        row = self._latest()
        if row is None:
            raise ValueError(f"table {self.root} has no snapshot")
        return json.loads(row["text"])

    def value_of(self, partition: str) -> str | None:
        """A partition's value as text, from the name of its folder."""
        value = unquote(partition.split("=", 1)[1])
        return None if value == NULL_PARTITION else value

    def read(self, named: dict | None = None) -> DataFrame:
        """The current snapshot (or the given partitions of it) with the columns and
        types it was written with; columns younger than a partition are null in it."""
        named = named or self.current()
        schema = T.StructType.fromJson(named["schema"])
        if not named["partitions"]:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/snapshots"
        paths = [f"{base}/load={load}/{partition}" for partition, load in named["partitions"].items()]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def applied(self, mark: str) -> int | None:
        """The greatest value a load has noted under ``mark``."""
        return self.loads.history().where(F.col("name") == mark).agg(F.max("value")).first()[0]

    def publish(self, df: DataFrame, marks: dict[str, int] | None = None, kept: dict[str, str] | None = None) -> str:
        """Make ``df`` and the partitions ``kept`` the table, with the marks of what it contains."""
        load, kept = uuid.uuid4().hex, kept or {}
        folder = f"{self.root}/snapshots/load={load}"
        df.write.partitionBy(self.part).parquet(folder)
        written = [name for name in child_names(self.spark, folder) if name.startswith(f"{self.part}=")]
        if not kept.keys().isdisjoint(written):
            raise ValueError(f"rows of partitions that were to be kept: {sorted(kept.keys() & set(written))}")
        row = self._latest()
        named = json.dumps({"schema": df.schema.jsonValue(), "partitions": kept | {name: load for name in written}})
        self.loads.append([(CURRENT, row["value"] + 1 if row else 0, named, None),
                           *((name, value, folder, None) for name, value in (marks or {}).items())])
        return folder


def first_load(spark: SparkSession, root: str, snapshot: DataFrame, partition_col: str = "PartitionId",
               marks: dict[str, int] | None = None) -> SnapshotTable:
    """Create or replace the table by a full snapshot."""
    table = SnapshotTable(spark, root, partition_col)
    table.publish(snapshot, marks)
    return table


def apply_upsert(table: SnapshotTable, source: DataFrame, merge_fn: Callable[[DataFrame, DataFrame], DataFrame],
                 marks: dict[str, int] | None = None, keys=None) -> None:
    """Publish ``merge_fn(current, source)``.

    With ``keys``, by which ``merge_fn`` matches rows, only the partitions are
    read and written that hold a key of ``source`` or receive one of its rows;
    the files of the others stay. The keys are looked up in a scan of the key
    columns alone. A merge that changes a column's type rewrites the table.
    """
    if not keys:
        return table.publish(merge_fn(table.read(), source), marks)
    named, source = table.current(), stored(source, "upsert-source")
    value = F.col(table.part).cast("string").alias("value")
    held = table.read(named).select(*keys, value).join(source.select(*keys), list(keys), "left_semi")
    # as many rows as the table has partitions
    touched = {r["value"] for r in held.select("value").union(source.select(value)).distinct().collect()}
    kept = {p: load for p, load in named["partitions"].items() if table.value_of(p) not in touched}
    merged = merge_fn(table.read(named | {"partitions": {p: x for p, x in named["partitions"].items() if p not in kept}}), source)
    types = {f["name"]: f["type"] for f in merged.schema.jsonValue()["fields"]}
    if any(types.get(f["name"]) != f["type"] for f in named["schema"]["fields"]):
        merged, kept = merge_fn(table.read(named), source), {}
    table.publish(merged, marks, kept)
