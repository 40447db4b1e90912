"""Change folders as a file-source stream: each micro-batch is deduplicated
to the latest row per key and merged into the snapshot table.

The stream checkpoint records which files were consumed; the table notes the
batch together with the data. A batch is known by the id that the checkpoint
gives its query and its number, so a replay is skipped and a new checkpoint
starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.increment import upsert_soft_delete
from ..sources.snapshot_table import SnapshotTable, apply_upsert, first_load


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into the checkpoint when the stream first started."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").select("id").first()["id"]


def make_batch_writer(spark: SparkSession, table_root: str, checkpoint: str, keys,
                      prepare: Callable[[DataFrame], DataFrame]):
    """foreachBatch function: ``prepare(batch_df) -> snapshot`` then merge."""

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = f"stream {query_id(spark, checkpoint)}"
        table = SnapshotTable(spark, table_root)
        done = table.applied(mark)
        if done is not None and batch_id <= done:
            return
        snap = prepare(batch)
        if table.exists():
            apply_upsert(table, snap, lambda t, s: upsert_soft_delete(t, s, keys), {mark: batch_id}, keys)
        else:
            first_load(spark, table_root, snap, marks={mark: batch_id})

    return write


def run_stream_upsert(spark: SparkSession, source_dir: str, schema, table_root: str, checkpoint: str,
                      prepare: Callable[[DataFrame], DataFrame], keys=("Id",),
                      max_files_per_trigger: int | None = None) -> None:
    """Process every file currently in ``source_dir`` (availableNow) and stop.

    ``prepare`` picks one row per key of a batch by a total order
    (``source_snapshot`` with a tie-breaker).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.option("recursiveFileLookup", True).parquet(source_dir)
    q = (stream.writeStream
         .foreachBatch(make_batch_writer(spark, table_root, checkpoint, list(keys), prepare))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
