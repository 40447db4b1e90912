"""The incremental ingest job over change folders.

Files under ``root/<folder>/<entity>/`` are listed, each folder's manifest says
which entities it holds and with which columns, the work plan decides per table
between first load, upsert and skip, and the planned folders of a table are
read in one scan per column list, united by name, reduced to the latest row
per key and merged into its snapshot table.

Lines that do not parse as the manifest says, and rows without a key, go to a side
table with their file and text, and the status row counts them.

A table's data and its watermark are published together. The folder watermark,
from which the next run starts, advances only if no table failed: folders that
were missed are planned again, and tables that had them skip them by their own
watermark.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import epoch_seconds
from ..sources.files import list_files, read_manifests
from ..session import stored
from ..sources.sinks import write_parquet
from ..sources.snapshot_table import SnapshotTable, apply_upsert, first_load
from ..sources.state import StateTable
from .increment import load_plan, source_snapshot, upsert_soft_delete
from .reshape import union_by_name

STATUS_SCHEMA = ("table_name string, status string, attempt int, start_time timestamp_ntz, "
                 "end_time timestamp_ntz, new_watermark bigint, message string, rejected bigint")
REJECTED_SCHEMA = "folder string, file string, reason string, text string"
WATERMARK = "watermark"  # a table's mark: modification time up to which it is loaded
CSV_TIMES = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"  # the default would cut microseconds
FOLDERS = "last_folder"  # name of the state row that holds the folder watermark


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def change_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """``folder, entity, path, modified`` of the files ``root/<folder>/<entity>/<file>``."""
    parts = r"/([^/]+)/([^/]+)/[^/]+$"
    files = list_files(spark, root, glob)
    return files.select(F.regexp_extract("path", parts, 1).alias("folder"), F.regexp_extract("path", parts, 2).alias("entity"),
                        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("path"), epoch_seconds("modified").alias("modified"))


def read_folders(spark: SparkSession, folders: list, columns: dict[str, tuple]) -> DataFrame:
    """One entity's rows from its planned ``folders`` (rows with name and path), with
    ``__folder``. ``columns``: for each folder name its ``((name, type), ...)``;
    folders with the same columns share a scan, columns that a folder lacks are null.
    ``__file`` is a row's file and ``__line`` the text of a line that does not parse
    (wrong number of fields, or a value that is not of its type), else null."""
    by_columns: dict[tuple, list] = {}
    for f in folders:
        by_columns.setdefault(columns[f.name], []).append(f.path)
    frames = []
    for fields, paths in by_columns.items():
        schema = ", ".join([*(f"`{name}` {kind}" for name, kind in fields), "__line string"])
        rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", "__line").option("timestampNTZFormat", CSV_TIMES).csv(paths)
        frames.append(rows.select("*", F.col("_metadata.file_path").alias("__file"), F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+/[^/]+$", 1).alias("__folder")))
    return union_by_name(frames)


def split_rejected(rows: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows of ``read_folders`` that can be loaded, and the others as ``REJECTED_SCHEMA``.

    The rows are stored once: a scan that needs fewer columns would not see
    what is wrong with the others.
    """
    rows = stored(rows, "parsed")
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    fields = [c for c in rows.columns if c not in ("__line", "__file", "__folder")]
    reason = F.when(F.col("__line").isNotNull(), "unparsable").when(no_key, "no key")
    bad = rows.where(reason.isNotNull()).select(
        F.col("__folder").alias("folder"), F.col("__file").alias("file"), reason.alias("reason"),
        F.coalesce("__line", F.to_json(F.struct(*fields))).alias("text"))
    return rows.where(reason.isNull()).drop("__line", "__file"), bad


def run_ingest(spark: SparkSession, files: DataFrame, state: StateTable, table_root: str,
               snapshot: Callable[[str, list], DataFrame], keys=("Id",), max_retries: int = 0,
               retry_delay: float = 1.0, parallel: int = 4, current_folder: str | None = None,
               **plan_options) -> DataFrame:
    """Load every table of the plan; returns one status row per attempt.

    ``snapshot(table_name, folders)`` builds the deduplicated source rows of a
    table from its planned folders (rows with name, path, max_last_modified), or
    these and the number of rows that it rejected.
    Tables: ``{table_root}/{table_name}``; ``parallel`` of them are loaded at a
    time. Folders are planned from the folder watermark up to
    ``current_folder`` (exclusive), which becomes the watermark if all went
    well, so the plan does not grow with the history.
    """
    current = state.current()
    marks = current.where(F.col("name") != FOLDERS).select(F.col("name").alias("table_name"), F.col("value").alias("last_watermark"))
    last = current.where(F.col("name") == FOLDERS).select("text").first()
    # one row per table, each with the folders since the folder watermark
    plan = load_plan(files, marks, last_folder=last["text"] if last else None, current_folder=current_folder,
                     **plan_options).collect()

    def load(row) -> list[tuple]:
        table, out = SnapshotTable(spark, f"{table_root.rstrip('/')}/{row.table_name}"), []
        for attempt in range(1, max_retries + 2):
            start = _now()
            try:
                done = table.applied(WATERMARK)  # data may be ahead of the job's state after a crash
                folders = [f for f in row.folders if done is None or f.max_last_modified > done]
                result, rejected = "SUCCEEDED" if folders else "SKIPPED", 0
                if folders:
                    marks = {WATERMARK: int(row.new_watermark)}
                    source = snapshot(row.table_name, folders)
                    if isinstance(source, tuple):
                        source, rejected = source
                    if done is None:
                        first_load(spark, table.root, source, marks=marks)
                    else:
                        apply_upsert(table, source, lambda t, s: upsert_soft_delete(t, s, keys), marks, keys)
                out.append((row.table_name, result, attempt, start, _now(), row.new_watermark, None, rejected))
                break
            except Exception as e:  # noqa: BLE001 - recorded per table, job goes on
                out.append((row.table_name, "FAILED", attempt, start, _now(), row.new_watermark, str(e), None))
                if attempt <= max_retries:
                    time.sleep(retry_delay)
        return out

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        status = [s for rows in pool.map(inheritable_thread_target(spark)(load), plan) for s in rows]
    last_of = {s[0]: s for s in status}.values()
    news = [(s[0], int(s[5]), None, 0) for s in last_of if s[1] != "FAILED"]
    if current_folder is not None and all(s[1] != "FAILED" for s in last_of):
        news.append((FOLDERS, 0, current_folder, 0))
    if news:
        state.append(news)
    return spark.createDataFrame(status, STATUS_SCHEMA)


def ingest_folders(spark: SparkSession, root: str, state: StateTable, table_root: str, keys=("Id",), tie=(),
                   modified: str = "SinkModifiedOn", created: str = "createdon", **options) -> DataFrame:
    """The whole job over change folders on storage: ``root/<folder>/<entity>/*.csv`` and
    a manifest ``root/<folder>/model.json`` that names each entity's columns.

    ``tie``: columns that, after ``modified`` and the folder, make the order of
    a key's rows total. Rejected rows: ``{table_root}/{entity}/rejected/upto=<watermark>``,
    which an attempt that is repeated writes anew.
    """
    files = change_files(spark, root)
    manifest = read_manifests(spark, f"{root.rstrip('/')}/*/model.json")
    columns: dict[str, dict[str, tuple]] = {}  # by entity and folder: as large as the manifests

    def snapshot(table: str, folders: list) -> tuple[DataFrame, int]:
        names = [f.name for f in folders]
        wanted = manifest.where((F.col("entity") == table) & F.col("folder").isin(names)).collect()
        columns[table] = {r.folder: tuple((a["name"], a["dataType"]) for a in r.attributes) for r in wanted}
        rows, bad = split_rejected(read_folders(spark, folders, columns[table]), keys)
        upto = max(f.max_last_modified for f in folders)
        path = f"{table_root.rstrip('/')}/{table}/rejected/upto={int(upto)}"
        write_parquet(bad, path, "overwrite")
        n = spark.read.schema(REJECTED_SCHEMA).parquet(path).count()
        return source_snapshot(rows, list(keys), modified, created, tie=[*tie]), n

    return run_ingest(spark, files, state, table_root, snapshot, keys, manifest=manifest.select("folder", "entity"), **options)
