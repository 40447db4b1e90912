"""Incremental loads from change folders.

Change folders are named by sortable timestamp text and contain one sub-folder
per entity (table). The work plan is computed as one DataFrame over the file
listing instead of a driver loop over folders and tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..functions.columns import hash_shard
from .dedup import latest_by

FOLDER_SCHEMA = ("struct<name:string,path:string,max_last_modified:bigint>")


def folder_range(folders: DataFrame, last: str | None, current: str | None,
                 col: str = "folder") -> DataFrame:
    """Folders with ``last <= folder < current`` (text order = time order)."""
    cond = F.lit(True)
    if last is not None:
        cond = cond & (F.col(col) >= F.lit(last))
    if current is not None:
        cond = cond & (F.col(col) < F.lit(current))
    return folders.where(cond)


def load_plan(files: DataFrame, state: DataFrame, manifest: DataFrame | None = None,
              include=None, exclude=None, num_shards: int = 1, shard: int = 0,
              last_folder: str | None = None, current_folder: str | None = None) -> DataFrame:
    """One row per target table with its folders and load decision.

    ``files``: ``(folder, entity, path, modified)`` with ``modified`` as epoch
    integer; ``state``: ``(table_name, last_watermark)``; ``manifest``:
    ``(folder, entity)`` pairs a folder declares. Output columns:
    ``table_name, folders (sorted array of struct name/path/max_last_modified),
    new_watermark, last_watermark, is_exists, has_data, is_first_load``.
    Folders not newer than the watermark are dropped unless first load.
    """
    f = folder_range(files, last_folder, current_folder)
    if manifest is not None:
        f = f.join(manifest.select("folder", "entity").distinct(), ["folder", "entity"], "left_semi")
    if include:
        f = f.where(F.col("entity").isin(*as_list(include)))
    if exclude:
        f = f.where(~F.col("entity").isin(*as_list(exclude)))
    if num_shards > 1:
        f = f.where(hash_shard("entity", num_shards) == shard)
    per_folder = (f.groupBy("entity", "folder")
                  .agg(F.max("modified").cast("long").alias("max_last_modified"),
                       F.min("path").alias("path")))
    per_table = (per_folder.groupBy(F.col("entity").alias("table_name"))
                 .agg(F.sort_array(F.collect_list(F.struct(
                     F.col("folder").alias("name"), "path", "max_last_modified"))).alias("folders"),
                      F.max("max_last_modified").alias("new_watermark")))
    st = state.select("table_name", F.col("last_watermark").cast("long").alias("_wm"))
    j = per_table.join(st, "table_name", "left")
    exists = F.col("_wm").isNotNull()
    last_wm = F.coalesce(F.col("_wm"), F.lit(0).cast("long"))
    kept = F.when(exists, F.filter("folders", lambda s: s["max_last_modified"] > last_wm)) \
            .otherwise(F.col("folders"))
    return j.select("table_name", kept.alias("folders"), "new_watermark",
                    last_wm.alias("last_watermark"), exists.alias("is_exists"),
                    (F.col("new_watermark") > last_wm).alias("has_data"),
                    (~exists).alias("is_first_load"))


def source_snapshot(df: DataFrame, keys=("Id",), modified: str = "SinkModifiedOn",
                    created: str = "createdon", folder_col: str = "__folder",
                    load_time: Column | None = None, tie=None) -> DataFrame:
    """Latest row per key across all folders, plus partition / lineage columns.

    ``PartitionId`` = year of creation; ``__source_folder`` is each row's own
    folder; ``__updated_at`` the load time. Dedup is a window per key
    (parallel), not a sort into one partition. ``tie``: columns that make
    the order of a key's rows total; by default all remaining columns, so a
    tie can only be between equal rows.
    """
    order = [modified] + [folder_col]
    rest = as_list(tie) or [c for c in df.columns if c not in [*order, *as_list(keys)]]
    order += rest
    latest = latest_by(df, as_list(keys), order)
    stamp = load_time if load_time is not None else F.current_timestamp()
    out = latest.withColumn("PartitionId", F.year(created)) \
                .withColumn("__source_folder", F.col(folder_col)) \
                .withColumn("__updated_at", stamp)
    return out.drop(folder_col)


def upsert_soft_delete(target: DataFrame, source: DataFrame, keys=("Id",),
                       delete_col: str = "IsDelete", updated_col: str = "__updated_at") -> DataFrame:
    """New table state after merging ``source`` into ``target``.

    Matched with delete flag true: only the flag and load time change.
    Matched otherwise (false or null flag): every source column is updated,
    target-only columns keep their value. Unmatched source rows are inserted
    (target-only columns null); unmatched target rows are kept. Keys match by
    plain equality, so null keys never match (they are inserted again).
    New source columns are added (schema evolution).

    ``source`` must hold at most one row per key (see ``source_snapshot``).
    """
    keys = as_list(keys)
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    any_null_t = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    any_null_s = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # rows with a null key can never match: keep them out of the join, where
    # they would all hash to one task, and append them directly
    t_null = target.where(any_null_t).select(*[
        (F.col(c) if c in target.columns else F.lit(None).cast(source.schema[c].dataType)).alias(c) for c in cols])
    s_null = source.where(any_null_s).select(*[
        (F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in cols])
    t = target.where(~any_null_t).select(*[F.col(c).alias(f"t__{c}") for c in target.columns],
                                         F.lit(True).alias("__t"))
    s = source.where(~any_null_s).select(*[F.col(c).alias(f"s__{c}") for c in source.columns],
                                         F.lit(True).alias("__s"))
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    has_t, has_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    matched = has_t & has_s
    deleted = matched & F.col(f"s__{delete_col}").eqNullSafe(F.lit(True))
    out = []
    for c in cols:
        in_t, in_s = c in target.columns, c in source.columns
        tc, sc = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c in keys:
            e = F.when(has_s, sc).otherwise(tc)
        elif c in (delete_col, updated_col) and in_s:
            e = F.when(has_s, sc).otherwise(tc) if in_t else sc
        elif in_t and in_s:
            e = F.when(deleted | ~has_s, tc).otherwise(sc)
        elif in_t:
            e = F.when(has_t, tc)
        else:
            e = F.when(has_s & ~deleted, sc)
        out.append(e.alias(c))
    return j.select(*out).unionByName(t_null).unionByName(s_null)


def attempt_rollup(status: DataFrame, key: str, attempt: str, status_col: str = "status",
                   start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Per work item: number of attempts, final status (of the last attempt), span."""
    return status.groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"), F.max(attempt).alias("last_attempt"),
        F.max_by(status_col, attempt).alias("final_status"),
        F.min(start).alias("first_start"), F.max(end).alias("last_end"))
