"""Table maintenance from commit history: what to compact, how, what expired."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..sources.files import list_files


def maintenance_candidates(history: DataFrame, table: str = "table_name", ts: str = "timestamp",
                           operation: str = "operation", now: Column | None = None,
                           last_n: int = 20, op_value: str = "MERGE", min_count: int = 1,
                           tie=None) -> DataFrame:
    """Tables whose last ``last_n`` commits hold more than ``min_count`` merges
    since yesterday 00:00 (relative to ``now``) and not after ``now``.

    ``row_number() <= n`` per table is planned as a group limit (top rows per
    task kept before the shuffle), so a table with a huge history is cheap.
    """
    now = now if now is not None else F.current_timestamp()
    order = [F.col(ts).desc()] + [F.col(c).desc() for c in as_list(tie)]
    w = Window.partitionBy(table).orderBy(*order)
    since = F.date_sub(F.to_date(now), 1).cast("timestamp_ntz")
    recent = history.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= last_n)
    until = now.cast("timestamp_ntz")
    return (recent.where((F.col(operation) == op_value) & (F.col(ts) >= since) & (F.col(ts) <= until))
            .groupBy(table).agg(F.count(F.lit(1)).alias("n_merges"))
            .where(F.col("n_merges") > min_count))


def compact(df: DataFrame, by, total_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """Cluster rows by ``by`` into files of about ``target_bytes``.

    Equal values of ``by`` would stay in one range (one load time may hold all
    rows), so a hash of the row is a further range column: a hot value is
    split across files.
    """
    n = max(1, math.ceil(total_bytes / target_bytes))
    by = as_list(by)
    rest = F.xxhash64(*df.columns)
    return df.repartitionByRange(n, *[F.col(c) for c in by], rest).sortWithinPartitions(*by)


def expired_files(files: DataFrame, live_dirs: DataFrame, now: Column, retention_hours: int = 168) -> DataFrame:
    """Files older than the retention that are not under a live folder.

    ``files``: ``(path, modified)``; ``live_dirs``: ``(dir)``. Report only;
    nothing is deleted.
    """
    cutoff = now - F.expr(f"INTERVAL {int(retention_hours)} HOURS")
    f = files.where(F.col("modified") < cutoff) \
             .withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    return f.join(live_dirs, "dir", "left_anti").select("path", "modified")


def input_bytes(spark, root: str) -> int:
    """Total size of the files under ``root``: one listing job (file metadata
    only, contents are not read)."""
    listing = list_files(spark, root)
    return int(listing.agg(F.sum("length")).first()[0] or 0)
