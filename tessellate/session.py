"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library expects; callers on a cluster normally have
# them already and builder settings only apply when a new session is made.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessellate", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage, and must be set. Only a
    local master (tests) gets a fresh local folder when it is unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tessellate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one job's output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    shared_dir(spark)
    return df.checkpoint(eager=True)


MOST_BUCKETS = 100_000  # that Spark allows a table


def stored(df, name: str, by=None, buckets: int | None = None):
    """Write ``df`` once into the shared folder and read it back: every later
    use sees the same rows, and a lost executor costs no recomputation. With ``buckets``
    the rows lie in so many of them by the columns ``by``: windows and joins on these
    read them there and move none."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not buckets:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    # only tables have buckets: this one is named until its files are known
    table = path.rsplit("/", 1)[1].replace("-", "_")
    (df.write.format("parquet").option("path", path).bucketBy(min(buckets, MOST_BUCKETS), *by).saveAsTable(table))
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


ROWS_PER_TASK = 500_000  # of a panel that tasks sort


def tasks_of(spark: SparkSession, rows: int | None) -> int | None:
    """Tasks for so many rows, if they are more than the cluster runs at once: a number
    that grows with the rows, so a task's share does not. None leaves it to the planner."""
    tasks = -(-int(rows or 0) // ROWS_PER_TASK)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system of the path (the cluster's default one without a scheme)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p))
