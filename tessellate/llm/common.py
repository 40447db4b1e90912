"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellate.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: later steps read
    the files, so a lost executor costs no recomputation of what led to them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n - 1`` ascending values that cut ``key`` into even ranges."""
    if n < 2:
        return []
    probs = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(key, probs, max(10_000, 10 * n)).alias("b")).first()
    return sorted({int(x) for x in row["b"] or []})


def long_array(values) -> Column:
    """A constant array of longs that is one literal in the plan, however many values."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join("" if v is None else str(int(v)) for v in values)), ",").cast("array<string>").try_cast(
        "array<bigint>")


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range a key falls into (null keys: range 0).

    The bounds are literals, so the answer is a property of the row alone and
    is the same whenever a lost task runs again. The search looks at the
    bounds of groups first and then within one group, so that it takes the
    square root of the number of bounds.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    key = key.cast("long")
    below = lambda col: F.size(F.filter(col, lambda b: b < key))
    before = below(long_array([bounds[min(i + step, len(bounds)) - 1] for i in range(0, len(bounds), step)])) * F.lit(step)
    found = F.least(before + below(F.slice(long_array(bounds), before + 1, step)), F.lit(len(bounds)))
    return F.when(key.isNull(), F.lit(0)).otherwise(found).cast("int")


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salts: int = 64) -> DataFrame:
    """Left outer join to a right side of few rows with keys that may be hot on
    the left: left rows take a salt from their own values and the right side
    has a copy for each salt, so a key's rows are spread over ``salts`` groups."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    copies = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_copy")), "left").drop(
        "_salt", "_copy")


def per_worker() -> dict:
    """A dict that lives as long as the Python process. Functions of this
    package reach the workers by value, so their module's own globals start
    anew with each task; tables that take long to load are kept here."""
    return sys.modules.setdefault("tessellate_worker_memo", types.ModuleType("tessellate_worker_memo")).__dict__
