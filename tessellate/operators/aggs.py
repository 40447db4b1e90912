"""Aggregations: group statistics, value counts, error metrics, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list


def group_stats(df: DataFrame, keys, value: str, prefix: str | None = None,
                stats=("max", "min", "std", "mean", "nunique"), money: bool = False) -> DataFrame:
    """max / min / sample std / mean / distinct count of ``value`` per key.

    ``money``: the mean is summed exactly in DECIMAL (order-independent).
    """
    p = prefix or value
    mean = (lambda c: F.sum(F.col(c).cast("decimal(38,8)")).cast("double") / F.count(c)) if money else F.avg
    fns = {"max": F.max, "min": F.min, "std": F.stddev_samp, "mean": mean,
           "nunique": lambda c: F.count_distinct(c)}
    keys = as_list(keys)
    return (df.where(_not_null(keys)).groupBy(*keys)
            .agg(*[fns[s](value).alias(f"{p}_{s}") for s in stats]))


def _not_null(keys) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-null value, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col)))


def rmse(actual: str, predicted: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)))


def rmse_by_group(df: DataFrame, keys, actual: str, predicted: str) -> DataFrame:
    """RMSE per group, worst first."""
    keys = as_list(keys)
    return (df.groupBy(*keys).agg(rmse(actual, predicted).alias("rmse"),
                                  F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("rmse").desc()))


def forecast_totals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(rmse(actual, predicted).alias("rmse"), F.sum(actual).alias("sum_actual"),
                  F.sum(predicted).alias("sum_predicted"), F.count(F.lit(1)).alias("n"))


def quartiles(df: DataFrame, keys, value: str) -> DataFrame:
    """Exact min / q1 / median / q3 / max (linear interpolation) per group.

    Intended for score tables (one value per model, fold or series), whose
    groups are bounded by the number of series rather than the fact rows.
    """
    keys = as_list(keys)
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return (df.groupBy(*keys).agg(q.alias("_q"))
            .select(*keys, *[F.col("_q")[i].alias(n) for i, n in
                             enumerate(["q0", "q1", "q2", "q3", "q4"])]))


def column_profile(df: DataFrame, columns=None) -> DataFrame:
    """One row per column: dtype, non-null count, distinct count, min and max as text.

    Counts, minima and maxima come from one aggregate pass; each distinct
    count is its own grouped aggregate over one pruned column (partial
    aggregation keeps only distinct values per task before the shuffle),
    rather than one aggregate that expands every row once per column.
    """
    columns = columns or df.columns
    dtypes = dict(df.dtypes)
    aggs = []
    for c in columns:
        q = F.col(f"`{c}`")
        aggs += [F.count(q).alias(f"nn__{c}"), F.min(q).cast("string").alias(f"mn__{c}"),
                 F.max(q).cast("string").alias(f"mx__{c}")]
    row = df.agg(*aggs)
    basic = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"nn__{c}").alias("non_null"), F.col(f"mn__{c}").alias("min_value"),
                 F.col(f"mx__{c}").alias("max_value")) for c in columns])))
    distinct = None
    for c in columns:
        d = (df.select(F.col(f"`{c}`").alias("v")).where(F.col("v").isNotNull()).distinct()
             .agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct"))
        distinct = d if distinct is None else distinct.unionByName(d)
    out = basic.join(distinct, "column")
    return out.select("column", "dtype", "non_null", "n_distinct", "min_value", "max_value")


def status_summary(df: DataFrame, status_col: str, failed="FAILED", skipped="SKIPPED") -> DataFrame:
    """Job totals: total / failed / succeeded / skipped / loaded."""
    s = F.col(status_col)
    total = F.count(F.lit(1))
    n_failed = F.count(F.when(s == failed, 1))
    n_skipped = F.count(F.when(s == skipped, 1))
    return df.agg(total.alias("total"), n_failed.alias("failed"),
                  (total - n_failed).alias("succeeded"), n_skipped.alias("skipped"),
                  (total - n_failed - n_skipped).alias("loaded"))


def collect_sorted(df: DataFrame, keys, item_cols, max_col: str, list_name: str = "items") -> DataFrame:
    """Per key: sorted list of distinct item structs and the max of ``max_col``.

    Callers pass items whose count per key is bounded (folders per table,
    months per customer); duplicates are removed before collecting.
    """
    keys, item_cols = as_list(keys), as_list(item_cols)
    return (df.select(*keys, *item_cols).distinct()
            .groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(*item_cols))).alias(list_name),
                 F.max(max_col).alias(f"max_{max_col}")))


def filter_items(list_col: str, field: str, threshold) -> Column:
    """Keep list elements whose ``field`` is greater than ``threshold``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.filter(F.col(list_col), lambda s: s[field] > thr)
