"""Joins: left merge without clashes, stats attach, semi/anti, lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_list


def left_merge(left: DataFrame, right: DataFrame, on, salts: int = 32) -> DataFrame:
    """Left join on ``on`` where null keys match each other (like a pandas merge).

    Right-side columns that clash with a left column are dropped; the key
    columns come from the left. Duplicate right keys multiply left rows.

    Rows whose key has a null go their own way: with a plain null-safe join
    they would all hash to one task. Non-null keys use an ordinary equi-join;
    null-key left rows take one of ``salts`` salts and meet a copy of the
    right side's null-key rows for it, so they are spread over that many
    tasks at any size.
    """
    on = as_list(on)
    extra = [c for c in right.columns if c not in left.columns]
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in on], *extra)
    any_null_l = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    any_null_r = reduce(lambda a, b: a | b, [F.col(f"__r_{c}").isNull() for c in on])

    def joined(lft, rgt, null_safe):
        cond = lft["__salt"] == rgt["__salt"] if null_safe else None
        for c in on:
            e = lft[c].eqNullSafe(rgt[f"__r_{c}"]) if null_safe else lft[c] == rgt[f"__r_{c}"]
            cond = e if cond is None else cond & e
        return lft.join(rgt, cond, "left").select(*[lft[c] for c in left.columns], *[rgt[c] for c in extra])

    main = joined(left.where(~any_null_l), r.where(~any_null_r), False)
    r_null = r.where(any_null_r).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    l_null = left.where(any_null_l).withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    return main.unionByName(joined(l_null, r_null, True))


def attach_group_stats(df: DataFrame, stats: DataFrame, keys) -> DataFrame:
    """Left join per-group statistics (aggregate then join, not a window).

    The aggregate is combined map-side; AQE broadcasts it when small or splits
    a skewed key on the join, so no group has to fit one task.
    """
    return df.join(stats, on=as_list(keys), how="left")


def keep_with_history(df: DataFrame, history: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose keys appear in ``history`` (left semi join)."""
    return df.join(history.select(*as_list(keys)), on=as_list(keys), how="left_semi")


def lookup_with_default(df: DataFrame, name_col: str, gazetteer: DataFrame, gaz_name: str,
                        value_cols, default_name: str = "") -> DataFrame:
    """Look up ``value_cols`` by normalised name; blank names use the default row.

    The gazetteer is keyed by ``lower(trim(name))``; the row whose name equals
    ``default_name`` supplies the values for null/blank inputs.
    """
    value_cols = as_list(value_cols)
    norm = F.lower(F.trim(F.col(name_col)))
    key = F.when(norm.isNull() | (norm == ""), F.lit(default_name)).otherwise(norm)
    g = gazetteer.select(F.lower(F.trim(F.col(gaz_name))).alias("__gkey"), *value_cols)
    return df.withColumn("__key", key).join(g, F.col("__key") == F.col("__gkey"), "left") \
             .drop("__key", "__gkey")
