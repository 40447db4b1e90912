"""Keep one row per key under a total order (parallel, order-independent).

Sorting and then dropping duplicates does not promise which row survives;
``row_number`` over a window with a total order (key columns plus
tie-breakers) does, and it runs per key partition instead of in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list


def _pick(df: DataFrame, keys, order, descending: bool) -> DataFrame:
    keys, order = as_list(keys), as_list(order)
    ocols = [(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()) for c in order]
    w = Window.partitionBy(*keys).orderBy(*ocols)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def latest_by(df: DataFrame, keys, order) -> DataFrame:
    """Row with the greatest ``order`` tuple per key (add tie-breakers to ``order``).

    Spark plans ``row_number() == 1`` as a group limit that keeps only the
    top row per key in each task before the shuffle, so a hot key does not
    ship all its rows.
    """
    return _pick(df, keys, order, descending=True)


def earliest_by(df: DataFrame, keys, order) -> DataFrame:
    return _pick(df, keys, order, descending=False)


def _ordering(order, descending: bool) -> list:
    """Column names in the given direction, nulls last; sort columns as they are."""
    return [(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()) if isinstance(c, str) else c
            for c in as_list(order)]


def top_n_per_group(df: DataFrame, keys, order, n: int, descending: bool = True) -> DataFrame:
    w = Window.partitionBy(*as_list(keys)).orderBy(*_ordering(order, descending))
    return (df.withColumn("rank_in_group", F.row_number().over(w))
            .where(F.col("rank_in_group") <= n))


def top_n(df: DataFrame, order, n: int, descending: bool = True) -> DataFrame:
    return df.orderBy(*_ordering(order, descending)).limit(n)
