"""Column selection, unions, unpivot and cell-level frame diff."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_list


def select_except(df: DataFrame, drop) -> DataFrame:
    drop = set(as_list(drop))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop])


def dropna_any(df: DataFrame, subset=None) -> DataFrame:
    return df.dropna(how="any", subset=as_list(subset) or None)


def union_by_name(frames) -> DataFrame:
    """Union by column name; columns missing in a frame become null."""
    frames = list(frames)
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_wide(df: DataFrame, ids, values, var_name: str = "variable",
                 value_name: str = "value") -> DataFrame:
    """Wide -> long (one row per id and value column); values must share a type."""
    return df.unpivot(as_list(ids), as_list(values), var_name, value_name)


def frame_diff(left: DataFrame, right: DataFrame, keys, columns=None) -> DataFrame:
    """Cells that differ between two frames with the same keys (null == null).

    Full outer join on the keys, compare each column null-safely, unpivot the
    differing cells to ``(keys..., column, left_value, right_value)`` as text.
    Rows present on one side only show every column as differing.
    """
    keys = as_list(keys)
    columns = columns or [c for c in left.columns if c not in keys]
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    l = left.select(*keys, *[F.col(c).alias(f"l__{c}") for c in columns])
    r = right.select(*keys, *[F.col(c).alias(f"r__{c}") for c in columns])
    # a null key never matches: such rows skip the join (where they would all
    # hash to one task) and are one-sided by definition
    l_only = l.where(null_key).select(*keys, *[F.col(f"l__{c}") for c in columns],
                                      *[F.lit(None).cast(left.schema[c].dataType).alias(f"r__{c}") for c in columns])
    r_only = r.where(null_key).select(*keys, *[F.lit(None).cast(right.schema[c].dataType).alias(f"l__{c}")
                                               for c in columns], *[F.col(f"r__{c}") for c in columns])
    j = (l.where(~null_key).join(r.where(~null_key), on=keys, how="full_outer")
         .unionByName(l_only).unionByName(r_only))
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"l__{c}").cast("string").alias("left_value"),
                 F.col(f"r__{c}").cast("string").alias("right_value"),
                 (~F.col(f"l__{c}").eqNullSafe(F.col(f"r__{c}"))).alias("differs"))
        for c in columns])
    return (j.select(*keys, F.inline(F.filter(cells, lambda s: s["differs"])))
            .drop("differs"))
