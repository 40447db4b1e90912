"""Type narrowing and label encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list

# Integer ladder tried from narrowest (Spark type, min, max).
INT_LADDER = [
    ("tinyint", -(2 ** 7), 2 ** 7 - 1),
    ("smallint", -(2 ** 15), 2 ** 15 - 1),
    ("int", -(2 ** 31), 2 ** 31 - 1),
    ("bigint", -(2 ** 63), 2 ** 63 - 1),
]
FLOAT32_MAX = 3.4028234663852886e38

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def narrow_types_plan(df: DataFrame) -> DataFrame:
    """One aggregate pass: per numeric column its min, max and narrowest type.

    Integers take the narrowest integer type holding [min, max]; floating
    columns become float only when the range fits float32 (no half precision:
    it cannot hold integers above 2048). Result: ``(column, min_value,
    max_value, narrow_type)`` with one row per numeric column.
    """
    num = [f for f in df.schema.fields if isinstance(f.dataType, _INTS + _FLOATS)]
    if not num:
        return df.sparkSession.createDataFrame([], "column string, min_value double, "
                                                   "max_value double, narrow_type string")
    aggs = []
    for f in num:
        aggs += [F.min(f"`{f.name}`").cast("double").alias(f"mn__{f.name}"),
                 F.max(f"`{f.name}`").cast("double").alias(f"mx__{f.name}")]
    row = df.agg(*aggs)
    items = []
    for f in num:
        mn, mx = F.col(f"mn__{f.name}"), F.col(f"mx__{f.name}")
        if isinstance(f.dataType, _INTS):
            t = F.lit(None).cast("string")
            for name, lo, hi in reversed(INT_LADDER):
                t = F.when((mn >= lo) & (mx <= hi), F.lit(name)).otherwise(t)
            t = F.coalesce(t, F.lit(f.dataType.simpleString()))
        else:
            t = F.when((mn >= -FLOAT32_MAX) & (mx <= FLOAT32_MAX), F.lit("float")).otherwise(F.lit("double"))
        items.append(F.struct(F.lit(f.name).alias("column"), mn.alias("min_value"),
                              mx.alias("max_value"), t.alias("narrow_type")))
    return row.select(F.inline(F.array(*items)))


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numeric columns to the narrowest type their values allow.

    The plan is a single-row-per-column aggregate, collected (a few dozen
    scalars) to choose the casts; the data itself stays distributed.
    """
    plan = {r["column"]: r["narrow_type"] for r in narrow_types_plan(df).collect()}
    return df.select(*[F.col(f"`{c}`").cast(plan[c]).alias(c) if c in plan else F.col(f"`{c}`")
                       for c in df.columns])


def label_codes(df: DataFrame, partition_cols, value_col: str, code_col: str | None = None) -> DataFrame:
    """Code = rank of the value among the sorted distinct values of its partition, from 0.

    Ranks are taken over the distinct (partition, value) pairs, so a partition's
    window holds at most its number of distinct values, never its rows.
    """
    parts = as_list(partition_cols)
    code_col = code_col or f"{value_col}_le"
    distinct = df.select(*parts, value_col).where(F.col(value_col).isNotNull()).distinct()
    w = Window.partitionBy(*parts).orderBy(value_col)
    return distinct.select(*parts, value_col, (F.dense_rank().over(w) - 1).alias(code_col))


def label_encode(df: DataFrame, partition_cols, value_col: str, code_col: str | None = None) -> DataFrame:
    """Attach the per-partition label code of ``value_col`` to every row."""
    parts = as_list(partition_cols)
    codes = label_codes(df, parts, value_col, code_col)
    return df.join(codes, on=parts + [value_col], how="left")
