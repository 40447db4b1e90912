"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = spark_rounding_sql(sql)
        return fn

    return deco


WHOLE = 2.0 ** 52  # from here on a double has no digits after the point


def _scale(digits: str) -> str:
    return repr(10.0 ** int(digits))


def fast_round(c, digits: int):
    """Round half up in plain double arithmetic: ``floor(x * 10^d + 0.5) / 10^d``;
    values of 2^52 units or more, infinities and NaN have no such digits and stay.

    Used on both sides of the oracle comparison: the same IEEE operations
    on the same input give the same result in Spark and DuckDB, and unlike
    ``round()`` (which goes through BigDecimal per value) it stays inside
    generated code, which matters for outputs with hundreds of columns.
    """
    col = c if not isinstance(c, str) else F.col(f"`{c}`")
    k = 10.0 ** digits
    x = col.cast("double")
    # NaN compares as the largest value, so it is kept as well
    return F.when(F.abs(x) * F.lit(k) >= F.lit(WHOLE), x).otherwise(F.floor(x * F.lit(k) + F.lit(0.5)) / F.lit(k))


def spark_rounding_sql(sql: str) -> str:
    """Rewrite DuckDB ``round(x, d)`` into the ``fast_round`` expression."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_expr = spark_rounding_sql(sql[j + 6:comma])
        digits = sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        x, k10 = f"CAST(({inner_expr}) AS DOUBLE)", _scale(digits)
        out.append(f"(CASE WHEN abs({x}) * {k10} >= {WHOLE!r} THEN {x} ELSE floor({x} * {k10} + 0.5) / {k10} END)")
        i = k


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (oracle hygiene: both sides round)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            # + 0.0 turns -0.0 into 0.0 so signed zeros hash alike on both sides
            cols.append((fast_round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def load_all() -> None:
    """Import every query module so their decorators run."""
    from . import (q_calendar, q_columns, q_features, q_forecast, q_ingest,  # noqa: F401
                   q_maintenance, q_models, q_panel, q_relational)
