"""Date and calendar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def to_day(c) -> Column:
    """Timestamp / text / date -> DATE."""
    return F.to_date(as_col(c))


def week_bucket(c) -> Column:
    """Weekly period that ends on Monday, labelled by its first day (a Tuesday).

    ``dayofweek`` is 1 = Sunday ... 7 = Saturday, so Tuesday maps to 0 days back.
    """
    d = to_day(c)
    return F.date_sub(d, (F.dayofweek(d) + 4) % 7)


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(to_day(c))


def moon_phase(c) -> Column:
    """Moon phase 0..7 from (fractional) days since 2001-01-01."""
    ts = as_col(c).cast("timestamp_ntz")
    base = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    days = F.timestamp_diff("MICROSECOND", base, ts) / F.lit(86400e6)
    # fixed values of the lunation approximation
    lunations = F.lit(0.20439731) + days * F.lit(0.03386319269)
    frac = F.pmod(lunations, F.lit(1.0))
    return F.floor(frac * 8 + 0.5).cast("int").bitwiseAND(F.lit(7))


def date_parts(c, prefix: str = "") -> list[Column]:
    """Calendar attributes of a date column, named like the pandas originals."""
    d = to_day(c)
    wd = F.weekday(d)
    return [
        F.dayofmonth(d).alias(f"{prefix}day_of_month"),
        F.dayofyear(d).alias(f"{prefix}day_of_year"),
        wd.alias(f"{prefix}day_of_week"),
        F.weekofyear(d).alias(f"{prefix}week_of_year"),
        F.month(d).alias(f"{prefix}month"),
        F.year(d).alias(f"{prefix}year"),
        (wd >= 5).cast("int").alias(f"{prefix}is_wknd"),
        (F.dayofmonth(d) == 1).cast("int").alias(f"{prefix}is_month_start"),
        (d == F.last_day(d)).cast("int").alias(f"{prefix}is_month_end"),
    ]


def date_keys(c) -> list[Column]:
    """Integer year / yyyymm / yyyymmdd keys used to lay out audit folders."""
    d = to_day(c)
    y, m, dd = F.year(d), F.month(d), F.dayofmonth(d)
    return [y.alias("_yearkey"), (y * 100 + m).alias("_monthkey"),
            (y * 10000 + m * 100 + dd).alias("_datekey")]


def partition_year(c) -> Column:
    return F.year(as_col(c))


def holiday_flag(c) -> Column:
    """Truthiness of a holiday name: null and empty text are not holidays."""
    h = as_col(c)
    return F.when(h.isNotNull() & (h != F.lit("")), 1).otherwise(0)


def parse_date(c, fmt: str | None = None) -> Column:
    return F.to_date(as_col(c), fmt) if fmt else F.to_date(as_col(c))


def epoch_seconds(c) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock (``timestamp_ntz``) value,
    independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, as_col(c).cast("timestamp_ntz"))
