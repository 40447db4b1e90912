"""Calendar dimension: day spine, holidays, weekly roll-up.

The calendar is one row per day (or week) of a date span, so its size is
bounded by the span, not by the fact data; that bound is what makes it safe to
broadcast into the fact-side joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import holiday_flag, to_day, week_bucket

def span_of(df: DataFrame, date_col: str, weekly: bool = True) -> DataFrame:
    """One-row frame ``(start, end)`` covering the dates of ``df``.

    With ``weekly`` the span is widened to whole Tuesday..Monday weeks.
    """
    d = to_day(date_col)
    lo, hi = F.min(d), F.max(d)
    if weekly:
        lo, hi = week_bucket(lo), F.date_add(week_bucket(hi), 6)
    return df.agg(lo.alias("start"), hi.alias("end"))


def day_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Explode a one-row ``(start, end)`` frame into one row per day."""
    return bounds.select(
        F.explode(F.sequence(to_day(start), to_day(end), F.expr("INTERVAL 1 DAY"))).alias("date"))


def holiday_rules(spark: SparkSession, rules) -> DataFrame:
    """``[(month, day, name), ...]`` -> small frame of yearly holiday rules."""
    return spark.createDataFrame(list(rules), "h_month int, h_day int, holiday string")


def attach_holidays(days: DataFrame, rules: DataFrame, date_col: str = "date") -> DataFrame:
    """Left join the holiday name for each day (null when none).

    Of several rules for a day the first by name counts, and only days that a
    month can have; so at most 372 rows are broadcast.
    """
    d = to_day(date_col)
    rules = (rules.where(F.col("h_month").between(1, 12) & F.col("h_day").between(1, 31))
             .groupBy("h_month", "h_day").agg(F.min("holiday").alias("holiday")))
    return (days.join(F.broadcast(rules),
                      (F.month(d) == F.col("h_month")) & (F.dayofmonth(d) == F.col("h_day")),
                      "left")
            .drop("h_month", "h_day"))


def daily_flags(days: DataFrame, date_col: str = "date", holiday_col: str = "holiday") -> DataFrame:
    d = to_day(date_col)
    is_hol = holiday_flag(holiday_col)
    is_wknd = (F.weekday(d) >= 5).cast("int")
    return days.select("*", is_hol.alias("is_holiday"), is_wknd.alias("is_wknd"),
                       F.greatest(is_hol, is_wknd).alias("is_offline"))


def weekly_calendar(days: DataFrame, date_col: str = "date",
                    holiday_col: str = "holiday") -> DataFrame:
    """Per Tuesday..Monday week: holiday and offline day counts, year, ISO week."""
    flagged = daily_flags(days, date_col, holiday_col)
    wk = week_bucket(date_col)
    return (flagged.groupBy(wk.alias("date"))
            .agg(F.sum("is_holiday").cast("int").alias("is_holiday"),
                 F.sum("is_offline").cast("int").alias("is_offline"))
            .select("date", "is_holiday", "is_offline",
                    F.year("date").alias("year"), F.weekofyear("date").alias("week_of_year")))


def build_weekly_calendar(facts: DataFrame, date_col: str, rules: DataFrame) -> DataFrame:
    """Weekly calendar over the whole weeks spanned by ``facts[date_col]`` (lazy)."""
    days = day_spine(span_of(facts, date_col, weekly=True))
    return weekly_calendar(attach_holidays(days, rules))


class WeeklyCalendar:
    """Weekly calendar over the span of the facts, all lazy.

    ``frame`` has one row per week. Dates lie in the years 1 to 9999, so it has
    at most 521,722 rows of five small columns: that bound is what makes the
    broadcast into the fact side safe at any size of the facts.
    ``last_week`` is a scalar subquery: the first day of the last whole week.
    """

    def __init__(self, facts: DataFrame, date_col: str, rules: DataFrame):
        self.frame = build_weekly_calendar(facts, date_col, rules)
        self.last_week = span_of(facts, date_col, weekly=True).select(F.date_sub("end", 6)).scalar()
