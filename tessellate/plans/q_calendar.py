"""Queries: calendar functions (C1-C9) and date keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators.calendar import attach_holidays, day_spine, holiday_rules, span_of
from ..sources.tables import Tables
from . import fixtures as fx
from .registry import query


@query("date_spine", """
SELECT CAST(unnest(range(CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP),
                         CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) + INTERVAL 1 DAY,
                         INTERVAL 1 DAY)) AS DATE) AS date
FROM orders""")
def date_spine(spark, sf_dir):
    return day_spine(span_of(Tables(spark, sf_dir).orders, "o_orderdate", weekly=False))


@query("holiday_join", f"""
WITH days AS (SELECT CAST(unnest(range(CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP),
                         CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) + INTERVAL 1 DAY,
                         INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
SELECT date, holiday,
       CAST(CASE WHEN holiday IS NOT NULL AND holiday <> '' THEN 1 ELSE 0 END AS INTEGER) AS is_holiday
FROM days LEFT JOIN {fx.HOLIDAYS_SQL} ON month(date) = h_month AND day(date) = h_day""")
def holiday_join(spark, sf_dir):
    days = day_spine(span_of(Tables(spark, sf_dir).orders, "o_orderdate", weekly=False))
    out = attach_holidays(days, holiday_rules(spark, fx.HOLIDAYS))
    return out.select("date", "holiday", cal.holiday_flag("holiday").alias("is_holiday"))


@query("date_parts", """
SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_wknd,
       CAST(day(o_orderdate) = 1 AS INTEGER) AS is_month_start,
       CAST(CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS INTEGER) AS is_month_end
FROM orders""")
def date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", *cal.date_parts("o_orderdate"))


@query("moon_phase", """
SELECT o_orderkey, CAST(floor(((0.20439731 + datediff('microsecond', TIMESTAMP '2001-01-01 00:00:00',
         o_orderdate) / 86400e6 * 0.03386319269)
       - floor(0.20439731 + datediff('microsecond', TIMESTAMP '2001-01-01 00:00:00', o_orderdate)
         / 86400e6 * 0.03386319269)) * 8 + 0.5) AS INTEGER) & 7 AS moon
FROM orders""")
def moon_phase(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", cal.moon_phase("o_orderdate").alias("moon"))


@query("week_bucket", f"""
SELECT o_orderkey, {fx.week_sql('o_orderdate')} AS week FROM orders""")
def week_bucket(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", cal.week_bucket("o_orderdate").alias("week"))


@query("calendar_weekly", f"""
WITH {fx.weekly_calendar_sql('orders', 'o_orderdate')}
SELECT * FROM cal""")
def calendar_weekly(spark, sf_dir):
    return fx.weekly_calendar_for(spark, Tables(spark, sf_dir).orders, "o_orderdate")


@query("parse_dates", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_day,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts
FROM orders""")
def parse_dates(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select(
        "o_orderkey",
        cal.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("order_day"),
        F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
                           F.lit("yyyy-MM-dd HH:mm:ss")).alias("order_ts"))


@query("partition_year", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS PartitionId FROM orders""")
def partition_year(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", cal.partition_year("o_orderdate").alias("PartitionId"))


@query("date_keys", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _yearkey,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS _monthkey,
       CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
         AS _datekey
FROM orders""")
def date_keys(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", *cal.date_keys("o_orderdate"))
