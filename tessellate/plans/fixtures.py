"""Stand-in panels built from the driver tables (see FIXTURES.md, P1-P6).

Each helper returns a lazy DataFrame derived from the given tables, and the
matching SQL fragments used by the DuckDB oracles live next to it so both
sides describe the same data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import WeeklyCalendar, build_weekly_calendar, holiday_rules
from ..operators.panel import period_aggregate
from ..sources.tables import Tables

# Yearly holiday rules (month, day, name). The empty name is a
# deliberate "not a holiday" row (flag is the truthiness of the text).
HOLIDAYS = [
    (1, 1, "New Year"),
    (4, 30, "Reunification Day"),
    (5, 1, "Labour Day"),
    (9, 2, "National Day"),
    (12, 24, ""),
]

HOLIDAYS_SQL = "(VALUES " + ", ".join(
    f"({m}, {d}, '{n}')" for m, d, n in HOLIDAYS) + ") AS h(h_month, h_day, holiday)"


def week_sql(expr: str) -> str:
    """DuckDB: Tuesday-labelled week ending Monday."""
    return f"(CAST({expr} AS DATE) - CAST((isodow({expr}) + 5) % 7 AS INTEGER))"


def p1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly order count per priority (count target)."""
    t = Tables(spark, sf_dir)
    return period_aggregate(t.orders, ["o_orderpriority"], "o_orderdate", "o_orderkey",
                            how="count", period="week")


P1_SQL = f"""
SELECT o_orderpriority, {week_sql('o_orderdate')} AS date, count(o_orderkey) AS qty
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2"""


def p2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly quantity per (supplier, return flag) (sum target)."""
    t = Tables(spark, sf_dir)
    return period_aggregate(t.lineitem, ["l_suppkey", "l_returnflag"], "l_shipdate",
                            "l_quantity", how="sum", period="week")


P2_SQL = f"""
SELECT l_suppkey, l_returnflag, {week_sql('l_shipdate')} AS date,
       coalesce(sum(l_quantity), 0) AS qty
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2, 3"""


def p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value per (user, event type), summed exactly."""
    events = Tables(spark, sf_dir).events
    daily = period_aggregate(events.withColumn("value", F.col("value").cast("decimal(38,10)")), ["user_id", "event_type"],
                             "ts", "value", how="sum", period="day")
    return daily.withColumn("qty", F.col("qty").cast("double"))


P3_SQL = """
SELECT user_id, event_type, CAST(ts AS DATE) AS date, CAST(coalesce(sum(CAST(value AS DECIMAL(38,10))), 0) AS DOUBLE) AS qty
FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2, 3"""


def weekly_calendar_for(spark: SparkSession, facts: DataFrame, date_col: str) -> DataFrame:
    """Lazy weekly calendar frame over the span of ``facts[date_col]``."""
    return build_weekly_calendar(facts, date_col, holiday_rules(spark, HOLIDAYS))


def weekly_calendar_known(spark: SparkSession, facts: DataFrame, date_col: str) -> WeeklyCalendar:
    """Weekly calendar whose span is read first (size-checked broadcast)."""
    return WeeklyCalendar(facts, date_col, holiday_rules(spark, HOLIDAYS))


def weekly_calendar_sql(facts_table: str, date_expr: str) -> str:
    """CTE body list: ``span``, ``days``, ``cal`` (weekly calendar)."""
    return f"""
span AS (SELECT min({week_sql(date_expr)}) AS s, max({week_sql(date_expr)}) + 6 AS e FROM {facts_table}),
days AS (SELECT CAST(unnest(range(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) + INTERVAL 1 DAY,
                                  INTERVAL 1 DAY)) AS DATE) AS d FROM span),
cal_d AS (SELECT d, CASE WHEN holiday IS NOT NULL AND holiday <> '' THEN 1 ELSE 0 END AS is_hol,
                 CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_wknd
          FROM days LEFT JOIN {HOLIDAYS_SQL} ON month(d) = h_month AND day(d) = h_day),
cal AS (SELECT {week_sql('d')} AS date, CAST(sum(is_hol) AS INTEGER) AS is_holiday,
               CAST(sum(greatest(is_hol, is_wknd)) AS INTEGER) AS is_offline,
               CAST(year({week_sql('d')}) AS INTEGER) AS year,
               CAST(weekofyear({week_sql('d')}) AS INTEGER) AS week_of_year
        FROM cal_d GROUP BY 1)"""


def dense_sql(facts_cte: str, keys: list[str], end_expr: str | None = None) -> str:
    """CTE list producing ``dense``: keys x calendar from release to end, 0-filled.

    Needs the ``cal`` CTE; ``facts_cte`` has columns keys, date, qty.
    """
    k = ", ".join(keys)
    on = " AND ".join(f"f.{c} = g.{c}" for c in keys)
    end_expr = end_expr or f"(SELECT max(date) FROM {facts_cte})"
    return f"""
pkeys AS (SELECT DISTINCT {k} FROM {facts_cte}),
rel AS (SELECT {k}, min(date) AS rel FROM {facts_cte} WHERE qty > 0 GROUP BY {k}),
grid AS (SELECT {', '.join('pk.' + c for c in keys)}, cal.* FROM pkeys pk CROSS JOIN cal),
dense AS (SELECT {', '.join('g.' + c for c in keys)}, g.date, g.is_holiday, g.is_offline, g.year,
                 g.week_of_year, coalesce(f.qty, 0) AS qty, (g.date - rel.rel) / 7.0 AS release
          FROM grid g JOIN rel USING ({k})
          LEFT JOIN {facts_cte} f ON {on} AND f.date = g.date
          WHERE g.date >= rel.rel AND g.date <= {end_expr})"""
