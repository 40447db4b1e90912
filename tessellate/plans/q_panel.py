"""Queries: weekly panels, dense spine, lag / rolling / EWM / encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.panel import spine_fill
from ..operators.windows import lag_features, rolling_features
from . import fixtures as fx
from .registry import query, rounded

ROLL_SQL = ("CASE WHEN count(qty) OVER (PARTITION BY {k} ORDER BY date ROWS BETWEEN {a} PRECEDING "
            "AND {b} PRECEDING) = {w} THEN round({fn}(qty) OVER (PARTITION BY {k} ORDER BY date "
            "ROWS BETWEEN {a} PRECEDING AND {b} PRECEDING), 6) END")


def roll_sql(keys, fn, lag, win):
    return ROLL_SQL.format(k=", ".join(keys), a=lag + win - 1, b=lag, w=win, fn=fn)


def weekly_panel_p1(spark, sf_dir):
    facts = fx.p1(spark, sf_dir)
    cal = fx.weekly_calendar_known(spark, fx.Tables(spark, sf_dir).orders, "o_orderdate")
    return spine_fill(facts, cal, ["o_orderpriority"])


FLAGSHIP_SQL = f"""
WITH f AS ({fx.P1_SQL}),
{fx.weekly_calendar_sql('orders', 'o_orderdate')},
{fx.dense_sql('f', ['o_orderpriority'])}
SELECT o_orderpriority, date, is_holiday, is_offline, year, week_of_year, qty,
       round(release, 6) AS release,
       lag(qty, 4) OVER (PARTITION BY o_orderpriority ORDER BY date) AS qty_lag_4,
       {roll_sql(['o_orderpriority'], 'avg', 4, 4)} AS qty_roll_mean_lag_4_win_4
FROM dense"""


@query("weekly_spine_lag_roll", FLAGSHIP_SQL)
def weekly_spine_lag_roll(spark, sf_dir):
    """Flagship: orders -> weekly count -> dense spine -> lag 4 + rolling mean."""
    panel = weekly_panel_p1(spark, sf_dir)
    out = lag_features(panel, ["o_orderpriority"], "date", "qty", [4])
    out = rolling_features(out, ["o_orderpriority"], "date", "qty", [4], [4], stats=("mean",))
    return rounded(out)
