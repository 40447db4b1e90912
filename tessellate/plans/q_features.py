"""Queries: dense supplier panel (P2) features and price features (P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import week_bucket
from ..operators.panel import spine_fill
from ..operators.prices import price_features
from ..operators.windows import (ewm_features, lag_features, rolling_features,
                                 target_encoding)
from ..session import stored, tasks_of
from ..sources.tables import Tables
from . import fixtures as fx
from . import sqlgen as g
from .registry import query, rounded

K2 = ["l_suppkey", "l_returnflag"]


def dense_p2(spark, sf_dir, kept=None):
    facts = fx.p2(spark, sf_dir)
    cal = fx.weekly_calendar_known(spark, Tables(spark, sf_dir).lineitem, "l_shipdate")
    return spine_fill(facts, cal, K2, kept=kept)


DENSE_P2_CTE = f"""f AS ({fx.P2_SQL}),
{fx.weekly_calendar_sql('lineitem', 'l_shipdate')},
{fx.dense_sql('f', K2)}"""

DENSE_COLS = "l_suppkey, l_returnflag, date, is_holiday, is_offline, year, week_of_year"


@query("spine_fill", f"""
WITH {DENSE_P2_CTE}
SELECT {DENSE_COLS}, round(qty, 6) + 0.0 AS qty, round(release, 6) + 0.0 AS release FROM dense""")
def q_spine_fill(spark, sf_dir):
    return rounded(dense_p2(spark, sf_dir))


LAGS = [1, 4, 8, 52]


@query("lag_features", f"""
WITH {DENSE_P2_CTE}
SELECT l_suppkey, l_returnflag, date, round(qty, 6) + 0.0 AS qty,
       {', '.join(f'round({g.lag_sql(K2, "qty", l)}, 6) + 0.0 AS qty_lag_{l}' for l in LAGS)}
FROM dense""")
def q_lag_features(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return rounded(lag_features(d, K2, "date", "qty", LAGS))


RW, RL = [4, 8], [4, 8]


def _roll_query(stat):
    cols = ", ".join(g.roll_sql(K2, "qty", stat, l, w) for l in RL for w in RW)
    return f"""
WITH {DENSE_P2_CTE}
SELECT l_suppkey, l_returnflag, date, round(qty, 6) + 0.0 AS qty, {cols} FROM dense"""


@query("roll_mean", _roll_query("mean"))
def q_roll_mean(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return rounded(rolling_features(d, K2, "date", "qty", RW, RL, stats=("mean",)))


@query("roll_std", _roll_query("std"))
def q_roll_std(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return rounded(rolling_features(d, K2, "date", "qty", RW, RL, stats=("std",)))


ALPHAS, EL = [0.99, 0.5, 0.1], [4, 8]


def _ewm_sql(keys, alphas, lags, cte):
    lagged = ", ".join(
        f"round({g.lag_sql(keys, 'qty', l, src='e_' + g.alpha_tag(a))}, 4) + 0.0 "
        f"AS qty_ewm_lag_{l}_alpha_{g.alpha_tag(a)}" for l in lags for a in alphas)
    return f"""
WITH RECURSIVE {cte},
{g.ewm_recursive_sql(keys, alphas)}
SELECT {', '.join(keys)}, date, round(qty, 4) + 0.0 AS qty, {lagged} FROM eb"""


@query("ewm_features", _ewm_sql(K2, ALPHAS, EL, DENSE_P2_CTE))
def q_ewm_features(spark, sf_dir):
    d = stored(dense_p2(spark, sf_dir).select(*K2, "date", "qty"), "weekly")
    return rounded(ewm_features(d, K2, "date", "qty", ALPHAS, EL, tasks_of(spark, d.count())), 4)


ENC = [["l_suppkey"], ["l_returnflag"], ["l_suppkey", "l_returnflag"]]


def _enc_select(enc, digits=6):
    return ", ".join(f"round(e_{'_'.join(c)}.enc_{'_'.join(c)}_mean, {digits}) + 0.0 AS enc_{'_'.join(c)}_mean, "
                     f"round(e_{'_'.join(c)}.enc_{'_'.join(c)}_std, {digits}) + 0.0 AS enc_{'_'.join(c)}_std"
                     for c in enc)


@query("target_encode", f"""
WITH {DENSE_P2_CTE}
SELECT d.l_suppkey, d.l_returnflag, d.date, round(d.qty, 6) + 0.0 AS qty, {_enc_select(ENC)}
FROM dense d {' '.join(g.enc_sql('qty', c) for c in ENC)}""")
def q_target_encode(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return rounded(target_encoding(d, "qty", ENC))


def _asof_cols(cols):
    name = "_".join(cols)
    part = ", ".join(cols)
    frame = (f"OVER (PARTITION BY {part} ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING "
             f"AND INTERVAL 1 DAY PRECEDING)")
    return (f"round(CAST(sum(CAST(qty AS DECIMAL(38,10))) {frame} AS DOUBLE) / count(qty) {frame}, 4) + 0.0 AS enc_{name}_mean, "
            f"round(stddev_samp(qty) {frame}, 4) + 0.0 AS enc_{name}_std")


@query("target_encode_asof", f"""
WITH {DENSE_P2_CTE}
SELECT l_suppkey, l_returnflag, date, round(qty, 4) + 0.0 AS qty,
       {', '.join(_asof_cols(c) for c in ENC)}
FROM dense""")
def q_target_encode_asof(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return rounded(target_encoding(d, "qty", ENC, as_of="date", unique_keys=K2), 4)


# ---------------------------------------------------------------- prices (P4)
K4 = ["l_suppkey", "l_partkey"]


def weekly_prices(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    wk = week_bucket("l_shipdate")
    return (li.where(F.col("l_suppkey").isNotNull() & F.col("l_partkey").isNotNull())
            .groupBy(*K4, wk.alias("week"))
            .agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
            .select(*K4, "week", "price", F.month("week").alias("month"), F.year("week").alias("year")))


# exact money mean: decimal sum of the shortest decimal text, one division
MONEY_MEAN = "(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,8))) AS DOUBLE) / count({x}))"
MONEY_MEAN_W = ("(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,8))) OVER ({w}) AS DOUBLE) "
                "/ count({x}) OVER ({w}))")

P4_SQL = f"""
p4 AS (SELECT l_suppkey, l_partkey, week, price, CAST(month(week) AS INTEGER) AS month,
              CAST(year(week) AS INTEGER) AS year
       FROM (SELECT l_suppkey, l_partkey, {fx.week_sql('l_shipdate')} AS week,
                    max(l_extendedprice / l_quantity) AS price
             FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2, 3) t),
st AS (SELECT l_suppkey, l_partkey, max(price) AS price_max, min(price) AS price_min,
              stddev_samp(price) AS price_std, {MONEY_MEAN.format(x='price')} AS price_mean,
              count(DISTINCT price) AS price_nunique FROM p4 GROUP BY 1, 2),
nu_p AS (SELECT l_partkey, price, count(DISTINCT l_suppkey) AS price_nunique_l_partkey
         FROM p4 GROUP BY 1, 2),
nu_s AS (SELECT l_suppkey, price, count(DISTINCT l_partkey) AS price_nunique_l_suppkey
         FROM p4 GROUP BY 1, 2),
pf AS (SELECT p4.*, st.price_max, st.price_min, st.price_std, st.price_mean, st.price_nunique,
              p4.price / st.price_max AS price_norm,
              nu_p.price_nunique_l_partkey, nu_s.price_nunique_l_suppkey,
              p4.price / lag(p4.price) OVER (PARTITION BY p4.l_suppkey, p4.l_partkey ORDER BY week)
                AS price_momentum,
              p4.price / {MONEY_MEAN_W.format(x='p4.price', w='PARTITION BY p4.l_suppkey, p4.l_partkey, month')} AS price_momentum_m,
              p4.price / {MONEY_MEAN_W.format(x='p4.price', w='PARTITION BY p4.l_suppkey, p4.l_partkey, year')} AS price_momentum_y,
              p4.price % 1 AS price_cent, st.price_max % 1 AS price_max_cent, st.price_min % 1 AS price_min_cent
       FROM p4 JOIN st USING (l_suppkey, l_partkey)
       JOIN nu_p ON nu_p.l_partkey = p4.l_partkey AND nu_p.price = p4.price
       JOIN nu_s ON nu_s.l_suppkey = p4.l_suppkey AND nu_s.price = p4.price)"""


def _r(cols):
    return ", ".join(f"round({c}, 4) + 0.0 AS {c}" for c in cols)


def _price_df(spark, sf_dir):
    return price_features(weekly_prices(spark, sf_dir), K4, "price", "week")


@query("price_momentum", f"""
WITH {P4_SQL}
SELECT l_suppkey, l_partkey, week, {_r(['price', 'price_momentum', 'price_momentum_m', 'price_momentum_y'])}
FROM pf""")
def q_price_momentum(spark, sf_dir):
    return rounded(_price_df(spark, sf_dir).select(
        *K4, "week", "price", "price_momentum", "price_momentum_m", "price_momentum_y"), 4)


@query("price_nunique", f"""
WITH {P4_SQL}
SELECT l_suppkey, l_partkey, week, {_r(['price'])}, price_nunique_l_partkey, price_nunique_l_suppkey FROM pf""")
def q_price_nunique(spark, sf_dir):
    return rounded(_price_df(spark, sf_dir).select(
        *K4, "week", "price", "price_nunique_l_partkey", "price_nunique_l_suppkey"), 4)


@query("price_norm", f"""
WITH {P4_SQL}
SELECT l_suppkey, l_partkey, week, {_r(['price', 'price_norm'])} FROM pf""")
def q_price_norm(spark, sf_dir):
    return rounded(_price_df(spark, sf_dir).select(*K4, "week", "price", "price_norm"), 4)


PRICE_ALL = ["price", "price_max", "price_min", "price_std", "price_mean", "price_norm", "price_momentum",
             "price_momentum_m", "price_momentum_y", "price_cent", "price_max_cent", "price_min_cent"]


@query("price_features", f"""
WITH {P4_SQL}
SELECT l_suppkey, l_partkey, week, month, year, {_r(PRICE_ALL)}, price_nunique,
       price_nunique_l_partkey, price_nunique_l_suppkey FROM pf""")
def q_price_features(spark, sf_dir):
    return rounded(_price_df(spark, sf_dir), 4)


# ------------------------------------------------------- whole feature matrix
FM_LAGS = [4, 5, 6, 26, 52]
FM_RW, FM_RL = [4, 8], [4, 8]
FM_ALPHAS, FM_EL = [0.9, 0.5], [4]
FM_ENC = [["l_suppkey"], ["l_suppkey", "l_returnflag"]]


def feature_matrix(spark, sf_dir):
    """Composition W1-W5 on the dense weekly panel, written once by key: encodings while
    rows are narrow, then the two EWM columns through Arrow, then the windows."""
    d = target_encoding(dense_p2(spark, sf_dir, "weekly"), "qty", FM_ENC, laid_by=K2)
    d = ewm_features(d, K2, "date", "qty", FM_ALPHAS, FM_EL)
    d = lag_features(d, K2, "date", "qty", FM_LAGS)
    return rolling_features(d, K2, "date", "qty", FM_RW, FM_RL)


def _fm_sql():
    ewm_l = ", ".join(f"round({g.lag_sql(K2, 'qty', l, src='e_' + g.alpha_tag(a))}, 4) + 0.0 "
                      f"AS qty_ewm_lag_{l}_alpha_{g.alpha_tag(a)}" for l in FM_EL for a in FM_ALPHAS)
    lags = ", ".join(f"round({g.lag_sql(K2, 'qty', l)}, 4) + 0.0 AS qty_lag_{l}" for l in FM_LAGS)
    rolls = ", ".join(g.roll_sql(K2, "qty", s, l, w, 4) for l in FM_RL for w in FM_RW for s in ("mean", "std"))
    extra = ", is_holiday, is_offline, year, week_of_year, release"
    return f"""
WITH RECURSIVE {DENSE_P2_CTE},
{g.ewm_recursive_sql(K2, FM_ALPHAS, extra=extra)},
w AS (SELECT {DENSE_COLS}, round(qty, 4) + 0.0 AS qty, round(release, 4) + 0.0 AS release,
             {ewm_l}, {lags}, {rolls} FROM eb)
SELECT d.*, {_enc_select(FM_ENC, 4)}
FROM w d {' '.join(g.enc_sql('qty', c, src='dense') for c in FM_ENC)}"""


@query("feature_matrix", _fm_sql())
def q_feature_matrix(spark, sf_dir):
    return rounded(feature_matrix(spark, sf_dir), 4)


# ---------------------------------------------- reference-sized weekly grid
# Lags, windows and decay rates of the weekly feature grid.
GRID_COMMON_LAGS = [26, 39, 52, 78, 104]
GRID_LAGS = list(range(4, 25))
GRID_ROLL_LAGS = [4, 8, 12, 16, 20, 26, 39, 52]
GRID_ROLL_WINDOWS = [4, 8, 12, 16, 26, 39, 52]
GRID_EWM_LAGS = [4, 8, 12, 16, 20, 26, 39, 52]
GRID_EWM_ALPHAS = [0.99, 0.95, 0.9, 0.8, 0.5, 0.2, 0.1]
GRID_ENC = [["l_suppkey"], ["l_returnflag"], ["l_suppkey", "l_returnflag"]]


def feature_grid(spark, sf_dir):
    """Full weekly grid (26 lags, 112 rolling, 56 EWM, 6 encodings) on P2.

    Order matters for ~200 columns: encodings are joined while rows are
    narrow (beyond 100 fields whole-stage codegen is off and every join
    copies wide rows), the EWM gathers only the narrow panel, and the JVM windows
    come last. The facts are shuffled to their keys once: the dense panel is
    written in buckets of the keys, where all that follows meets its rows.
    """
    d = target_encoding(dense_p2(spark, sf_dir, "weekly"), "qty", GRID_ENC, laid_by=K2)
    d = ewm_features(d, K2, "date", "qty", GRID_EWM_ALPHAS, GRID_EWM_LAGS)
    d = lag_features(d, K2, "date", "qty", GRID_LAGS + GRID_COMMON_LAGS)
    return rolling_features(d, K2, "date", "qty", GRID_ROLL_WINDOWS, GRID_ROLL_LAGS)


def _grid_sql():
    lags = ", ".join(f"round({g.lag_sql(K2, 'qty', l)}, 4) + 0.0 AS qty_lag_{l}"
                     for l in GRID_LAGS + GRID_COMMON_LAGS)
    rolls = ", ".join(g.roll_sql(K2, "qty", s, l, w, 4) for l in GRID_ROLL_LAGS for w in GRID_ROLL_WINDOWS
                      for s in ("mean", "std"))
    ewm_l = ", ".join(f"round({g.lag_sql(K2, 'qty', l, src='e_' + g.alpha_tag(a))}, 4) + 0.0 "
                      f"AS qty_ewm_lag_{l}_alpha_{g.alpha_tag(a)}" for l in GRID_EWM_LAGS for a in GRID_EWM_ALPHAS)
    extra = ", is_holiday, is_offline, year, week_of_year, release"
    return f"""
WITH RECURSIVE {DENSE_P2_CTE},
{g.ewm_recursive_sql(K2, GRID_EWM_ALPHAS, extra=extra)},
w AS (SELECT {DENSE_COLS}, round(qty, 4) + 0.0 AS qty, round(release, 4) + 0.0 AS release,
             {lags}, {rolls}, {ewm_l} FROM eb)
SELECT d.*, {_enc_select(GRID_ENC, 4)}
FROM w d {' '.join(g.enc_sql('qty', c, src='dense') for c in GRID_ENC)}"""


@query("feature_grid", _grid_sql())
def q_feature_grid(spark, sf_dir):
    return rounded(feature_grid(spark, sf_dir), 4)


# --------------------------------------------------------- daily panel (P3)
K3 = ["user_id", "event_type"]
DAILY_LAGS = [1, 7, 14]
DAILY_RW, DAILY_RL = [7, 14], [1, 7]


def daily_panel(spark, sf_dir):
    """Daily value per (user, event type), gap-free from first positive day
    to the last day of the data, with calendar parts and moon phase."""
    from ..functions.calendar import date_parts, moon_phase
    from ..operators.panel import densify
    facts = fx.p3(spark, sf_dir)
    d = densify(facts, K3, "date", "qty", end=facts.agg(F.max("date")).scalar(), step_days=1)
    return d.select(*K3, "date", "qty", (F.col("release") * 7).cast("int").alias("age_days"),
                    *date_parts("date"), moon_phase("date").alias("moon"))


DAILY_SQL = f"""
f AS ({fx.P3_SQL}),
rel AS (SELECT user_id, event_type, min(date) AS rel FROM f WHERE qty > 0 GROUP BY 1, 2),
endd AS (SELECT max(date) AS e FROM f),
grid AS (SELECT r.user_id, r.event_type, r.rel,
                CAST(unnest(range(CAST(r.rel AS TIMESTAMP), CAST(endd.e AS TIMESTAMP) + INTERVAL 1 DAY,
                                  INTERVAL 1 DAY)) AS DATE) AS date FROM rel r, endd),
dd AS (SELECT g.user_id, g.event_type, g.date, coalesce(f.qty, 0) AS qty,
              CAST(g.date - g.rel AS INTEGER) AS age_days
       FROM grid g LEFT JOIN f ON f.user_id = g.user_id AND f.event_type = g.event_type AND f.date = g.date)"""


@query("daily_features", f"""
WITH {DAILY_SQL}
SELECT user_id, event_type, date, round(qty, 6) + 0.0 AS qty, age_days,
       CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
       CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
       CAST(isodow(date) >= 6 AS INTEGER) AS is_wknd, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
       CAST(date = last_day(date) AS INTEGER) AS is_month_end,
       CAST(floor(((0.20439731 + datediff('microsecond', TIMESTAMP '2001-01-01 00:00:00', CAST(date AS TIMESTAMP))
         / 86400e6 * 0.03386319269) - floor(0.20439731 + datediff('microsecond', TIMESTAMP '2001-01-01 00:00:00',
         CAST(date AS TIMESTAMP)) / 86400e6 * 0.03386319269)) * 8 + 0.5) AS INTEGER) & 7 AS moon,
       {', '.join(f"round({g.lag_sql(K3, 'qty', l)}, 6) + 0.0 AS qty_lag_{l}" for l in DAILY_LAGS)},
       {', '.join(g.roll_sql(K3, 'qty', s, l, w) for l in DAILY_RL for w in DAILY_RW for s in ('mean', 'std'))}
FROM dd""")
def q_daily_features(spark, sf_dir):
    d = daily_panel(spark, sf_dir)
    d = lag_features(d, K3, "date", "qty", DAILY_LAGS)
    d = rolling_features(d, K3, "date", "qty", DAILY_RW, DAILY_RL)
    return rounded(d)


# ------------------------------------------------- reference-sized daily grid
# Lags, windows and decay rates of the daily feature grid.
DAY_LAGS = [*range(7, 57), 60, 90, 182, 364]
DAY_ROLL_LAGS = [7, 14, 21, 28, 35, 42, 49, 56, 60, 90, 182, 364]
DAY_ROLL_WINDOWS = [7, 14, 21, 28, 60, 90, 182, 364]
DAY_EWM_LAGS = DAY_ROLL_LAGS
DAY_EWM_ALPHAS = [0.99, 0.95, 0.9, 0.8, 0.5, 0.2, 0.1]
DAY_ENC = [["user_group"], ["event_type"], ["user_id"], ["user_group", "event_type"], ["user_group", "user_id"],
           ["user_id", "event_type"]]


def daily_feature_grid(spark, sf_dir):
    """Full daily grid (54 lags, 192 rolling, 84 EWM, 12 encodings) on the gap-free daily
    panel, written once: encodings first, while rows are narrow, then seven EWM
    columns through Arrow, then all windows on one key partitioning."""
    from ..operators.panel import densify
    facts = fx.p3(spark, sf_dir)
    dense = densify(facts, K3, "date", "qty", end=facts.agg(F.max("date")).scalar(), step_days=1)
    dense = stored(dense.select(*K3, (F.col("user_id") % 10).alias("user_group"), "date", "qty"), "daily")
    d = target_encoding(dense, "qty", DAY_ENC)
    d = ewm_features(d, K3, "date", "qty", DAY_EWM_ALPHAS, DAY_EWM_LAGS, tasks_of(spark, dense.count()))
    d = lag_features(d, K3, "date", "qty", DAY_LAGS)
    return rolling_features(d, K3, "date", "qty", DAY_ROLL_WINDOWS, DAY_ROLL_LAGS)


def _day_grid_sql():
    lags = ", ".join(f"round({g.lag_sql(K3, 'qty', l)}, 4) + 0.0 AS qty_lag_{l}" for l in DAY_LAGS)
    rolls = ", ".join(g.roll_sql(K3, "qty", s, l, w, 4) for l in DAY_ROLL_LAGS for w in DAY_ROLL_WINDOWS for s in ("mean", "std"))
    ewm_l = ", ".join(f"round({g.lag_sql(K3, 'qty', l, src='e_' + g.alpha_tag(a))}, 4) + 0.0 "
                      f"AS qty_ewm_lag_{l}_alpha_{g.alpha_tag(a)}" for l in DAY_EWM_LAGS for a in DAY_EWM_ALPHAS)
    return f"""
WITH RECURSIVE {DAILY_SQL},
dense AS (SELECT *, user_id % 10 AS user_group FROM dd),
{g.ewm_recursive_sql(K3, DAY_EWM_ALPHAS, extra=", user_group")},
w AS (SELECT user_id, event_type, user_group, date, round(qty, 4) + 0.0 AS qty, {lags}, {rolls}, {ewm_l} FROM eb)
SELECT d.*, {_enc_select(DAY_ENC, 4)}
FROM w d {' '.join(g.enc_sql('qty', c, src='dense') for c in DAY_ENC)}"""


@query("daily_feature_grid", _day_grid_sql())
def q_daily_feature_grid(spark, sf_dir):
    return rounded(daily_feature_grid(spark, sf_dir), 4)
