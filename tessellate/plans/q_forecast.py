"""Queries: horizon stages, grouped forecasts, evaluation and CV (M1-M14, A9, A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs
from ..operators.forecast import (fit_ols, gbt_model, predict_linear, predict_stages, residual_stack,
                                  stage_coefficients, standard_scale, with_overrides)
from ..operators.glm import tweedie_glm
from ..operators.reshape import union_by_name
from ..operators.split import day_split, horizon_split, stages, ts_split
from ..operators.windows import ewm_features, lag_features, rolling_features
from ..session import scratch_path, stored, tasks_of
from ..sources.tables import Tables
from . import fixtures as fx
from . import sqlgen as g
from .q_features import DENSE_P2_CTE, K2, dense_p2
from .registry import fast_round, query, rounded

PART = "l_returnflag"
HORIZON, STEP = 12, 4
FLAGS = [4, 8, 12]


def base(spark, sf_dir, lags=FLAGS):
    """The dense panel with lags, written once, and its horizon stages: a forecast reads it
    for training, scoring and residuals."""
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty", "release")
    d = stored(lag_features(d, K2, "date", "qty", lags), "lagged")
    return horizon_split(d, [PART], "date", HORIZON, STEP)


def base_sql(lags=FLAGS) -> str:
    return f"""{DENSE_P2_CTE},
b AS (SELECT l_suppkey, l_returnflag, date, qty, release,
             {', '.join(f'{g.lag_sql(K2, "qty", l)} AS qty_lag_{l}' for l in lags)} FROM dense),
mx AS (SELECT l_returnflag, max(date) AS mx FROM b GROUP BY 1),
sp AS (SELECT b.*, mx.mx - {7 * HORIZON} AS cutoff,
              CASE WHEN b.date <= mx.mx - {7 * HORIZON} THEN 'train'
                   WHEN (b.date - (mx.mx - {7 * HORIZON})) / 7.0 > 0
                    AND (b.date - (mx.mx - {7 * HORIZON})) / 7.0 <= {HORIZON} THEN 'test' END AS role,
              CASE WHEN (b.date - (mx.mx - {7 * HORIZON})) / 7.0 > 0
                    AND (b.date - (mx.mx - {7 * HORIZON})) / 7.0 <= {HORIZON}
                   THEN CAST(ceil((b.date - (mx.mx - {7 * HORIZON})) / 7.0 / {STEP}) AS INTEGER) END AS stage
       FROM b JOIN mx USING (l_returnflag))"""


BASE_SQL = base_sql()


@query("horizon_split", f"""
WITH {BASE_SQL}
SELECT l_suppkey, l_returnflag, date, cutoff, role, stage FROM sp""")
def q_horizon_split(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date")
    return horizon_split(d, [PART], "date", HORIZON, STEP).select(*K2, "date", "cutoff", "role", "stage")


# ------------------------------------------------------------ stage features
# Lags of half a year to two years, known at every stage.
SEASONAL_LAGS = (26, 39, 52, 78, 104)
STAGE2_LAGS = stages(HORIZON, STEP, seasonal=SEASONAL_LAGS)[1].lags
STAGE2 = [f"qty_lag_{lag}" for lag in STAGE2_LAGS]


@query("stage_features", f"""
WITH f AS ({fx.P1_SQL}),
{fx.weekly_calendar_sql('orders', 'o_orderdate')},
{fx.dense_sql('f', ['o_orderpriority'])}
SELECT o_orderpriority, date,
       {', '.join(f"{g.lag_sql(['o_orderpriority'], 'qty', l)} AS qty_lag_{l}" for l in STAGE2_LAGS)}
FROM dense""")
def q_stage_features(spark, sf_dir):
    from .q_panel import weekly_panel_p1
    p = weekly_panel_p1(spark, sf_dir)
    out = lag_features(p, ["o_orderpriority"], "date", "qty", STAGE2_LAGS)
    return out.select("o_orderpriority", "date", *STAGE2)


# -------------------------------------------------------- grouped regression
def stage_x():
    return F.when(F.col("stage") == 1, F.col("qty_lag_4")).when(F.col("stage") == 2, F.col("qty_lag_8")) \
            .otherwise(F.col("qty_lag_12"))


def ols_forecast(b):
    """Per partition and stage: qty ~ a + b * qty_lag_{4*stage}, fitted on the
    training rows by regression aggregates (one pass, all stages at once)."""
    train = b.where(F.col("role") == "train")
    coefs = stored(train.groupBy(PART).agg(
        *[F.regr_slope("qty", f"qty_lag_{l}").alias(f"slope_{l}") for l in FLAGS],
        *[F.regr_intercept("qty", f"qty_lag_{l}").alias(f"icpt_{l}") for l in FLAGS]), "coefs")
    test = b.where(F.col("role") == "test").join(coefs, PART, "left")
    slope = F.when(F.col("stage") == 1, F.col("slope_4")).when(F.col("stage") == 2, F.col("slope_8")) \
             .otherwise(F.col("slope_12"))
    icpt = F.when(F.col("stage") == 1, F.col("icpt_4")).when(F.col("stage") == 2, F.col("icpt_8")) \
            .otherwise(F.col("icpt_12"))
    return test.select(*K2, "date", "stage", "qty", (icpt + slope * stage_x()).alias("qty_hat"),
                       F.col(PART).alias("partition_key"))


OLS_SQL = f"""{BASE_SQL},
co AS (SELECT l_returnflag,
              {', '.join(f'regr_slope(qty, qty_lag_{l}) AS slope_{l}, regr_intercept(qty, qty_lag_{l}) AS icpt_{l}' for l in FLAGS)}
       FROM sp WHERE role = 'train' GROUP BY 1),
fc AS (SELECT sp.l_suppkey, sp.l_returnflag, sp.date, sp.stage, sp.qty,
              CASE sp.stage WHEN 1 THEN icpt_4 + slope_4 * qty_lag_4 WHEN 2 THEN icpt_8 + slope_8 * qty_lag_8
                            ELSE icpt_12 + slope_12 * qty_lag_12 END AS qty_hat,
              sp.l_returnflag AS partition_key
       FROM sp LEFT JOIN co USING (l_returnflag) WHERE role = 'test')"""


@query("grouped_ols_forecast", f"""
WITH {OLS_SQL}
SELECT l_suppkey, l_returnflag, date, stage, round(qty, 4) + 0.0 AS qty, round(qty_hat, 4) + 0.0 AS qty_hat,
       partition_key FROM fc""")
def q_grouped_ols_forecast(spark, sf_dir):
    return rounded(ols_forecast(base(spark, sf_dir)), 4)


@query("forecast_totals", f"""
WITH {OLS_SQL}
SELECT round(sqrt(avg(pow(qty - qty_hat, 2))), 4) + 0.0 AS rmse, round(sum(qty), 4) + 0.0 AS sum_actual,
       round(sum(qty_hat), 4) + 0.0 AS sum_predicted, count(*) AS n FROM fc""")
def q_forecast_totals(spark, sf_dir):
    return rounded(aggs.forecast_totals(ols_forecast(base(spark, sf_dir)), "qty", "qty_hat"), 4)


@query("rmse_by_group", f"""
WITH {OLS_SQL}
SELECT l_suppkey, round(sqrt(avg(pow(qty - qty_hat, 2))), 4) + 0.0 AS rmse, count(*) AS n FROM fc GROUP BY 1""")
def q_rmse_by_group(spark, sf_dir):
    return rounded(aggs.rmse_by_group(ols_forecast(base(spark, sf_dir)), ["l_suppkey"], "qty", "qty_hat"), 4)


@query("residual_stack", f"""
WITH {OLS_SQL},
tr AS (SELECT sp.l_returnflag, sp.l_suppkey, sp.qty - (co.icpt_4 + co.slope_4 * sp.qty_lag_4) AS r
       FROM sp JOIN co USING (l_returnflag) WHERE role = 'train' AND sp.qty_lag_4 IS NOT NULL),
res AS (SELECT l_returnflag, l_suppkey, avg(r) AS res FROM tr GROUP BY 1, 2)
SELECT fc.l_suppkey, fc.l_returnflag, fc.date, fc.stage,
       round(CASE WHEN qty_hat + coalesce(res, 0) < 0 THEN 0.0 ELSE qty_hat + coalesce(res, 0) END, 4) + 0.0 AS stacked
FROM fc LEFT JOIN res USING (l_returnflag, l_suppkey)""")
def q_residual_stack(spark, sf_dir):
    b = base(spark, sf_dir)
    train = b.where(F.col("role") == "train")
    co = stored(train.groupBy(PART).agg(F.regr_slope("qty", "qty_lag_4").alias("s"),
                                        F.regr_intercept("qty", "qty_lag_4").alias("i")), "coefs")
    train_pred = train.join(co, PART).select(*K2, "qty", (F.col("i") + F.col("s") * F.col("qty_lag_4"))
                                             .alias("prediction"))
    fc = ols_forecast(b).withColumnRenamed("qty_hat", "prediction")
    out = residual_stack(train_pred, fc, [PART], K2, "qty", "prediction", "stacked")
    return rounded(out.select(*K2, "date", "stage", "stacked"), 4)


@query("standard_scale", f"""
WITH {DENSE_P2_CTE}
SELECT l_suppkey, l_returnflag, date,
       round((qty - avg(qty) OVER ()) / stddev_pop(qty) OVER (), 4) + 0.0 AS qty_scaled,
       round((release - avg(release) OVER ()) / stddev_pop(release) OVER (), 4) + 0.0 AS release_scaled
FROM dense""")
def q_standard_scale(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty", "release")
    return rounded(standard_scale(d, ["qty", "release"]).select(*K2, "date", "qty_scaled", "release_scaled"), 4)


# Default model parameters and per-partition overrides.
DEFAULTS = {"tweedie_variance_power": 1.1, "learning_rate": 0.05}
OVERRIDES = [("R", 1.4, 0.01), ("A", None, 0.15)]


@query("param_override", f"""
WITH {DENSE_P2_CTE}
SELECT DISTINCT d.l_returnflag, d.l_suppkey,
       coalesce(o.p, {DEFAULTS['tweedie_variance_power']}::DOUBLE) AS tweedie_variance_power,
       coalesce(o.lr, {DEFAULTS['learning_rate']}::DOUBLE) AS learning_rate
FROM dense d LEFT JOIN (VALUES ('R', 1.4::DOUBLE, 0.01::DOUBLE), ('A', NULL, 0.15::DOUBLE)) o(k, p, lr)
  ON d.l_returnflag = o.k""")
def q_param_override(spark, sf_dir):
    keys = dense_p2(spark, sf_dir).select(*K2).distinct()
    ov = spark.createDataFrame(OVERRIDES, "l_returnflag string, tweedie_variance_power double, learning_rate double")
    return with_overrides(keys, ov, PART, DEFAULTS)


@query("append_history", f"""
WITH {OLS_SQL}
SELECT l_suppkey, l_returnflag, date, CAST(qty AS FLOAT) AS qty, CAST(round(qty_hat, 2) AS FLOAT) AS qty_hat,
       partition_key, stage FROM fc
UNION ALL
SELECT l_suppkey, l_returnflag, date, CAST(qty AS FLOAT) AS qty, NULL AS qty_hat, l_returnflag AS partition_key,
       NULL AS stage FROM sp WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""")
def q_append_history(spark, sf_dir):
    b = base(spark, sf_dir)
    fc = ols_forecast(b)
    fc = fc.select(*K2, "date", F.col("qty").cast("float").alias("qty"),
                   fast_round("qty_hat", 2).cast("float").alias("qty_hat"), "partition_key", "stage")
    hist = b.where(F.col("date").between("2000-01-01", "2000-12-31")) \
        .select(*K2, "date", F.col("qty").cast("float").alias("qty"), F.col(PART).alias("partition_key"))
    return fc.unionByName(hist, allowMissingColumns=True)


# ------------------------------------------------------------ CV and search
SPLITS = 5
TS_ORDER = ["date", "l_suppkey", "l_returnflag"]
TS_SQL = f"""{DENSE_P2_CTE},
ps AS (SELECT l_suppkey, l_returnflag, date, qty,
              row_number() OVER (ORDER BY date, l_suppkey, l_returnflag) - 1 AS pos,
              count(*) OVER () AS n FROM dense),
ts AS (SELECT *, CAST(CASE WHEN pos >= n - (n // {SPLITS + 1}) * {SPLITS}
                           THEN floor((pos - (n - (n // {SPLITS + 1}) * {SPLITS})) / (n // {SPLITS + 1}))
                           ELSE -1 END AS INTEGER) AS test_fold FROM ps)"""


@query("ts_split", f"""
WITH {TS_SQL}
SELECT l_suppkey, l_returnflag, date, pos, test_fold FROM ts""")
def q_ts_split(spark, sf_dir):
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    return ts_split(d, TS_ORDER, SPLITS).select(*K2, "date", "pos", "test_fold")


@query("cv_baseline_rmse", f"""
WITH {TS_SQL},
folds AS (SELECT DISTINCT test_fold AS fold FROM ts WHERE test_fold >= 0),
tr AS (SELECT f.fold, count(*) AS n_train, avg(t.qty) AS train_mean
       FROM folds f JOIN ts t ON t.test_fold < f.fold GROUP BY 1),
te AS (SELECT t.test_fold AS fold, tr.n_train, count(*) AS n_test, tr.train_mean,
              sqrt(avg(pow(t.qty - tr.train_mean, 2))) AS rmse
       FROM ts t JOIN tr ON t.test_fold = tr.fold GROUP BY 1, 2, 4)
SELECT fold, n_train, n_test, round(train_mean, 4) + 0.0 AS train_mean, round(rmse, 4) + 0.0 AS rmse FROM te""")
def q_cv_baseline_rmse(spark, sf_dir):
    """Predict the training mean; per fold RMSE. Training sums per fold come
    from per-block sums accumulated over the (few) blocks, so no row is
    copied into every fold."""
    from pyspark.sql import Window
    d = dense_p2(spark, sf_dir).select(*K2, "date", "qty")
    t = ts_split(d, TS_ORDER, SPLITS)
    blocks = t.groupBy("test_fold").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("s"))
    w = Window.orderBy("test_fold").rowsBetween(Window.unboundedPreceding, -1)
    folds = (blocks.select("test_fold", F.sum("n").over(w).alias("n_train"), F.sum("s").over(w).alias("s_train"))
             .where(F.col("test_fold") >= 0)
             .select(F.col("test_fold").alias("fold"), "n_train", (F.col("s_train") / F.col("n_train")).alias("train_mean")))
    te = t.join(F.broadcast(folds), t["test_fold"] == folds["fold"])  # folds: n_splits rows
    out = te.groupBy("fold", "n_train", "train_mean").agg(
        F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(F.pow(F.col("qty") - F.col("train_mean"), 2))).alias("rmse"))
    return rounded(out.select("fold", "n_train", "n_test", "train_mean", "rmse"), 4)


LB_SQL_MODELS = [("naive", "qty_lag_1"), ("seasonal_naive", "qty_lag_52"), ("moving_avg_4", "ma4"), ("ewm_05", "e_05")]


@query("baseline_leaderboard", f"""
WITH RECURSIVE {DENSE_P2_CTE},
{g.ewm_recursive_sql(K2, [0.5])},
mx AS (SELECT l_returnflag, max(date) AS mx FROM dense GROUP BY 1),
p AS (SELECT eb.l_suppkey, eb.l_returnflag, eb.date, eb.qty,
             {g.lag_sql(K2, 'qty', 1)} AS qty_lag_1, {g.lag_sql(K2, 'qty', 52)} AS qty_lag_52,
             CASE WHEN count(qty) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY date
                                        ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) = 4
                  THEN avg(qty) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY date
                                      ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) END AS ma4,
             {g.lag_sql(K2, 'qty', 1, src='e_05')} AS e_05, mx.mx
      FROM eb JOIN mx USING (l_returnflag)),
t AS (SELECT * FROM p WHERE date > mx - {7 * HORIZON})
{' UNION ALL '.join(f"SELECT '{m}' AS model, round(sqrt(avg(pow(qty - {c}, 2))), 4) + 0.0 AS rmse, count({c}) AS n FROM t WHERE {c} IS NOT NULL" for m, c in LB_SQL_MODELS)}""")
def q_baseline_leaderboard(spark, sf_dir):
    dense = stored(dense_p2(spark, sf_dir).select(*K2, "date", "qty"), "weekly")
    d = horizon_split(dense, [PART], "date", HORIZON, STEP).select(*dense.columns, "role")
    d = ewm_features(d, K2, "date", "qty", [0.5], [1], tasks_of(spark, dense.count()))
    d = lag_features(d, K2, "date", "qty", [1, 52])
    d = rolling_features(d, K2, "date", "qty", [4], [1], stats=("mean",)).where(F.col("role") == "test")
    models = {"naive": "qty_lag_1", "seasonal_naive": "qty_lag_52",
              "moving_avg_4": "qty_roll_mean_lag_1_win_4", "ewm_05": "qty_ewm_lag_1_alpha_05"}
    long = d.select("qty", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("pred"))
                                               for m, c in models.items()])))
    out = (long.where(F.col("pred").isNotNull()).groupBy("model")
           .agg(F.sqrt(F.avg(F.pow(F.col("qty") - F.col("pred"), 2))).alias("rmse"),
                F.count("pred").alias("n")))
    return rounded(out, 4)


GRID = [0.99, 0.95, 0.9, 0.8, 0.5, 0.2, 0.1]


@query("grid_ewm_alpha", f"""
WITH RECURSIVE {DENSE_P2_CTE},
{g.ewm_recursive_sql(K2, GRID)},
mx AS (SELECT l_returnflag, max(date) AS mx FROM dense GROUP BY 1),
p AS (SELECT eb.*, {', '.join(f"{g.lag_sql(K2, 'qty', 1, src='e_' + g.alpha_tag(a))} AS p_{g.alpha_tag(a)}" for a in GRID)}, mx.mx
      FROM eb JOIN mx USING (l_returnflag)),
t AS (SELECT * FROM p WHERE date > mx - {7 * HORIZON}),
r AS ({' UNION ALL '.join(f"SELECT l_suppkey, l_returnflag, {a}::DOUBLE AS alpha, sqrt(avg(pow(qty - p_{g.alpha_tag(a)}, 2))) AS rmse FROM t WHERE p_{g.alpha_tag(a)} IS NOT NULL GROUP BY 1, 2" for a in GRID)})
SELECT l_suppkey, l_returnflag, arg_min(alpha, (rmse, alpha)) AS best_alpha, round(min(rmse), 4) + 0.0 AS best_rmse
FROM r GROUP BY 1, 2""")
def q_grid_ewm_alpha(spark, sf_dir):
    """Grid search of the EWM smoothing factor per series by holdout RMSE."""
    dense = stored(dense_p2(spark, sf_dir).select(*K2, "date", "qty"), "weekly")
    d = horizon_split(dense, [PART], "date", HORIZON, STEP).select(*dense.columns, "role")
    d = ewm_features(d, K2, "date", "qty", GRID, [1], tasks_of(spark, dense.count())).where(F.col("role") == "test")
    long = d.select(*K2, "qty", F.inline(F.array(*[
        F.struct(F.lit(a).alias("alpha"), F.col(f"qty_ewm_lag_1_alpha_{g.alpha_tag(a)}").alias("pred")) for a in GRID])))
    scores = (long.where(F.col("pred").isNotNull()).groupBy(*K2, "alpha")
              .agg(F.sqrt(F.avg(F.pow(F.col("qty") - F.col("pred"), 2))).alias("rmse")))
    best = scores.groupBy(*K2).agg(F.min_by("alpha", F.struct("rmse", "alpha")).alias("best_alpha"),
                                   F.min("rmse").alias("best_rmse"))
    return rounded(best.select(*K2, "best_alpha", fast_round("best_rmse", 4).alias("best_rmse")), 4)


@query("day_split", """
SELECT l_orderkey, l_linenumber, d,
       CASE WHEN d >= 0 AND d <= 1885 THEN 'train' WHEN d > 1885 AND d <= 1913 THEN 'test' END AS role
FROM (SELECT l_orderkey, l_linenumber, CAST(datediff('day', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem),
             CAST(l_shipdate AS DATE)) AS INTEGER) AS d FROM lineitem) t""")
def q_day_split(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    first = li.agg(F.min(F.to_date("l_shipdate"))).scalar()
    d = li.select("l_orderkey", "l_linenumber", F.datediff(F.to_date("l_shipdate"), first).alias("d"))
    return day_split(d, "d", 1885, 1913)


@query("coef_table", f"""
WITH {BASE_SQL}
SELECT l_returnflag, 'intercept' AS term, round(regr_intercept(qty, qty_lag_4), 4) + 0.0 AS coef
FROM sp WHERE role = 'train' GROUP BY 1
UNION ALL
SELECT l_returnflag, 'qty_lag_4', round(regr_slope(qty, qty_lag_4), 4) + 0.0 FROM sp WHERE role = 'train' GROUP BY 1""")
def q_coef_table(spark, sf_dir):
    """Fit, persist the coefficient table partitioned by partition key, read back."""
    b = base(spark, sf_dir).where(F.col("role") == "train")
    coefs = fit_ols(b, [PART], ["qty_lag_4"], "qty")
    path = scratch_path(spark, "coefs")
    coefs.write.mode("overwrite").partitionBy(PART).parquet(path)
    back = spark.read.parquet(path).select(PART, "term", "coef")
    return rounded(back, 4)


def two_sums_sql(src: str, x1: str, x2: str, lam: str, name: str, group=PART) -> str:
    """CTE of the normal equations of qty ~ 1 + x1 + x2 by group, solved by Cramer's rule."""
    return f"""
{name}_s AS (SELECT {group}, count(*) AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg(qty) AS my, {lam} AS lam,
                    var_pop({x1}) * count(*) AS s11, var_pop({x2}) * count(*) AS s22, covar_pop({x1}, {x2}) * count(*) AS s12,
                    covar_pop({x1}, qty) * count(*) AS s1y, covar_pop({x2}, qty) * count(*) AS s2y,
                    stddev_pop({x1}) AS d1, stddev_pop({x2}) AS d2
             FROM {src} WHERE role = 'train' AND {x1} IS NOT NULL AND {x2} IS NOT NULL AND qty IS NOT NULL GROUP BY {group}),
{name}_b AS (SELECT *, (s1y * (s22 + lam) - s2y * s12) / ((s11 + lam) * (s22 + lam) - s12 * s12) AS b1,
                    (s2y * (s11 + lam) - s1y * s12) / ((s11 + lam) * (s22 + lam) - s12 * s12) AS b2 FROM {name}_s),
{name} AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM {name}_b)"""


@query("grouped_model_forecast", f"""
WITH {BASE_SQL},{two_sums_sql("sp", "qty_lag_12", "release", "1e-6::DOUBLE", "co")}
SELECT l_suppkey, sp.l_returnflag, date, stage, round(qty, 3) + 0.0 AS qty,
       round(b0 + b1 * qty_lag_12 + b2 * release, 3) + 0.0 AS qty_hat
FROM sp LEFT JOIN co ON sp.l_returnflag = co.l_returnflag WHERE role = 'test'""")
def q_grouped_model_forecast(spark, sf_dir):
    """Multi-feature least squares per partition from aggregated cross-products."""
    b = base(spark, sf_dir)
    feats = ["qty_lag_12", "release"]
    coefs = fit_ols(b.where(F.col("role") == "train"), [PART], feats, "qty", ridge=1e-6)
    out = predict_linear(b.where(F.col("role") == "test"), coefs, [PART], feats, "qty_hat")
    return rounded(out.select(*K2, "date", "stage", "qty", "qty_hat"), 3)


# Default penalty of the stage fits and its overrides by partition.
RIDGE = {"ridge": 1.0}
RIDGE_OVERRIDES = [("R", 500.0), ("A", None)]
STAGE_COLUMNS = ["qty_lag_4", "qty_lag_20", "release"]  # what each stage may use of them is the stage's rule
_RIDGE_SQL = "CASE WHEN l_returnflag = 'R' THEN 500.0::DOUBLE ELSE 1.0::DOUBLE END"


@query("stage_ols_forecast", f"""
WITH {base_sql([4, 20])},
sr AS (SELECT *, {_RIDGE_SQL} AS ridge FROM sp),{two_sums_sql("sr", "qty_lag_4", "release", "any_value(ridge)", "near")},
{two_sums_sql("sr", "qty_lag_20", "release", "any_value(ridge)", "far").lstrip()}
SELECT l_suppkey, sp.l_returnflag, date, stage, cutoff AS training_date, round(qty, 3) + 0.0 AS qty,
       round(CASE WHEN stage = 1 THEN near.b0 + near.b1 * qty_lag_4 + near.b2 * release
                  ELSE far.b0 + far.b1 * qty_lag_20 + far.b2 * release END, 3) + 0.0 AS qty_hat
FROM sp LEFT JOIN near ON sp.l_returnflag = near.l_returnflag LEFT JOIN far ON sp.l_returnflag = far.l_returnflag
WHERE role = 'test'""")
def q_stage_ols_forecast(spark, sf_dir):
    """Per partition and stage: a fit on the features the stage may know, with the
    partition's penalty; the coefficients of all stages are stored by
    partition with their training date, read back, and scored."""
    b = base(spark, sf_dir, [4, 20])
    overrides = spark.createDataFrame(RIDGE_OVERRIDES, "l_returnflag string, ridge double")
    train = with_overrides(b.where(F.col("role") == "train"), overrides, PART, RIDGE)
    coefs = stage_coefficients(train, stages(HORIZON, STEP), [PART, "ridge", "cutoff"], STAGE_COLUMNS, "qty", "ridge")
    path = scratch_path(spark, "stage-coefs")
    coefs.write.partitionBy(PART).parquet(path)
    back = spark.read.schema(coefs.schema).parquet(path).select(
        PART, "stage", "term", "coef", F.col("cutoff").alias("training_date"))
    dates = back.groupBy(PART, "stage").agg(F.max("training_date").alias("training_date"))
    out = predict_stages(b.where(F.col("role") == "test"), back, [PART], STAGE_COLUMNS, "qty_hat").join(dates, [PART, "stage"], "left")
    return rounded(out.select(*K2, "date", "stage", "training_date", "qty", "qty_hat"), 3)


@query("residual_ols", f"""
WITH {BASE_SQL},
one AS (SELECT l_returnflag, regr_slope(qty, qty_lag_4) AS s, regr_intercept(qty, qty_lag_4) AS i
        FROM sp WHERE role = 'train' GROUP BY 1),
res AS (SELECT sp.l_returnflag, release, qty - (i + s * qty_lag_4) AS r
        FROM sp JOIN one ON sp.l_returnflag = one.l_returnflag WHERE role = 'train'),
two AS (SELECT l_returnflag, regr_slope(r, release) AS s2, regr_intercept(r, release) AS i2 FROM res GROUP BY 1)
SELECT l_suppkey, sp.l_returnflag, date,
       round(greatest(i + s * qty_lag_4 + i2 + s2 * release, 0.0), 3) + 0.0 AS qty_hat
FROM sp JOIN one ON sp.l_returnflag = one.l_returnflag JOIN two ON sp.l_returnflag = two.l_returnflag
WHERE stage = 1 AND qty_lag_4 IS NOT NULL""")
def q_residual_ols(spark, sf_dir):
    """A second model fitted to the first one's training residuals; the forecast is
    their sum, not below zero."""
    b = base(spark, sf_dir)
    train = b.where(F.col("role") == "train")
    first = fit_ols(train, [PART], ["qty_lag_4"], "qty")
    residuals = predict_linear(train, first, [PART], ["qty_lag_4"], "first").withColumn("r", F.col("qty") - F.col("first"))
    second = fit_ols(residuals, [PART], ["release"], "r")
    test = b.where((F.col("stage") == 1) & F.col("qty_lag_4").isNotNull())
    both = predict_linear(predict_linear(test, first, [PART], ["qty_lag_4"], "first"), second, [PART], ["release"], "second")
    return rounded(both.select(*K2, "date", F.greatest(F.col("first") + F.col("second"), F.lit(0.0)).alias("qty_hat")), 3)


@query("scaled_linear_forecast", f"""
WITH {BASE_SQL},
g AS (SELECT stddev_pop(qty_lag_12) AS d1, stddev_pop(release) AS d2, avg(qty_lag_12) AS g1, avg(release) AS g2
      FROM sp WHERE role = 'train' AND qty_lag_12 IS NOT NULL AND release IS NOT NULL),{two_sums_sql("sp", "qty_lag_12", "release", "0.0::DOUBLE", "co")}
SELECT l_returnflag, term, round(coef, 3) + 0.0 AS coef FROM (
  SELECT l_returnflag, unnest(['intercept', 'qty_lag_12_scaled', 'release_scaled']) AS term,
         unnest([b0 + b1 * g1 + b2 * g2, b1 * g.d1, b2 * g.d2]) AS coef FROM co, g) t""")
def q_scaled_linear_forecast(spark, sf_dir):
    """Coefficients of a fit on features scaled by the training rows' mean and deviation."""
    feats = ["qty_lag_12", "release"]
    train = base(spark, sf_dir).where(F.col("role") == "train").dropna(subset=feats)
    scaled = standard_scale(train, feats)
    return rounded(fit_ols(scaled, [PART], [f"{f}_scaled" for f in feats], "qty"), 3)


# ----------------------------------------------- evaluation of fitted models
LAGGED_TS_SQL = TS_SQL.replace("date, qty,\n", f"date, qty, {g.lag_sql(K2, 'qty', 4)} AS x,\n")
# Penalties of the search.
PENALTIES = [0.0, 1000.0, 100000.0]


def fold_fits(spark, sf_dir):
    """Rows with their test fold, and per fold the regression sums of all earlier rows.

    The sums come from one aggregate over the blocks, shifted by the overall
    means so that they lose no digits, and are accumulated over the few
    blocks; no row is copied into every fold."""
    from pyspark.sql import Window
    d = lag_features(dense_p2(spark, sf_dir).select(*K2, "date", "qty"), K2, "date", "qty", [4])
    t = stored(ts_split(d, TS_ORDER, SPLITS).where(F.col("qty_lag_4").isNotNull())
               .select("test_fold", F.col("qty_lag_4").alias("x"), F.col("qty").alias("y")), "folds")
    mid = t.agg(F.struct(F.avg("x").alias("x"), F.avg("y").alias("y"))).scalar()
    u, v = F.col("x") - mid["x"], F.col("y") - mid["y"]
    sums = t.groupBy("test_fold").agg(*[F.sum(e).alias(n) for n, e in (
        ("n", F.lit(1.0)), ("u", u), ("v", v), ("uu", u * u), ("uv", u * v))])
    w = Window.orderBy("test_fold").rowsBetween(Window.unboundedPreceding, -1)
    run = sums.select("test_fold", *[F.sum(c).over(w).alias(c) for c in ("n", "u", "v", "uu", "uv")])
    c = F.col
    folds = run.where(c("test_fold") >= 0).select(
        c("test_fold").alias("fold"), c("n").cast("long").alias("n_train"), (c("u") / c("n") + mid["x"]).alias("mx"),
        (c("v") / c("n") + mid["y"]).alias("my"), (c("uu") - c("u") * c("u") / c("n")).alias("sxx"),
        (c("uv") - c("u") * c("v") / c("n")).alias("sxy"))
    return t, folds


_FOLD_FITS_SQL = f"""{LAGGED_TS_SQL},
tx AS (SELECT * FROM ts WHERE x IS NOT NULL),
ff AS (SELECT f.fold, count(*) AS n_train, avg(x) AS mx, avg(qty) AS my, var_pop(x) * count(*) AS sxx, covar_pop(x, qty) * count(*) AS sxy
       FROM (SELECT DISTINCT test_fold AS fold FROM ts WHERE test_fold >= 0) f JOIN tx ON tx.test_fold < f.fold GROUP BY 1)"""


@query("cv_ols_rmse", f"""
WITH {_FOLD_FITS_SQL},
r AS (SELECT fold, n_train, count(*) AS n_test, sqrt(avg(pow(qty - (my + sxy / sxx * (x - mx)), 2))) AS rmse
      FROM tx JOIN ff ON tx.test_fold = ff.fold GROUP BY 1, 2)
SELECT fold, n_train, n_test, round(rmse, 4) + 0.0 AS rmse, round(avg(rmse) OVER (), 4) + 0.0 AS mean_rmse FROM r""")
def q_cv_ols_rmse(spark, sf_dir):
    """Expanding folds of a fitted regression: score per fold and their mean."""
    from pyspark.sql import Window
    t, folds = fold_fits(spark, sf_dir)
    te = t.join(F.broadcast(folds), F.col("test_fold") == F.col("fold"))  # folds: one row per split
    hat = F.col("my") + F.col("sxy") / F.col("sxx") * (F.col("x") - F.col("mx"))
    out = te.groupBy("fold", "n_train").agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(F.pow(F.col("y") - hat, 2))).alias("rmse"))
    return rounded(out.withColumn("mean_rmse", F.avg("rmse").over(Window.partitionBy())), 4)


@query("grid_ridge_cv", f"""
WITH {_FOLD_FITS_SQL},
p AS (SELECT unnest([{', '.join(f'{x}::DOUBLE' for x in PENALTIES)}]) AS penalty),
r AS (SELECT penalty, fold, sqrt(avg(pow(qty - (my + sxy / (sxx + penalty) * (x - mx)), 2))) AS rmse
      FROM tx JOIN ff ON tx.test_fold = ff.fold, p GROUP BY 1, 2),
m AS (SELECT penalty, avg(rmse) AS mean_rmse, max(rmse) AS worst_rmse FROM r GROUP BY 1)
SELECT penalty, round(mean_rmse, 4) + 0.0 AS mean_rmse, round(worst_rmse, 4) + 0.0 AS worst_rmse,
       CAST(row_number() OVER (ORDER BY round(mean_rmse, 4), penalty) AS INTEGER) AS rank FROM m""")
def q_grid_ridge_cv(spark, sf_dir):
    """Penalties x folds: each test row is scored by all penalties where it is read."""
    from pyspark.sql import Window
    t, folds = fold_fits(spark, sf_dir)
    te = t.join(F.broadcast(folds), F.col("test_fold") == F.col("fold"))  # folds: one row per split
    errors = F.array(*[F.struct(F.lit(p).alias("penalty"), F.pow(F.col("y") - (
        F.col("my") + F.col("sxy") / (F.col("sxx") + F.lit(p)) * (F.col("x") - F.col("mx"))), 2).alias("e")) for p in PENALTIES])
    score = te.select("fold", F.inline(errors)).groupBy("penalty", "fold").agg(F.sqrt(F.avg("e")).alias("rmse"))
    mean = rounded(score.groupBy("penalty").agg(F.avg("rmse").alias("mean_rmse"), F.max("rmse").alias("worst_rmse")), 4)
    return mean.withColumn("rank", F.row_number().over(Window.orderBy("mean_rmse", "penalty")))


@query("leaderboard_fitted", f"""
WITH {OLS_SQL},
li AS (SELECT l_returnflag, regr_slope(qty, qty_lag_4) AS s, regr_intercept(qty, qty_lag_4) AS i FROM sp WHERE role = 'train' GROUP BY 1),
me AS (SELECT l_returnflag, avg(qty) AS m FROM sp WHERE role = 'train' GROUP BY 1),
t AS (SELECT sp.*, i + s * qty_lag_4 AS ols, m FROM sp JOIN li ON sp.l_returnflag = li.l_returnflag
      JOIN me ON sp.l_returnflag = me.l_returnflag WHERE stage = 1 AND qty_lag_4 IS NOT NULL),
u AS (SELECT 'ols' AS model, ols AS p, qty FROM t UNION ALL SELECT 'mean', m, qty FROM t UNION ALL SELECT 'naive', qty_lag_4, qty FROM t),
r AS (SELECT model, round(sqrt(avg(pow(qty - p, 2))), 4) + 0.0 AS rmse, round(avg(abs(qty - p)), 4) + 0.0 AS mae, count(*) AS n FROM u GROUP BY 1)
SELECT *, CAST(row_number() OVER (ORDER BY rmse, model) AS INTEGER) AS rank FROM r""")
def q_leaderboard_fitted(spark, sf_dir):
    """A fitted regression against the training mean and the naive forecast on the same rows."""
    from pyspark.sql import Window
    b = base(spark, sf_dir)
    train = b.where(F.col("role") == "train")
    test = b.where((F.col("stage") == 1) & F.col("qty_lag_4").isNotNull())
    scored = predict_linear(test, fit_ols(train, [PART], ["qty_lag_4"], "qty"), [PART], ["qty_lag_4"], "ols")
    scored = scored.join(stored(train.groupBy(PART).agg(F.avg("qty").alias("mean")), "means"), PART)
    long = scored.select("qty", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("p"))
                                                  for m, c in (("ols", "ols"), ("mean", "mean"), ("naive", "qty_lag_4"))])))
    e = F.col("qty") - F.col("p")
    out = rounded(long.groupBy("model").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n")), 4)
    return out.withColumn("rank", F.row_number().over(Window.orderBy("rmse", "model")))


# ------------------------------------------------------- fitted by iteration
def stage_models(b, fit):
    """Fit and score every stage on what it may know: ``fit`` returns what scores rows. A lag
    that a row does not have yet is zero with a flag of its own."""
    lags = [f"qty_lag_{lag}" for lag in FLAGS]
    flagged = b.select("*", *[F.col(c).isNull().cast("int").alias(f"missing_{c}") for c in lags]).na.fill(0.0, lags)
    train, out = flagged.where((F.col("role") == "train") & F.col("qty").isNotNull()), []
    for stage in stages(HORIZON, STEP):
        features = stage.features([*lags, *[f"missing_{c}" for c in lags], "release"])
        scored = fit(train, features, "qty")(flagged.where(F.col("stage") == stage.number))
        out.append(scored.select(*K2, "date", "stage", "qty", F.greatest(F.col("prediction"), F.lit(0.0)).alias("qty_hat")))
    return union_by_name(out)


@query("tweedie_glm_forecast")
def q_tweedie_glm_forecast(spark, sf_dir):
    return stage_models(base(spark, sf_dir), lambda t, f, y: tweedie_glm(t, f, y, power=1.1, max_iter=10).transform)


@query("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    def fit(train, features, target):
        assembler, model = gbt_model(train, features, target, max_iter=10, max_depth=4)
        return lambda rows: model.transform(assembler.transform(rows))

    return stage_models(base(spark, sf_dir), fit)
