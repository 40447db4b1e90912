"""Stages, regression from block sums, fitted models, positions."""

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
import pytest

from tessellate.operators.forecast import fit_ols, predict_linear, predict_stages, stage_coefficients
from tessellate.operators.split import global_position, stages
from tessellate.plans import q_forecast as qf

SF = "/root/testdata/sf0.001"


def test_stage_knows_only_what_is_old_enough():
    first, second, third = stages(12, 4, seasonal=(26, 52))
    assert [(s.first, s.last, s.lag) for s in (first, second, third)] == [(1, 4, 4), (5, 8, 8), (9, 12, 12)]
    columns = ["qty_lag_4", "qty_lag_8", "qty_lag_17", "qty_lag_26", "qty_roll_mean_lag_4_win_8", "qty_roll_std_lag_8_win_4",
               "qty_ewm_lag_12_alpha_05", "release", "enc_item_mean"]
    assert first.features(columns) == ["qty_lag_4", "qty_lag_8", "qty_lag_26", *columns[4:]]
    assert second.features(columns) == ["qty_lag_8", "qty_lag_17", "qty_lag_26", *columns[5:]]
    assert third.features(columns) == ["qty_lag_17", "qty_lag_26", *columns[6:]]


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_fit_equals_a_direct_solution(spark, offset):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "a": rng.normal(size=900) + offset, "b": rng.normal(size=900) * 5})
    pdf["y"] = 2 * (pdf.a - offset) - 3 * pdf.b + pdf.g + rng.normal(size=900) * 0.01
    pdf.loc[5, "a"] = np.nan
    coefs = fit_ols(spark.createDataFrame(pdf).repartition(5), ["g"], ["a", "b"], "y").toPandas()
    for g, part in pdf.dropna().groupby("g"):
        x = np.column_stack([np.ones(len(part)), part.a - offset, part.b])
        want = np.linalg.lstsq(x, part.y, rcond=None)[0]
        got = coefs[coefs.g == g].set_index("term").coef
        assert np.allclose([got.a, got.b], want[1:], rtol=1e-6)
        assert np.isclose(got.intercept + got.a * offset, want[0], atol=1e-5)


def test_stage_scores_use_the_coefficients_of_their_stage(spark):
    rows = [("p", float(i), float(i % 7), 3.0 * i + (i % 7)) for i in range(60)]
    train = spark.createDataFrame(rows, "p string, qty_lag_4 double, qty_lag_8 double, y double")
    parts = stages(8, 4)
    coefs = stage_coefficients(train, parts, ["p"], ["qty_lag_4", "qty_lag_8"], "y")
    assert {(r.stage, r.term) for r in coefs.collect()} == {(1, "intercept"), (1, "qty_lag_4"), (1, "qty_lag_8"),
                                                            (2, "intercept"), (2, "qty_lag_8")}
    test = spark.createDataFrame([("p", 1, 10.0, 2.0), ("p", 2, 10.0, 2.0)], "p string, stage int, qty_lag_4 double, qty_lag_8 double")
    got = {r.stage: r.prediction for r in predict_stages(test, coefs, ["p"], ["qty_lag_4", "qty_lag_8"]).collect()}
    only = predict_linear(test, fit_ols(train, ["p"], ["qty_lag_8"], "y"), ["p"], ["qty_lag_8"]).first().prediction
    assert np.isclose(got[1], 32.0) and np.isclose(got[2], only)


def test_trees_per_stage(spark):
    out = qf.q_gbt_forecast(spark, SF).toPandas()
    b = qf.base(spark, SF)
    assert len(out) == b.where(F.col("stage").isNotNull()).count()
    assert set(out.stage) == {1, 2, 3} and np.isfinite(out.qty_hat).all() and (out.qty_hat >= 0).all()
    assert out.qty_hat.max() <= 2 * b.where(F.col("role") == "train").agg(F.max("qty")).first()[0]


def test_positions_of_wide_rows_under_small_coalescing(spark):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000, numPartitions=8).selectExpr("(id * 7919) % 200003 AS v", "repeat(cast(id AS string), 12) AS wide")
        pos = global_position(df, ["v"], total_col="n")
        r = pos.agg(F.count_distinct("pos").alias("d"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.max("n").alias("n")).first()
        assert (r.d, r.lo, r.hi, r.n) == (200_000, 0, 199_999, 200_000)
        rank = pos.select("pos", "v").toPandas().sort_values("v").pos.tolist()
        assert rank == sorted(rank)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
