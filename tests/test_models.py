"""Boosted trees, generalised linear models and grid search against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessellate.operators.boosting import binned, cut_points, fit_trees, predict_trees, thresholds
from tessellate.operators.forecast import gbt_model
from tessellate.operators.glm import fit_tweedie, predict_tweedie, tweedie_glm
from tessellate.operators.grid_path import elastic_path, mean_scores, path_scores, ridge_path


def plain_booster(rows, power, rate, trees, depth, least):
    """Scores of rows (bins, y) by the same rules, one row at a time."""
    f = [0.0] * len(rows)
    for _ in range(trees):
        grad = [(math.exp((2 - power) * s) - y * math.exp((1 - power) * s),
                 (2 - power) * math.exp((2 - power) * s) - y * (1 - power) * math.exp((1 - power) * s)) for (_, y), s in zip(rows, f)]
        nodes = {1: list(range(len(rows)))}
        for d in range(depth):
            for node in [n for n in nodes if 1 << d <= n < 2 << d]:
                own, best = nodes[node], None
                total = [sum(grad[i][k] for i in own) for k in (0, 1)]
                for j in range(len(rows[0][0])):
                    for cut in sorted({rows[i][0][j] for i in own}):
                        left = [i for i in own if rows[i][0][j] <= cut]
                        if len(left) < least or len(own) - len(left) < least:
                            continue
                        a = [sum(grad[i][k] for i in left) for k in (0, 1)]
                        b = [total[0] - a[0], total[1] - a[1]]
                        gain = a[0] ** 2 / a[1] + b[0] ** 2 / b[1] - total[0] ** 2 / total[1]
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, j, cut)
                if best:
                    _, j, cut = best
                    del nodes[node]
                    nodes[2 * node] = [i for i in own if rows[i][0][j] <= cut]
                    nodes[2 * node + 1] = [i for i in own if rows[i][0][j] > cut]
        for own in nodes.values():
            step = -rate * sum(grad[i][0] for i in own) / sum(grad[i][1] for i in own)
            for i in own:
                f[i] += step
    return [math.exp(s) for s in f]


def test_trees_match_a_plain_booster(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        x1, x2 = rng.choice([None, *range(9)]), rng.random() * 5
        y = max(0.0, round(rng.gauss(2 + (x1 or 0) * (i % 2) + x2 * x2 / 4, 2), 1))
        rows.append((i, "pq"[i % 2], None if x1 is None else float(x1), x2, y))
    rows += [(1000, "p", 1.0, 1.0, None), (1001, "r", None, None, 3.0), (1002, None, 1.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, grp string, x1 double, x2 double, y double").withColumn(
        "power", F.when(F.col("grp") == "p", 1.2).otherwise(1.5)).withColumn("rate", F.lit(0.4))
    feats = ["x1", "x2"]
    data = binned(df, cut_points(df, "grp", feats, 8), "grp", feats).cache()
    trees = fit_trees(data, "grp", "y", trees=3, depth=2, min_rows=15)
    got = {r.id: r for r in predict_trees(data, trees, "grp", 2).collect()}
    for grp, power in (("p", 1.2), ("q", 1.5)):
        own = [r for r in got.values() if r.grp == grp and r.y is not None]
        want = plain_booster([(r.bins, r.y) for r in own], power, 0.4, 3, 2, 15)
        for r, p in zip(own, want):
            assert r.prediction == pytest.approx(p, rel=1e-6)
        assert np.mean([(r.y - r.prediction) ** 2 for r in own]) < np.mean([(r.y - 1) ** 2 for r in own])
    assert got[1000].prediction > 0 and got[1001].prediction == pytest.approx(
        plain_booster([((0, 0), 3.0)], 1.5, 0.4, 3, 2, 15)[0])
    assert 1002 not in got  # null keys have no model
    some = fit_trees(data, "grp", "y", trees=2, depth=1, min_rows=15, feature_share=0.5, row_share=0.5)
    assert some.count() >= 4


@pytest.mark.parametrize("power, penalty", [(1.3, 0.0), (1.6, 0.05), (0.0, 0.2)])
def test_glm_reaches_the_optimum(spark, power, penalty):
    rng = np.random.default_rng(3)
    rows = []
    for grp, n in (("a", 300), ("b", 80), ("zero", 5)):
        for _ in range(n):
            x = rng.normal(size=2)
            mean = math.exp(0.5 + 0.4 * x[0] - 0.2 * x[1])
            rows.append((grp, float(x[0]), float(x[1]), 0.0 if grp == "zero" else float(rng.poisson(mean))))
    rows += [("a", None, 1.0, 2.0), ("a", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "grp string, x1 double, x2 double, y double")
    fits = fit_tweedie(df, "grp", ["x1", "x2"], "y", power, penalty).cache()
    got = {r.grp: r for r in fits.collect()}
    assert all(r.converged for r in got.values()) and len(got) == 3
    for grp in ("a", "b"):
        own = np.array([r[1:] for r in rows if r[0] == grp and None not in r])
        beta = np.array(got[grp].beta)
        eta = beta[0] + own[:, :2] @ beta[1:]
        mu = np.exp(eta) if power > 0 else eta
        slope = (own[:, 2] - mu) * (mu ** (1 - power) if power > 0 else 1.0)
        assert abs(slope.mean()) < 1e-6
        assert np.allclose((slope[:, None] * own[:, :2]).mean(axis=0), penalty * beta[1:], atol=1e-6)
    scored = predict_tweedie(df, fits, "grp", ["x1", "x2"], power).where("x1 IS NULL OR grp = 'zero'").collect()
    assert all((r.prediction is None) if r.x1 is None else abs(r.prediction) < 1e-9 for r in scored)


def test_paths_solve_their_equations():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4))
    x[:, 3] = x[:, 2]  # two equal features
    y = x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=50)
    cross, xy = x.T @ x / 50, x.T @ y / 50
    for p, b in zip((0.1, 2.0), ridge_path(cross, xy, (0.1, 2.0))):
        assert np.allclose((cross + p * np.eye(4)) @ b, xy)
    assert np.allclose(cross @ ridge_path(cross, xy, (0.0,))[0], xy)
    for alpha, b in zip((0.01, 0.3, 9.0), elastic_path(cross, xy, (0.01, 0.3, 9.0), 0.6)):
        slope = xy - cross @ b - alpha * 0.4 * b  # subgradient
        assert np.all(np.where(b != 0, np.abs(slope - alpha * 0.6 * np.sign(b)) < 1e-6, np.abs(slope) <= alpha * 0.6 + 1e-6))


def test_path_scores_match_fits_on_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2], i // 40 - 1, float(a), float(b), float(3 + 2 * a - b + e))
            for i, (a, b, e) in enumerate(rng.normal(size=(160, 3)))]
    rows += [("a", 0, None, 1.0, 1.0), ("b", 1, 1.0, 1.0, None), ("only", 0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "grp string, fold int, x1 double, x2 double, y double")
    scores = path_scores(df, "grp", "fold", ["x1", "x2"], "y", [0.01, 0.5], [0.0, 0.5])
    got = {(r.grp, r.fold, r.alpha, r.l1_ratio): r for r in scores.collect()}
    assert len(got) == 2 * 3 * 4
    for (grp, fold, alpha, ratio), r in got.items():
        train = np.array([x[2:] for x in rows if x[0] == grp and x[1] < fold and None not in x])
        test = np.array([x[2:] for x in rows if x[0] == grp and x[1] == fold and None not in x])
        assert (r.n_train, r.n_test) == (len(train), len(test))
        m, d = train.mean(axis=0), train[:, :2].std(axis=0)
        z, t = (train[:, :2] - m[:2]) / d, train[:, 2] - m[2]
        b = elastic_path(z.T @ z / len(z), z.T @ t / len(z), [alpha], ratio)[0]
        hat = m[2] + ((test[:, :2] - m[:2]) / d) @ b
        assert r.rmse == pytest.approx(np.sqrt(np.mean((test[:, 2] - hat) ** 2)), rel=1e-6)
    assert mean_scores(scores, "grp").where("folds = 3").count() == 8


def regression_rows(spark, n):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        a, b = float(rng.choice([0, 0, 0, *range(60)])), round(rng.random() * 40, 1)
        rows.append((i, a, b, int(i % 7 == 0), max(0.0, round(rng.gauss(2 + a / 20 + b * b / 300 - (a > 30) * 2, 1.5), 1))))
    return spark.createDataFrame(rows, "id long, a double, b double, flag int, y double").repartition(5)


def mllib(spark, df, regressor):
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=["a", "b", "flag"], outputCol="f")
    model = regressor.setFeaturesCol("f").setLabelCol("y").fit(va.transform(df))
    return {r.id: r.prediction for r in model.transform(va.transform(df)).collect()}


def test_thresholds_are_those_of_all_rows(spark):
    df = regression_rows(spark, 12_000)
    rows = df.collect()
    got = thresholds(df.union(df.limit(1).selectExpr("-1L", "null", "null", "1", "0.0")), ["a", "b", "flag"], 16)
    for found, name in zip(got, ("a", "b", "flag")):
        counts = sorted((v, sum(r[name] == v for r in rows)) for v in {r[name] for r in rows})
        if len(counts) <= 16:
            assert found == [(u[0] + v[0]) / 2 for u, v in zip(counts, counts[1:])]
            continue
        want, upto, aim = [], counts[0][1], len(rows) / 16
        for (u, _), (v, n) in zip(counts, counts[1:]):
            before, upto = upto, upto + n
            if abs(before - aim) < abs(upto - aim):
                want.append((u + v) / 2)
                aim += len(rows) / 16
        assert found == want and len(want) > 10


def test_trees_of_cells_are_those_of_rows(spark):
    from pyspark.ml.regression import GBTRegressor
    df = regression_rows(spark, 2_000)
    want = mllib(spark, df, GBTRegressor(maxIter=4, maxDepth=3, seed=1))
    va, model = gbt_model(df, ["a", "b", "flag"], "y", max_iter=4, max_depth=3, seed=1)
    got = {r.id: r.prediction for r in model.transform(va.transform(df)).collect()}
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want) and len(got) == len(want)


def test_trees_grow_on_as_many_rows_as_bins_allow(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    sizes, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df, *a: sizes.append(df.count()) or fit(self, df, *a))
    gbt_model(regression_rows(spark, 4_000), ["a", "flag"], "y", max_iter=1, max_depth=1, bins=8)
    assert sizes[0] <= 16


def test_glm_takes_the_steps_of_mllib_and_reads_the_rows_once(spark):
    from pyspark.ml.regression import GeneralizedLinearRegression
    df = regression_rows(spark, 1_500)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = df.cache()
    model = tweedie_glm(df.mapInArrow(seen, df.schema), ["a", "b", "flag"], "y", 1.1, 10)
    assert read.value == 1_500 and 1 < model.steps <= 10
    want = mllib(spark, df, GeneralizedLinearRegression(family="tweedie", variancePower=1.1, linkPower=0.0, maxIter=10))
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    assert all(math.isclose(got[i], want[i], rel_tol=1e-8) for i in want) and len(got) == len(want)
    with pytest.raises(Exception, match="negative"):
        tweedie_glm(df.selectExpr("a", "-y AS y"), ["a"], "y")
