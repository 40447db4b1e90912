"""Shuffles that must not gather by a few groups, and tasks that follow the rows."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessellate import session
from tessellate.operators import boosting, panel, split, windows
from tessellate.operators.forecast import predict_linear, with_overrides
from tessellate.operators.prices import price_features


@pytest.fixture()
def rows(spark):
    return spark.range(400).select((F.col("id") % 3).cast("string").alias("grp"), (F.col("id") % 20).alias("k"),
                                   F.date_add(F.lit("2020-01-07").cast("date"), (F.col("id") / 20).cast("int") * 7).alias("date"),
                                   (F.col("id") % 7).cast("double").alias("qty"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partitions(df):
    return int(df.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]) + 1


def test_rows_are_not_shuffled_by_a_few_groups(spark, rows):
    stored = session.stored(rows, "rows")
    coefs = stored.groupBy("grp").agg(F.avg("qty").alias("coef")).select("grp", F.explode(F.array(F.lit("intercept"), F.lit("qty"))).alias("term"), "coef")
    overrides = spark.createDataFrame([("0", 2.0)], "grp string, p double")
    for out in (split.horizon_split(stored, ["grp"]), windows.target_encoding(stored, "qty", [["grp"]]),
                predict_linear(stored, coefs, ["grp"], ["qty"]), with_overrides(stored, overrides, "grp", {"p": 1.0})):
        assert "hashpartitioning" not in plan(out) and out.count() == 400


def test_tasks_follow_the_rows(spark, rows, monkeypatch):
    plain = {tuple(r) for r in panel.densify(rows.select("k", "date", "qty"), ["k"]).collect()}
    positions = split.global_position(rows, ["date", "k", "grp"]).collect()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    dense = panel.densify(rows.select("k", "date", "qty"), ["k"])
    rolled = windows.rolling_features(dense, ["k"], "date", "qty", [4], [1])
    assert {tuple(r) for r in dense.collect()} == plain
    shuffles = [line for line in plan(rolled).splitlines() if "hashpartitioning" in line]
    assert shuffles and all("REPARTITION_BY_NUM" in line for line in shuffles)
    many = split.global_position(rows, ["date", "k", "grp"])
    assert sorted(map(tuple, many.collect()), key=str) == sorted(map(tuple, positions), key=str)


@pytest.mark.parametrize("as_of", [None, "date"])
def test_encodings_by_more_tasks_are_the_same(spark, rows, monkeypatch, as_of):
    sets = [["grp"], ["k"], ["grp", "k"]]
    make = lambda: windows.target_encoding(rows, "qty", sets, as_of)
    few = make()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(windows, "FEW", 5)
    many = make()
    assert many.columns == few.columns
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))


def test_cut_points_are_exact_without_sketches(spark, monkeypatch):
    monkeypatch.setattr(boosting.F, "percentile_approx", None)
    random.seed(1)
    data = [(random.choice("ab"), random.choice([None, 1.0, random.random()]), None) for _ in range(2_000)]
    got = {r.k: r.cuts for r in boosting.cut_points(spark.createDataFrame(data, "k string, x double, y double"), ["k"], ["x", "y"], 12).collect()}
    for k in "ab":
        own = sorted(x for g, x, _ in data if g == k and x is not None)
        assert got[k] == [sorted({own[math.ceil(i / 12 * len(own)) - 1] for i in range(1, 12)}), []]


def test_prices_are_read_once_and_counted_while_narrow(spark):
    rows = spark.createDataFrame([(1, 1, 2.0, 1), (1, 2, 2.0, 1), (2, 1, 3.0, 1), (1, 1, 4.0, 2), (1, None, None, 3)],
                                 "a int, b int, p double, w int").selectExpr("*", "1 AS month", "2 AS year")
    out = price_features(rows, ["a", "b"], "p", "w")
    assert out.columns[:6] == ["a", "p", "b", "w", "month", "year"]
    got = {(r.a, r.b, r.w): (r.p_nunique_b, r.p_nunique_a, r.p_max, r.p_momentum) for r in out.collect()}
    assert got[1, 1, 1] == (1, 2, 4.0, None) and got[1, 1, 2] == (1, 1, 4.0, 2.0) and got[1, None, 3] == (None, None, None, None)
    assert plan(out).count("prices-") >= 1


@pytest.fixture()
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(windows, "FEW", 5)


def test_grid_rows_are_shuffled_once(spark, rows, small_tasks, monkeypatch):
    calendar = rows.select("date").distinct().withColumn("week", F.weekofyear("date"))
    panel_rows = rows.select("k", "grp", "date", "qty")
    keys = ["k", "grp"]

    def grid(dense):
        out = windows.target_encoding(dense, "qty", [["k"], ["grp"], keys], laid_by=keys)
        out = windows.ewm_features(out, keys, "date", "qty", [0.5], [0, 1])
        out = windows.lag_features(out, keys, "date", "qty", [2])
        return windows.rolling_features(out, keys, "date", "qty", [2], [1])

    kept = panel.spine_fill(panel_rows, calendar, keys, kept="kept")
    out = grid(kept)
    # only encodings are shuffled, to the buckets of the rows
    moved = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) <= 2 and "REPARTITION" not in plan(out) and plan(out).count("ShuffledHashJoin") == 1
    assert out.count() == kept.count()
    monkeypatch.undo()
    plain = grid(panel.spine_fill(panel_rows, calendar, keys))
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.select(out.columns).collect()))


@pytest.mark.parametrize("null", [None, "n"])
def test_encodings_within_others_survive_null_groups(spark, small_tasks, null):
    data = [(i % 8, "ab"[i % 2] if i % 5 else null, float(i)) for i in range(80)] + [(9, null, 1.0), (9, null, 2.0)]
    frame = spark.createDataFrame(data, "k int, grp string, qty double")
    out = windows.target_encoding(frame, "qty", [["k"], ["k", "grp"]]).collect()
    assert len(out) == len(data)
    for r in out:
        own = [q for k, _, q in data if k == r.k]
        both = [q for k, g, q in data if k == r.k and g == r.grp and g is not None]
        assert r.enc_k_mean == pytest.approx(sum(own) / len(own))
        assert r.enc_k_grp_mean == (pytest.approx(sum(both) / len(both)) if both else None)


def test_ewm_leaves_rows_by_key_and_gathers_those_without_one_in_parts(spark, monkeypatch):
    monkeypatch.setattr(windows, "NULL_ROWS", 3)
    data = [(k, i, float(i * (k or 1) % 7) if i % 4 else None, "x") for k in (1, 2, None) for i in range(10)]
    frame = spark.createDataFrame(data, "k int, w int, qty double, note string").repartition(3, "k")
    out = windows.lag_features(windows.ewm_features(frame, ["k"], "w", "qty", [0.3], [0, 2]), ["k"], "w", "qty", [1])
    assert plan(out).count("Exchange hashpartitioning") == 1
    got = {(r.k, r.w): r for r in out.collect() if r.k is not None}
    assert out.count() == 30 and out.where("k IS NULL AND qty_ewm_lag_0_alpha_03 IS NULL AND note = 'x'").count() == 10
    for k in (1, 2):
        want = pd.Series([q for key, _, q, _ in data if key == k], dtype="float64").ewm(alpha=0.3).mean()
        for i in range(10):
            now, before = got[k, i].qty_ewm_lag_0_alpha_03, got[k, i].qty_ewm_lag_2_alpha_03
            assert now == (None if want[i] != want[i] else want[i])
            assert before == (None if i < 2 or want[i - 2] != want[i - 2] else want[i - 2])


@pytest.mark.parametrize("tasks", [False, True])
def test_price_rows_are_shuffled_once_for_each_key_and_for_both(spark, monkeypatch, tasks):
    if tasks:
        monkeypatch.setattr(session, "ROWS_PER_TASK", 3)
    data = [(a, b, q, w) for w in range(4) for a, b, q in [(1, 1, 2.0), (2, 1, 2.0), (None, 1, 2.0), (1, 2, 2.0 + w % 2), (2, 2, None), (3, None, 7.0),
                                                           (4, 4, 2.0), (5, 4, 2.0), (6, 6, [1.0, 2.0, 2.0, -0.0][w]), (7, 6, [2.0, 3.0, 4.0, 0.0][w])]]
    rows = spark.createDataFrame([*data, data[0]], "a int, b int, p double, w int").selectExpr("*", "w % 2 AS month", "2 AS year")
    out = price_features(rows, ["a", "b"], "p", "w")
    moved = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 3 and "Join" not in plan(out)
    got = out.collect()
    assert len(got) == len(data) + 1
    for r in got:
        of_b = {a for a, b, q, _ in data if r.b is not None and b == r.b and a is not None and q == r.p}
        of_a = {b for a, b, q, _ in data if r.a is not None and a == r.a and b is not None and q == r.p}
        assert r.p_nunique_b == (len(of_b) if r.b is not None and r.p is not None else None)
        assert r.p_nunique_a == (len(of_a) if r.a is not None and r.p is not None else None)
        own = [q for a, b, q, _ in data if a == r.a and b == r.b and q is not None] if r.a is not None and r.b is not None else []
        assert r.p_nunique == (len(set(own)) if own else None)
        if own:
            assert (r.p_max, r.p_min, r.p_norm) == (max(own), min(own), r.p / max(own))
        else:
            assert (r.p_max, r.p_std, r.p_mean, r.p_norm) == (None,) * 4
