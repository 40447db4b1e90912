"""Calendar functions vs pandas, nearest search vs brute force, stream replay."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pyspark.sql.functions as F

from tessellate.functions.calendar import date_parts, moon_phase, week_bucket
from tessellate.operators.geo import haversine_km, k_nearest
from tessellate.operators.increment import load_plan


def test_week_bucket_and_parts_match_pandas(spark):
    days = pd.date_range("2015-12-20", "2017-02-10", freq="D")
    df = spark.createDataFrame(pd.DataFrame({"d": days.date}), "d date")
    got = df.select("d", week_bucket("d").alias("w"), *date_parts("d"), moon_phase("d").alias("moon")).toPandas()
    ref = pd.Series(days).dt.to_period("W-MON").dt.to_timestamp().dt.date
    assert (got["w"].tolist() == ref.tolist())
    s = pd.Series(days)
    assert got["day_of_week"].tolist() == s.dt.dayofweek.tolist()
    assert got["week_of_year"].tolist() == s.dt.isocalendar().week.astype(int).tolist()
    assert got["is_month_end"].tolist() == s.dt.is_month_end.astype(int).tolist()
    moon = dict(zip(got["d"], got["moon"]))
    # published new and full moons of 2016 (phase 0 and 4 of eight)
    for day in ("2016-01-10", "2016-03-09", "2016-06-05", "2016-09-01", "2016-11-29"):
        assert moon[dt.date.fromisoformat(day)] == 0, day
    for day in ("2016-01-24", "2016-04-22", "2016-07-19", "2016-10-16", "2016-12-14"):
        assert moon[dt.date.fromisoformat(day)] == 4, day
    # the eighths follow one another, three to five days each
    phases = [moon[d] for d in sorted(moon)]
    runs = [(p, len(list(r))) for p, r in itertools.groupby(phases)][1:-1]
    assert all(b[0] == (a[0] + 1) % 8 for a, b in zip(runs, runs[1:])) and {n for _, n in runs} <= {3, 4, 5}


def test_k_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    st = pd.DataFrame({"st_id": range(300), "lat": rng.uniform(-80, 80, 300), "lon": rng.uniform(-180, 180, 300)})
    lo = pd.DataFrame({"loc_id": range(20), "lat": rng.uniform(-60, 60, 20), "lon": rng.uniform(-180, 180, 20)})
    got = k_nearest(spark.createDataFrame(lo), spark.createDataFrame(st), k=5).toPandas()

    def hav(a, b, c, d):
        p1, p2, dp, dl = map(math.radians, (a, c, c - a, d - b))
        h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))

    for _, l in lo.iterrows():
        d = sorted((hav(l.lat, l.lon, s.lat, s.lon), s.st_id) for _, s in st.iterrows())[:5]
        g = got[got.loc_id == l.loc_id].sort_values("rank")
        assert g.st_id.tolist() == [x[1] for x in d]


def test_load_plan_watermark_and_empty(spark):
    files = spark.createDataFrame([
        ("2024-01-01T00.00.00Z", "t1", "p1", 100), ("2024-01-02T00.00.00Z", "t1", "p2", 200),
        ("2024-01-02T00.00.00Z", "t2", "p3", 150)], "folder string, entity string, path string, modified long")
    state = spark.createDataFrame([("t1", 150)], "table_name string, last_watermark long")
    plan = {r.table_name: r for r in load_plan(files, state).collect()}
    assert [f.name for f in plan["t1"].folders] == ["2024-01-02T00.00.00Z"]
    assert plan["t1"].has_data and not plan["t1"].is_first_load
    assert plan["t2"].is_first_load and plan["t2"].last_watermark == 0
    empty = load_plan(files.where("false"), state)
    assert empty.count() == 0


def test_k_nearest_small_cells_still_exact(spark):
    rng = np.random.default_rng(5)
    st = pd.DataFrame({"st_id": range(200), "lat": rng.uniform(-89, 89, 200), "lon": rng.uniform(-180, 180, 200)})
    lo = pd.DataFrame({"loc_id": range(5), "lat": [89.5, -89.5, 0.0, 45.0, -10.0], "lon": [0.0, 10.0, 179.9, -179.9, 0.0]})
    got = k_nearest(spark.createDataFrame(lo), spark.createDataFrame(st), k=3, cell=0.01).toPandas()
    ref = k_nearest(spark.createDataFrame(lo), spark.createDataFrame(st), k=3, cell=1.0).toPandas()
    key = lambda d: sorted(zip(d.loc_id, d.st_id, d["rank"]))
    assert key(got) == key(ref) and len(got) == 15


def test_frame_diff_null_keys_are_one_sided(spark):
    from tessellate.operators.reshape import frame_diff
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (None, "n")], "k int, v string")
    got = sorted(((r.k if r.k is not None else -1), r.column, r.left_value or "", r.right_value or "")
                 for r in frame_diff(a, b, ["k"]).collect())
    assert got == [(-1, "v", "", "n"), (-1, "v", "n", ""), (2, "v", "y", "z")]


def test_left_merge_null_keys_match_like_pandas(spark):
    from tessellate.operators.joins import left_merge
    l = pd.DataFrame({"k": [1.0, 2.0, None, None], "a": [10, 20, 30, 40]})
    r = pd.DataFrame({"k": [1.0, None, 3.0], "a": [0, 0, 0], "b": ["x", "n", "z"]})
    got = left_merge(spark.createDataFrame(l, "k double, a long"), spark.createDataFrame(r, "k double, a long, b string"),
                     ["k"]).toPandas()
    # the left amount wins over the right one of the same name; nulls meet nulls
    assert sorted((x if x == x and x is not None else -1, y, z or "") for x, y, z in
                  zip(got["k"], got["a"], got["b"])) == [(-1, 30, "n"), (-1, 40, "n"), (1.0, 10, "x"), (2.0, 20, "")]


def test_left_merge_spreads_many_null_keys(spark):
    from tessellate.operators.joins import left_merge
    l = spark.range(2000).selectExpr("cast(null as bigint) AS k", "id AS a")
    r = spark.range(3).selectExpr("cast(null as bigint) AS k", "id AS b")
    out = left_merge(l, r, ["k"])
    assert out.count() == 6000 and out.select("a", "b").distinct().count() == 6000


def test_k_nearest_has_no_round_limit(spark):
    lo = spark.createDataFrame([(1, 10.0, 20.0)], "loc_id int, lat double, lon double")
    st = spark.createDataFrame([(7, -60.0, -150.0)], "st_id int, lat double, lon double")
    got = k_nearest(lo, st, k=3, cell=0.01).collect()
    assert [(r.loc_id, r.st_id, r["rank"]) for r in got] == [(1, 7, 1)]


def test_rounding_keeps_large_values_nan_and_infinity(spark):
    import duckdb

    from tessellate.plans.registry import fast_round, spark_rounding_sql
    values = [1e13, 1.5e13, 9.3e12 + 0.25, 1.2345675, -2.5, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fast_round("x", 6)).collect()]
    assert got[:2] == [1e13, 1.5e13] and got[5:7] == [float("inf"), float("-inf")]
    assert got[7] != got[7] and got[8] is None and got[3] == 1.234568
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    other = [r[0] for r in con.execute(spark_rounding_sql("SELECT round(x, 6) FROM t ORDER BY i")).fetchall()]
    assert [repr(v) for v in other] == [repr(v) for v in got]


def test_compaction_splits_a_hot_value(spark):
    from tessellate.operators.maintenance import compact
    rows = spark.range(100_000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' AS at")
    parts = compact(rows, ["at"], total_bytes=10, target_bytes=1).rdd.glom().map(len).collect()
    assert len(parts) == 10 and max(parts) < 20_000


def test_missing_shared_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from tessellate.session import shared_dir
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
