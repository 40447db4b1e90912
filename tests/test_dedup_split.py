"""Order-independent dedup, time splits and the distributed row index."""

import datetime as dt

import pyspark.sql.functions as F

from tessellate.operators.dedup import earliest_by, latest_by
from tessellate.operators.split import global_position, horizon_split, ts_split


def test_latest_by_any_partitioning(spark):
    df = spark.range(0, 3000).select((F.col("id") % 100).alias("k"), (F.col("id") % 7).alias("ts"),
                                     F.col("id").alias("tie"))
    expected = None
    for n in (1, 4, 16):
        got = sorted(tuple(r) for r in latest_by(df.repartition(n), ["k"], ["ts", "tie"]).collect())
        assert len(got) == 100
        expected = expected or got
        assert got == expected


def test_earliest_first_date_keeps_every_key(spark):
    ids = spark.range(0, 5000)
    days = F.array(*[F.lit(d) for d in ("2024-01-01", "2024-01-02", "2024-01-03")])
    rows = ids.select("id", F.explode(days).alias("d")).repartition(8)
    first = earliest_by(rows, ["id"], ["d"]).where(F.col("d") == "2024-01-01")
    assert first.count() == 5000


def test_global_position_is_dense_and_ordered(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("v")).repartition(5)
    pos = global_position(df, ["v"]).collect()
    assert sorted(r.pos for r in pos) == list(range(2000))
    assert all(r.pos == r.v for r in pos)


def test_ts_split_matches_expanding_folds(spark):
    n, k = 103, 4
    df = spark.range(0, n).select(F.col("id").alias("t"))
    got = {r.t: r.test_fold for r in ts_split(df, ["t"], k).collect()}
    size = n // (k + 1)
    first = n - k * size
    for t in range(n):
        assert got[t] == (-1 if t < first else (t - first) // size)


def test_horizon_split_stages(spark):
    base = dt.date(2024, 1, 2)
    rows = [("p", base + dt.timedelta(days=7 * i)) for i in range(30)]
    df = spark.createDataFrame(rows, "p string, date date")
    out = {r.date: (r.role, r.stage) for r in horizon_split(df, ["p"], "date", 12, 4).collect()}
    last = base + dt.timedelta(days=7 * 29)
    cutoff = last - dt.timedelta(weeks=12)
    for d, (role, stage) in out.items():
        w = (d - cutoff).days // 7
        if d <= cutoff:
            assert role == "train" and stage is None
        else:
            assert role == "test" and stage == (w - 1) // 4 + 1
