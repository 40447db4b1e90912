"""Spine invariants, stream = batch with replay, negative inputs."""

import datetime as dt

import pyspark.sql.functions as F
import pytest

from tessellate.operators.increment import source_snapshot, upsert_soft_delete
from tessellate.operators.panel import densify
from tessellate.session import scratch_path
from tessellate.sources import files as io
from tessellate.sources.snapshot_table import SnapshotTable, apply_upsert, first_load
from tessellate.sources.sinks import write_parquet
from tessellate.streaming.upsert_stream import run_stream_upsert

W0 = dt.date(2024, 1, 2)


def wk(i):
    return W0 + dt.timedelta(days=7 * i)


def test_densify_invariants(spark):
    rows = [("a", wk(0), 0.0), ("a", wk(2), 3.0), ("a", wk(5), -1.0), ("a", wk(6), 2.0),
            ("b", wk(1), 0.0), ("b", wk(3), 0.0),            # never positive -> dropped
            ("c", wk(4), None), ("c", wk(6), 1.0),           # null before release
            (None, wk(0), 9.0)]                              # null key -> dropped
    df = spark.createDataFrame(rows, "k string, date date, qty double")
    out = densify(df, ["k"], "date", "qty", end=wk(8)).collect()
    by = {}
    for r in out:
        by.setdefault(r.k, []).append(r)
    assert set(by) == {"a", "c"}
    a = sorted(by["a"], key=lambda r: r.date)
    assert [r.date for r in a] == [wk(i) for i in range(2, 9)]          # release .. end, no gaps
    assert [r.qty for r in a] == [3.0, 0.0, 0.0, -1.0, 2.0, 0.0, 0.0]    # zero fill, values kept
    assert [r.release for r in a] == [float(i) for i in range(7)]       # age in weeks
    c = sorted(by["c"], key=lambda r: r.date)
    assert [r.date for r in c] == [wk(6), wk(7), wk(8)]


def test_densify_end_before_release_gives_nothing(spark):
    df = spark.createDataFrame([("a", wk(5), 1.0)], "k string, date date, qty double")
    assert densify(df, ["k"], "date", "qty", end=wk(3)).count() == 0


SCHEMA = "Id bigint, SinkModifiedOn timestamp_ntz, createdon timestamp_ntz, IsDelete boolean, v double, __folder string"


def _changes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_stream_equals_batch_and_replay_adds_nothing(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    wave1 = [(1, t(1), t(1), False, 1.0, "f1"), (2, t(1), t(1), False, 2.0, "f1"),
             (1, t(2), t(1), False, 1.5, "f2"), (3, t(2), t(2), None, 3.0, "f2")]
    wave2 = [(1, t(5), t(1), True, 9.0, "f5"), (2, t(5), t(5), False, 2.5, "f5"), (4, t(6), t(6), False, 4.0, "f6")]
    root = scratch_path(spark, "stream-test")
    src = f"{root}/in"
    prep = lambda b: source_snapshot(b, ["Id"]).drop("__updated_at")
    write_parquet(_changes(spark, wave1), f"{src}/w1")
    run_stream_upsert(spark, src, SCHEMA, f"{root}/t", f"{root}/c", prep)
    write_parquet(_changes(spark, wave2), f"{src}/w2")
    run_stream_upsert(spark, src, SCHEMA, f"{root}/t", f"{root}/c", prep)
    streamed = sorted(tuple(r) for r in SnapshotTable(spark, f"{root}/t").read()
                      .select("Id", "v", "IsDelete", "PartitionId").collect())
    # batch: first load of wave 1, upsert of wave 2
    broot = scratch_path(spark, "batch-test")
    table = first_load(spark, broot, prep(_changes(spark, wave1)))
    apply_upsert(table, prep(_changes(spark, wave2)), lambda a, b: upsert_soft_delete(a, b, ["Id"]))
    batch = sorted(tuple(r) for r in table.read().select("Id", "v", "IsDelete", "PartitionId").collect())
    assert streamed == batch
    assert (1, 1.5, True, 2024) in streamed          # delete flag only, values kept
    # replay: same checkpoint, no new files -> table unchanged
    run_stream_upsert(spark, src, SCHEMA, f"{root}/t", f"{root}/c", prep)
    again = sorted(tuple(r) for r in SnapshotTable(spark, f"{root}/t").read()
                   .select("Id", "v", "IsDelete", "PartitionId").collect())
    assert again == streamed
    # a new checkpoint counts its batches from 0 again: files that arrive for it are not skipped
    src2 = f"{root}/in2"
    write_parquet(_changes(spark, [(8, t(9), t(9), False, 8.0, "f9")]), f"{src2}/w1")
    run_stream_upsert(spark, src2, SCHEMA, f"{root}/t", f"{root}/c2", prep)
    assert (8, 8.0, False, 2024) in [tuple(r) for r in SnapshotTable(spark, f"{root}/t").read()
                                     .select("Id", "v", "IsDelete", "PartitionId").collect()]


def test_missing_manifest_raises(spark):
    with pytest.raises(Exception):
        io.read_manifest_entities(spark, scratch_path(spark, "nothing") + "/model.json").collect()


def test_all_null_target_drops_key(spark):
    df = spark.createDataFrame([("a", wk(0), None), ("a", wk(1), None)], "k string, date date, qty double")
    assert densify(df, ["k"], "date", "qty", end=wk(3)).count() == 0
