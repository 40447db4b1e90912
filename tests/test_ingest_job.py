"""Ingest job: per-table decisions, failures, retries and watermarks."""

import datetime as dt

import pyspark.sql.functions as F

from tessellate.operators.increment import source_snapshot
from tessellate.operators.ingest_job import REJECTED_SCHEMA, ingest_folders, run_ingest
from tessellate.session import scratch_path
from tessellate.sources.snapshot_table import SnapshotTable
from tessellate.sources.state import StateTable

SCHEMA = "Id bigint, SinkModifiedOn timestamp_ntz, createdon timestamp_ntz, IsDelete boolean, v double, __folder string, entity string"


def test_failure_keeps_watermark_and_others_load(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = spark.createDataFrame([
        (1, t(1), t(1), False, 1.0, "2024-01-01", "good"), (2, t(1), t(1), False, 2.0, "2024-01-01", "bad"),
        (1, t(2), t(1), False, 3.0, "2024-01-02", "good")], SCHEMA)
    files = rows.select(F.col("__folder").alias("folder"), "entity", F.lit("p").alias("path"),
                        (F.col("v") * 100).cast("long").alias("modified"))
    root = scratch_path(spark, "job")
    state = StateTable(spark, f"{root}/state")
    fail = {"bad"}

    def snapshot(table, folders):
        if table in fail:
            raise RuntimeError("source unreadable " * 100)
        return source_snapshot(rows.where((F.col("entity") == table) & F.col("__folder").isin([f.name for f in folders]))
                               .drop("entity"), ["Id"]).drop("__updated_at")

    st = {(r.table_name, r.attempt): r.status
          for r in run_ingest(spark, files, state, f"{root}/t", snapshot, max_retries=1, retry_delay=0).collect()}
    assert st == {("good", 1): "SUCCEEDED", ("bad", 1): "FAILED", ("bad", 2): "FAILED"}
    wm = {r.name: r.value for r in state.current().collect()}
    assert wm == {"good": 300}                     # failed table: no watermark
    assert SnapshotTable(spark, f"{root}/t/good").read().count() == 1
    # next run: the failed table is retried from scratch, the loaded one is skipped
    fail.clear()
    st2 = {r.table_name: r.status for r in run_ingest(spark, files, state, f"{root}/t", snapshot).collect()}
    assert st2 == {"good": "SKIPPED", "bad": "SUCCEEDED"}


def test_failed_table_holds_the_folder_watermark_back(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = spark.createDataFrame([(i, t(i), t(1), False, float(i), f"2024-01-0{i}", e)
                                  for i in (1, 2) for e in ("good", "bad")], SCHEMA)
    files = rows.select(F.col("__folder").alias("folder"), "entity", F.lit("p").alias("path"),
                        (F.col("v") * 100).cast("long").alias("modified"))
    root = scratch_path(spark, "job")
    state = StateTable(spark, f"{root}/state")
    fail = {"bad"}

    def snapshot(table, folders):
        if table in fail:
            raise RuntimeError("source unreadable " * 100)
        return source_snapshot(rows.where((F.col("entity") == table) & F.col("__folder").isin([f.name for f in folders]))
                               .drop("entity"), ["Id"]).drop("__updated_at")

    def run(current):
        out = run_ingest(spark, files, state, f"{root}/t", snapshot, current_folder=current).collect()
        watermark = [r.text for r in state.current().collect() if r.name == "last_folder"]
        return {r.table_name: r.status for r in out}, watermark, {r.table_name: r.message for r in out}

    status, watermark, message = run("2024-01-02")
    assert status == {"good": "SUCCEEDED", "bad": "FAILED"} and watermark == [] and len(message["bad"]) > 1000
    fail.clear()
    status, watermark, _ = run("2024-01-02")
    assert status == {"good": "SKIPPED", "bad": "SUCCEEDED"} and watermark == ["2024-01-02"]
    status, watermark, _ = run("2024-01-03")
    assert status == {"good": "SUCCEEDED", "bad": "SUCCEEDED"} and watermark == ["2024-01-03"]
    assert SnapshotTable(spark, f"{root}/t/bad").read().count() == 2
    assert run("2024-01-04")[0] == {}  # nothing is planned again


def test_crash_between_data_and_state_is_not_applied_twice(spark):
    rows = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), False, 1.0, "f1", "t")], SCHEMA)
    files = rows.select(F.col("__folder").alias("folder"), "entity", F.lit("p").alias("path"), F.lit(5).alias("modified"))
    root = scratch_path(spark, "job")

    class Dying(StateTable):
        def append(self, rows):
            raise OSError("driver lost")

    snapshot = lambda table, folders: source_snapshot(rows.drop("entity"), ["Id"]).drop("__updated_at")
    try:
        run_ingest(spark, files, Dying(spark, f"{root}/state"), f"{root}/t", snapshot)
    except OSError:
        pass
    st = run_ingest(spark, files, StateTable(spark, f"{root}/state"), f"{root}/t", snapshot).collect()
    assert [r.status for r in st] == ["SKIPPED"] and SnapshotTable(spark, f"{root}/t/t").read().count() == 1


def test_lines_that_do_not_parse_and_rows_without_a_key_go_to_a_side_table(spark, tmp_path):
    import json

    fields = [("Id", "int"), ("SinkModifiedOn", "timestamp_ntz"), ("createdon", "timestamp_ntz"), ("IsDelete", "boolean"), ("v", "double")]
    lines = {"2024-01-01T00.00.00Z": ["1,2024-01-01T00:00:00,2024-01-01T00:00:00,false,1.5", "x,2024-01-01T00:00:00,2024-01-01T00:00:00,false,1.5",
                                      "2,2024-01-01T00:00:00,2024-01-01T00:00:00,false", ",2024-01-01T00:00:00,2024-01-01T00:00:00,false,3.5"],
             "2024-01-02T00.00.00Z": ["1,2024-01-02T00:00:00,2024-01-01T00:00:00,false,oops", "3,2024-01-02T00:00:00,2024-01-01T00:00:00,false,"]}
    for folder, rows in lines.items():
        (tmp_path / "changes" / folder / "t").mkdir(parents=True)
        (tmp_path / "changes" / folder / "t" / "a.csv").write_text("\n".join([",".join(n for n, _ in fields), *rows]) + "\n")
        (tmp_path / "changes" / folder / "model.json").write_text(json.dumps(
            {"entities": [{"name": "t", "attributes": [{"name": n, "dataType": k} for n, k in fields]}]}))
    state = StateTable(spark, f"{tmp_path}/state")
    status = ingest_folders(spark, str(tmp_path / "changes"), state, f"{tmp_path}/tables", current_folder="9999").collect()
    assert [(r.status, r.rejected) for r in status] == [("SUCCEEDED", 4)], status
    table = SnapshotTable(spark, f"{tmp_path}/tables/t").read()
    assert sorted((r.Id, r.v) for r in table.collect()) == [(1, 1.5), (3, None)]  # the older row 1 stays, it was not overwritten by nulls
    assert "__line" not in table.columns
    bad = spark.read.schema(REJECTED_SCHEMA).parquet(f"{tmp_path}/tables/t/rejected/*").collect()
    assert sorted((r.folder[:10], r.reason) for r in bad) == [
        ("2024-01-01", "no key"), ("2024-01-01", "unparsable"), ("2024-01-01", "unparsable"), ("2024-01-02", "unparsable")]
    texts = {r.text for r in bad if r.reason == "unparsable"}
    assert texts == {lines["2024-01-01T00.00.00Z"][1], lines["2024-01-01T00.00.00Z"][2], lines["2024-01-02T00.00.00Z"][0]}
    assert all(r.file.endswith("/t/a.csv") for r in bad)
