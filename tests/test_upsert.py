"""Soft-delete upsert truth table, schema evolution and idempotent replay."""

import datetime as dt

from pyspark.sql import functions as F

from tessellate.operators.increment import upsert_soft_delete
from tessellate.session import scratch_path
from tessellate.sources.snapshot_table import SnapshotTable, apply_upsert, first_load

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def frames(spark):
    target = spark.createDataFrame([
        (1, "a", 10, False, T0), (2, "b", 20, False, T0), (3, "c", 30, False, T0),
        (4, "d", 40, False, T0), (None, "n", 50, False, T0)],
        "Id int, name string, keep int, IsDelete boolean, __updated_at timestamp_ntz")
    source = spark.createDataFrame([
        (1, "A", "x", True, T1),      # matched, delete -> only flag + time
        (2, "B", "y", False, T1),     # matched, update all
        (3, "C", "z", None, T1),      # matched, null flag -> update all
        (9, "I", "w", False, T1),     # new -> insert
        (None, "N", "v", False, T1)],  # null key never matches -> insert
        "Id int, name string, extra string, IsDelete boolean, __updated_at timestamp_ntz")
    return target, source


def test_truth_table(spark):
    t, s = frames(spark)
    got = {(r.Id, r.name): r.asDict() for r in upsert_soft_delete(t, s, ["Id"]).collect()}
    assert got[(1, "a")] == {"Id": 1, "name": "a", "keep": 10, "IsDelete": True, "__updated_at": T1,
                             "extra": None}
    assert got[(2, "B")] == {"Id": 2, "name": "B", "keep": 20, "IsDelete": False, "__updated_at": T1,
                             "extra": "y"}
    assert got[(3, "C")]["IsDelete"] is None and got[(3, "C")]["keep"] == 30
    assert got[(4, "d")]["extra"] is None and got[(4, "d")]["__updated_at"] == T0
    assert got[(9, "I")]["keep"] is None and got[(9, "I")]["extra"] == "w"
    assert (None, "n") in got and (None, "N") in got
    assert len(got) == 7


def test_replay_is_idempotent_except_nulls(spark):
    t, s = frames(spark)
    once = upsert_soft_delete(t, s, ["Id"])
    twice = upsert_soft_delete(once, s, ["Id"])
    a = sorted((r.Id, r.name, r.IsDelete) for r in once.collect() if r.Id is not None)
    b = sorted((r.Id, r.name, r.IsDelete) for r in twice.collect() if r.Id is not None)
    assert a == b
    # null keys never match, so a replay inserts them again (same as a merge)
    assert twice.where("Id IS NULL").count() == once.where("Id IS NULL").count() + 1


def test_rows_move_between_partitions(spark):
    root = scratch_path(spark, "pt-test")
    t = spark.createDataFrame([(1, "a", 2020, False), (2, "b", 2021, False)],
                              "Id int, name string, PartitionId int, IsDelete boolean")
    table = first_load(spark, root, t)
    # row 2 moves from 2021 to 2022; 2021 becomes empty
    s = spark.createDataFrame([(2, "b2", 2022, False)], "Id int, name string, PartitionId int, IsDelete boolean")
    apply_upsert(table, s, lambda a, b: upsert_soft_delete(a, b, ["Id"]))
    rows = sorted((r.Id, r.name, r.PartitionId) for r in SnapshotTable(spark, root).read().collect())
    assert rows == [(1, "a", 2020), (2, "b2", 2022)]


UPSERT = "Id int, name string, PartitionId int, IsDelete boolean"


def merge(a, b):
    return upsert_soft_delete(a, b, ["Id"])


def ids(table):
    return sorted((r.Id or 0, r.name) for r in table.read().collect())


def test_replay_after_a_crash_leaves_nothing_twice(spark):
    root = scratch_path(spark, "st")
    table = first_load(spark, root, spark.createDataFrame([(1, "a", 2020, False)], UPSERT))
    s = spark.createDataFrame([(2, "b", 2020, False), (None, "n", 2020, False)], UPSERT)
    # the data are written, the job dies before the state row
    merge(table.read(), s).write.partitionBy("PartitionId").parquet(f"{root}/snapshots/half")
    assert ids(table) == [(1, "a")]
    apply_upsert(table, s, merge, {"batch": 7})
    assert ids(table) == [(0, "n"), (1, "a"), (2, "b")] and table.applied("batch") == 7


def test_null_partition_added_column_and_empty_table(spark):
    root = scratch_path(spark, "st")
    table = first_load(spark, root, spark.createDataFrame([(1, "a", None, False), (2, "b", 2021, False)], UPSERT))
    assert ids(table) == [(1, "a"), (2, "b")]
    s = spark.createDataFrame([(1, "A", None, False, "x")], UPSERT + ", extra string")
    apply_upsert(table, s, merge)
    assert {r.Id: (r.extra, r.PartitionId) for r in table.read().collect()} == {1: ("x", None), 2: (None, 2021)}
    table.publish(table.read().limit(0))
    assert table.read().count() == 0 and "extra" in table.read().columns


def test_first_load_replaces_the_table(spark):
    root = scratch_path(spark, "st")
    first_load(spark, root, spark.createDataFrame([(1, "a", 2020, False), (2, "b", 2021, False)], UPSERT))
    table = first_load(spark, root, spark.createDataFrame([(2, "b", 2022, False)], UPSERT))
    assert [(r.Id, r.PartitionId) for r in table.read().collect()] == [(2, 2022)]


def files_of(table):
    return {r.p for r in table.read().select(F.input_file_name().alias("p")).distinct().collect()}


def test_only_touched_partitions_are_written(spark):
    root = scratch_path(spark, "pt-touched")
    rows = [(1, "a", 2020, False), (2, "b", 2021, False), (3, "c", 2022, False), (4, "d", None, False), (5, "e", 2023, False)]
    table = first_load(spark, root, spark.createDataFrame(rows, UPSERT))
    before = files_of(table)
    # 2 moves from 2021 to 2022, 5 is deleted in place, 6 opens a partition, a null key is inserted into 2022
    source = spark.createDataFrame([(2, "B", 2022, False), (5, "x", 2030, True), (6, "f", 2024, False), (None, "n", 2022, False)], UPSERT)
    whole = first_load(spark, scratch_path(spark, "pt-whole"), spark.createDataFrame(rows, UPSERT))
    apply_upsert(table, source, merge, {"m": 3}, keys=["Id"])
    apply_upsert(whole, source, merge)
    plain = lambda t: sorted(tuple(str(x) for x in r) for r in t.read().collect())
    assert plain(table) == plain(whole) and table.applied("m") == 3
    kept = files_of(table) & before
    assert {p.split("/")[-2] for p in kept} == {"PartitionId=2020", "PartitionId=__HIVE_DEFAULT_PARTITION__"}
    # the null partition is found by its key and by the rows it receives
    apply_upsert(table, spark.createDataFrame([(4, "D", 2020, False), (7, "g", None, None)], UPSERT), merge, keys=["Id"])
    got = {r.Id: (r.name, r.PartitionId) for r in table.read().collect()}
    assert got[4] == ("D", 2020) and got[7] == ("g", None) and got[1] == ("a", 2020)


def test_kept_partitions_lack_new_columns_and_changed_types_rewrite_all(spark):
    table = first_load(spark, scratch_path(spark, "pt-wide"), spark.createDataFrame(
        [(1, "a", 2020, False), (2, "b", 2021, False)], UPSERT))
    before = files_of(table)
    apply_upsert(table, spark.createDataFrame([(2, "B", 2021, False, "x")], UPSERT + ", extra string"), merge, keys=["Id"])
    assert {r.Id: r.extra for r in table.read().collect()} == {1: None, 2: "x"} and len(files_of(table) & before) == 1
    widened = "Id int, name string, PartitionId int, IsDelete boolean, extra string"
    as_text = lambda a, b: merge(a, b).withColumn("Id", F.col("Id").cast("string"))
    apply_upsert(table, spark.createDataFrame([(2, "C", 2021, False, "y")], widened), as_text, keys=["Id"])
    assert {r.Id: r.name for r in table.read().collect()} == {"1": "a", "2": "C"} and not files_of(table) & before


def test_partitions_of_any_text_and_empty_loads(spark):
    schema = "Id int, name string, part string, IsDelete boolean"
    names = ["a/b", "c=d e", "50%", "ä+1", None]
    table = first_load(spark, scratch_path(spark, "pt-text"), spark.createDataFrame(
        [(i, "old", p, False) for i, p in enumerate(names)], schema), "part")
    for i, p in enumerate(names):
        before = files_of(table)
        apply_upsert(table, spark.createDataFrame([(i, "new", p, False)], schema), merge, keys=["Id"])
        assert len(files_of(table) & before) == len(names) - 1
    assert sorted((r.Id, r.name, r.part) for r in table.read().collect()) == [(i, "new", p) for i, p in enumerate(names)]
    before = files_of(table)
    apply_upsert(table, spark.createDataFrame([], schema), merge, keys=["Id"])
    assert files_of(table) == before
    none = first_load(spark, scratch_path(spark, "pt-none"), spark.createDataFrame([], UPSERT))
    assert none.read().count() == 0
    apply_upsert(none, spark.createDataFrame([(1, "a", 2020, False)], UPSERT), merge, keys=["Id"])
    assert ids(none) == [(1, "a")]
