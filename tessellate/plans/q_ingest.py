"""Queries: sources/sinks, incremental load, upsert, state, stream (IO, J8, L, S1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import epoch_seconds
from ..operators.ingest_job import CSV_TIMES, ingest_folders
from ..operators.increment import attempt_rollup, load_plan, source_snapshot, upsert_soft_delete
from ..operators.dedup import latest_by
from ..session import scratch_path
from ..sources import files as io
from ..sources.snapshot_table import SnapshotTable, apply_upsert, first_load
from ..sources.sinks import write_csv, write_parquet, write_partitioned_overwrite
from ..sources.state import latest_state
from ..sources.tables import Tables
from ..streaming.upsert_stream import run_stream_upsert
from .registry import query, rounded

FOLDER_FMT = "yyyy-MM-dd'T'HH.mm.ss'Z'"
FOLDER_SQL = "strftime(date_trunc('day', ts), '%Y-%m-%dT%H.%M.%SZ')"


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return io.read_parquet(spark, Tables(spark, sf_dir).path("orders"))


@query("csv_roundtrip", "SELECT * FROM nation")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(Tables(spark, sf_dir).nation, path)
    return io.read_csv(spark, path, infer=True)


@query("read_many", "SELECT * FROM orders")
def read_many(spark, sf_dir):
    root = scratch_path(spark, "many")
    o = Tables(spark, sf_dir).orders
    for part in range(3):
        write_parquet(o.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == part), f"{root}/part_{part}", "overwrite")
    return io.read_many(spark, root, "parquet", glob="*.parquet")


@query("append_union", "SELECT * FROM orders")
def append_union(spark, sf_dir):
    path = scratch_path(spark, "append")
    o = Tables(spark, sf_dir).orders
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    write_parquet(o.where(first), path, "overwrite")
    write_parquet(o.where(~first), path, "append")
    return io.read_parquet(spark, path)


@query("json_explode", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract(props, '$.missing') AS INTEGER) AS missing FROM events""")
def json_explode(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    p = F.from_json("props", "k int, missing int")
    return e.select("event_id", p["k"].alias("k"), p["missing"].alias("missing"))


@query("split_explode", """
SELECT p_partkey, trim(t) AS token FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS t FROM part) x
WHERE trim(t) <> ''""")
def split_explode(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return (p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("t"))
            .select("p_partkey", F.trim("t").alias("token")).where(F.col("token") != ""))


@query("range_cross", """
SELECT count(*) AS n_first FROM (
  SELECT o_orderkey, d, row_number() OVER (PARTITION BY o_orderkey ORDER BY d) AS rn
  FROM orders, (VALUES (DATE '2024-01-01'), (DATE '2024-01-02'), (DATE '2024-01-03')) v(d)) t
WHERE rn = 1 AND d = DATE '2024-01-01'""")
def range_cross(spark, sf_dir):
    """Each order key repeated on three update dates; keep the earliest row per
    key with a total order, then count rows on the first date (= every key)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    days = F.array(*[F.to_date(F.lit(d)) for d in ("2024-01-01", "2024-01-02", "2024-01-03")])
    rows = o.select("o_orderkey", F.explode(days).alias("d"))
    from ..operators.dedup import earliest_by
    first = earliest_by(rows, ["o_orderkey"], ["d"])
    return first.where(F.col("d") == F.to_date(F.lit("2024-01-01"))).agg(F.count(F.lit(1)).alias("n_first"))


# ------------------------------------------------------------- work planning
# Stand-in state (table -> last watermark) and manifest entities.
STATE_ROWS = [("click", "2024-01-15 00:00:00"), ("view", "2024-01-31 00:00:00")]
MANIFEST = ["click", "view", "purchase", "signup"]


def event_files(spark, sf_dir):
    """Events as a change-folder listing: folder = day, entity = event type,
    modified = epoch seconds of the latest event of that (day, type)."""
    e = Tables(spark, sf_dir).events
    return e.select(F.date_format(F.date_trunc("day", "ts"), FOLDER_FMT).alias("folder"),
                    F.col("event_type").alias("entity"),
                    F.concat_ws("/", F.date_format(F.date_trunc("day", "ts"), FOLDER_FMT), "event_type").alias("path"),
                    epoch_seconds("ts").alias("modified"))


PLAN_SQL = f"""
WITH files AS (SELECT {FOLDER_SQL} AS folder, event_type AS entity,
                      {FOLDER_SQL} || '/' || event_type AS path, CAST(floor(epoch(ts)) AS BIGINT) AS modified FROM events),
f AS (SELECT * FROM files WHERE folder >= '2024-01-03T00.00.00Z' AND folder < '2024-01-28T00.00.00Z'
        AND entity IN ({', '.join(repr(m) for m in MANIFEST)})),
pf AS (SELECT entity, folder, max(modified) AS mlm FROM f GROUP BY 1, 2),
pt AS (SELECT entity AS table_name, list(folder ORDER BY folder) AS names, list(mlm ORDER BY folder) AS mods,
              max(mlm) AS new_watermark FROM pf GROUP BY 1),
st AS (SELECT t AS table_name, CAST(epoch(CAST(w AS TIMESTAMP)) AS BIGINT) AS wm
       FROM (VALUES {', '.join(f"('{t}', '{w}')" for t, w in STATE_ROWS)}) v(t, w)),
j AS (SELECT pt.*, st.wm FROM pt LEFT JOIN st USING (table_name))
SELECT table_name,
       CAST(CASE WHEN wm IS NULL THEN len(names) ELSE len(list_filter(mods, lambda m: m > wm)) END AS INTEGER) AS n_folders,
       new_watermark, coalesce(wm, 0) AS last_watermark, wm IS NOT NULL AS is_exists,
       new_watermark > coalesce(wm, 0) AS has_data, wm IS NULL AS is_first_load
FROM j"""


@query("load_plan", PLAN_SQL)
def q_load_plan(spark, sf_dir):
    files = event_files(spark, sf_dir)
    state = spark.createDataFrame(STATE_ROWS, "table_name string, w string").select(
        "table_name", epoch_seconds(F.to_timestamp_ntz("w")).alias("last_watermark"))
    manifest = files.select("folder", "entity").where(F.col("entity").isin(*MANIFEST))
    plan = load_plan(files, state, manifest, last_folder="2024-01-03T00.00.00Z",
                     current_folder="2024-01-28T00.00.00Z")
    return plan.select("table_name", F.size("folders").alias("n_folders"), "new_watermark",
                       "last_watermark", "is_exists", "has_data", "is_first_load")


@query("hash_sharded_plan", PLAN_SQL.replace(
    "AND entity IN (", "AND CAST(('0x' || md5(entity))::UHUGEINT % 3 AS BIGINT) = 1 AND entity IN ("))
def q_hash_sharded_plan(spark, sf_dir):
    files = event_files(spark, sf_dir)
    state = spark.createDataFrame(STATE_ROWS, "table_name string, w string").select(
        "table_name", epoch_seconds(F.to_timestamp_ntz("w")).alias("last_watermark"))
    manifest = files.select("folder", "entity").where(F.col("entity").isin(*MANIFEST))
    plan = load_plan(files, state, manifest, num_shards=3, shard=1,
                     last_folder="2024-01-03T00.00.00Z", current_folder="2024-01-28T00.00.00Z")
    return plan.select("table_name", F.size("folders").alias("n_folders"), "new_watermark",
                       "last_watermark", "is_exists", "has_data", "is_first_load")


# ------------------------------------------------------------ entity changes
ENTITY_COLS = ["Id", "SinkModifiedOn", "createdon", "IsDelete", "value", "event_type", "event_id"]


def entity_rows(spark, sf_dir):
    """Events as change rows of an entity keyed by user (Id)."""
    e = Tables(spark, sf_dir).events
    return e.select(F.col("user_id").alias("Id"), F.col("ts").alias("SinkModifiedOn"),
                    F.col("ts").alias("createdon"), (F.col("event_type") == "error").alias("IsDelete"),
                    "value", "event_type", "event_id",
                    F.date_format(F.date_trunc("day", "ts"), FOLDER_FMT).alias("__folder"))


ENTITY_SQL = f"""
SELECT user_id AS Id, ts AS SinkModifiedOn, ts AS createdon, event_type = 'error' AS IsDelete, value,
       event_type, event_id, {FOLDER_SQL} AS __folder FROM events"""


def snapshot_sql(where: str) -> str:
    return f"""
SELECT Id, SinkModifiedOn, createdon, IsDelete, value, event_type, event_id,
       CAST(year(createdon) AS INTEGER) AS PartitionId, __folder AS __source_folder
FROM (SELECT *, row_number() OVER (PARTITION BY Id ORDER BY SinkModifiedOn DESC, __folder DESC, event_id DESC) AS rn
      FROM ({ENTITY_SQL}) e WHERE {where}) t WHERE rn = 1"""


def _snapshot(df):
    return source_snapshot(df, ["Id"], tie=["event_id"]).drop("__updated_at")


@query("source_snapshot", snapshot_sql("true"))
def q_source_snapshot(spark, sf_dir):
    return rounded(_snapshot(entity_rows(spark, sf_dir)))


SNAP_COLS = ENTITY_COLS + ["PartitionId", "__source_folder"]


def merge_sql(t_sql: str, s_sql: str, t_cols, s_cols, keys=("Id",), delete="IsDelete",
              updated=None) -> str:
    """SQL of the soft-delete merge with schema evolution (mirrors the operator)."""
    cols = list(t_cols) + [c for c in s_cols if c not in t_cols]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    deleted = f"coalesce(t.__t AND s.__s AND s.{delete} IS NOT DISTINCT FROM true, false)"
    out = []
    for c in cols:
        in_t, in_s = c in t_cols, c in s_cols
        if c in keys or (c in (delete, updated) and in_s and in_t):
            e = f"CASE WHEN s.__s THEN s.{c} ELSE t.{c} END"
        elif c in (delete, updated) and in_s:
            e = f"s.{c}"
        elif in_t and in_s:
            e = f"CASE WHEN {deleted} OR s.__s IS NULL THEN t.{c} ELSE s.{c} END"
        elif in_t:
            e = f"CASE WHEN t.__t THEN t.{c} END"
        else:
            e = f"CASE WHEN s.__s AND NOT {deleted} THEN s.{c} END"
        out.append(f"{e} AS {c}")
    return f"""
SELECT {', '.join(out)}
FROM (SELECT *, true AS __t FROM ({t_sql}) x) t FULL OUTER JOIN (SELECT *, true AS __s FROM ({s_sql}) y) s ON {on}"""


SPLIT_TS = "2024-01-16 00:00:00"


@query("apply_increment", merge_sql(snapshot_sql(f"SinkModifiedOn < TIMESTAMP '{SPLIT_TS}'"),
                                    snapshot_sql(f"SinkModifiedOn >= TIMESTAMP '{SPLIT_TS}'"),
                                    SNAP_COLS, SNAP_COLS))
def q_apply_increment(spark, sf_dir):
    """First load of the early changes, then an upsert of the later ones into
    the snapshot table; returns the table as read back."""
    rows = entity_rows(spark, sf_dir)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    t = first_load(spark, scratch_path(spark, "table"), _snapshot(rows.where(F.col("SinkModifiedOn") < split)))
    apply_upsert(t, _snapshot(rows.where(F.col("SinkModifiedOn") >= split)),
                 lambda a, b: upsert_soft_delete(a, b, ["Id"]), keys=["Id"])
    return t.read().select(*SNAP_COLS)


@query("first_load", snapshot_sql("true"))
def q_first_load(spark, sf_dir):
    path = scratch_path(spark, "first")
    write_partitioned_overwrite(_snapshot(entity_rows(spark, sf_dir)), path, ["PartitionId"])
    return spark.read.parquet(path).select(*SNAP_COLS)


STREAM_SCHEMA = ("Id bigint, SinkModifiedOn timestamp_ntz, createdon timestamp_ntz, IsDelete boolean, "
                 "value double, event_type string, event_id bigint, __folder string")


@query("stream_upsert", merge_sql(snapshot_sql(f"SinkModifiedOn < TIMESTAMP '{SPLIT_TS}'"),
                                  snapshot_sql(f"SinkModifiedOn >= TIMESTAMP '{SPLIT_TS}'"),
                                  SNAP_COLS, SNAP_COLS))
def q_stream_upsert(spark, sf_dir):
    """Change folders arrive in two waves; the same stream (one checkpoint)
    first creates the table, then merges only the new files."""
    root = scratch_path(spark, "stream")
    src, table, ckpt = f"{root}/in", f"{root}/table", f"{root}/ckpt"
    rows = entity_rows(spark, sf_dir)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    prep = lambda b: _snapshot(b)
    write_parquet(rows.where(F.col("SinkModifiedOn") < split), f"{src}/wave=1", "overwrite")
    run_stream_upsert(spark, src, STREAM_SCHEMA, table, ckpt, prep)
    write_parquet(rows.where(F.col("SinkModifiedOn") >= split), f"{src}/wave=2", "overwrite")
    run_stream_upsert(spark, src, STREAM_SCHEMA, table, ckpt, prep)
    return SnapshotTable(spark, table).read().select(*SNAP_COLS)


UPSERT_T = """
SELECT o_custkey AS Id, o_totalprice AS amount, o_orderpriority AS priority, false AS IsDelete,
       TIMESTAMP '2000-01-01 00:00:00' AS __updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderdate < '1998-01-01') x WHERE rn = 1"""
UPSERT_S = """
SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS Id,
       o_totalprice AS amount, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS IsDelete,
       TIMESTAMP '2001-01-01 00:00:00' AS __updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderdate >= '1998-01-01') x WHERE rn = 1"""


def _upsert_frames(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    old = latest_by(o.where(F.col("o_orderdate") < "1998-01-01"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    new = latest_by(o.where(F.col("o_orderdate") >= "1998-01-01"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    t = old.select(F.col("o_custkey").alias("Id"), F.col("o_totalprice").alias("amount"),
                   F.col("o_orderpriority").alias("priority"), F.lit(False).alias("IsDelete"),
                   F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("__updated_at"))
    s = new.select(F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), None)
                   .otherwise(F.col("o_custkey")).alias("Id"),
                   F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
                   F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
                   .alias("IsDelete"),
                   F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("__updated_at"))
    return t, s


@query("upsert_soft_delete", merge_sql(UPSERT_T, UPSERT_S, ["Id", "amount", "priority", "IsDelete", "__updated_at"],
                                       ["Id", "amount", "status", "IsDelete", "__updated_at"],
                                       updated="__updated_at"))
def q_upsert_soft_delete(spark, sf_dir):
    t, s = _upsert_frames(spark, sf_dir)
    return upsert_soft_delete(t, s, ["Id"])


UPSERT2_T = UPSERT_T.replace("o_totalprice AS amount,", "o_totalprice AS amount, o_orderstatus AS grp,")
UPSERT2_S = UPSERT_S.replace("o_totalprice AS amount,", "o_totalprice AS amount, o_orderstatus AS grp,")


@query("upsert_two_key", merge_sql(UPSERT2_T, UPSERT2_S,
                                   ["Id", "amount", "grp", "priority", "IsDelete", "__updated_at"],
                                   ["Id", "amount", "grp", "status", "IsDelete", "__updated_at"],
                                   keys=("Id", "grp"), updated="__updated_at"))
def q_upsert_two_key(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t, s = _upsert_frames(spark, sf_dir)
    old = latest_by(o.where(F.col("o_orderdate") < "1998-01-01"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    new = latest_by(o.where(F.col("o_orderdate") >= "1998-01-01"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    t = t.join(old.select(F.col("o_custkey").alias("Id"), F.col("o_orderstatus").alias("grp")), "Id") \
         .select("Id", "amount", "grp", "priority", "IsDelete", "__updated_at")
    s2 = new.select(F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), None)
                    .otherwise(F.col("o_custkey")).alias("Id"), F.col("o_totalprice").alias("amount"),
                    F.col("o_orderstatus").alias("grp"), F.col("o_orderstatus").alias("status"),
                    F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
                    .alias("IsDelete"),
                    F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("__updated_at"))
    return upsert_soft_delete(t, s2, ["Id", "grp"])


@query("latest_state", """
SELECT user_id AS name, arg_max(value, (ts, event_id)) AS value, max(ts) AS at FROM events GROUP BY 1""")
def q_latest_state(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(F.col("user_id").alias("name"), "value",
                                            F.col("ts").alias("at"), "event_id")
    return latest_state(e, tie=["event_id"])


@query("attempt_rollup", """
WITH a AS (SELECT user_id, event_type AS status, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events)
SELECT user_id, count(*) AS attempts, CAST(max(attempt) AS INTEGER) AS last_attempt,
       arg_max(status, attempt) AS final_status, min(ts) AS first_start, max(ts) AS last_end
FROM a GROUP BY 1""")
def q_attempt_rollup(spark, sf_dir):
    from pyspark.sql import Window
    e = Tables(spark, sf_dir).events
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    a = e.select("user_id", F.col("event_type").alias("status"), F.col("ts").alias("start_time"),
                 F.col("ts").alias("end_time"), F.row_number().over(w).alias("attempt"))
    return attempt_rollup(a, "user_id", "attempt")


# ------------------------------------------------- change folders on storage
def write_change_folders(spark, sf_dir, root):
    """Lay out events as change folders: ``root/<day folder>/<event type>/*.csv``
    plus a ``model.json`` manifest per folder listing its entities."""
    e = entity_rows(spark, sf_dir).select("__folder", "event_type", "Id", "SinkModifiedOn", "IsDelete", "value")
    (e.write.mode("overwrite").partitionBy("__folder", "event_type").option("header", True).csv(f"{root}/data"))
    manifest = (e.groupBy("__folder").agg(F.sort_array(F.collect_set(F.struct(F.col("event_type").alias("name"))))
                                          .alias("entities")))
    manifest.write.mode("overwrite").partitionBy("__folder").json(f"{root}/manifest")
    log = e.select("__folder").distinct().agg(F.concat_ws(",", F.sort_array(F.collect_list("__folder"))).alias("value"))
    log.write.mode("overwrite").text(f"{root}/changelog")
    return root


ENTITY_CSV_SCHEMA = "Id bigint, SinkModifiedOn timestamp_ntz, IsDelete boolean, value double"


@query("manifest_scan", f"""
SELECT event_type AS entity, count(*) AS n_rows, count(DISTINCT {FOLDER_SQL}) AS n_folders
FROM events GROUP BY 1""")
def q_manifest_scan(spark, sf_dir):
    """Entities come from the folders' manifests; every (folder, entity) CSV
    is read in one permissive multi-path scan with an explicit schema, and
    the file listing supplies folder and modification time per row."""
    root = write_change_folders(spark, sf_dir, scratch_path(spark, "cdm"))
    entities = io.read_manifest_entities(spark, f"{root}/manifest")
    wanted = entities.select("entity").distinct()
    data = io.read_csv(spark, f"{root}/data", schema=ENTITY_CSV_SCHEMA + ", __folder string, event_type string",
                       mode="PERMISSIVE")
    files = io.with_file_info(data).select(F.col("event_type").alias("entity"), "__folder", "_file_modified")
    rows = files.join(wanted, "entity", "left_semi")
    return rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.count_distinct("__folder").alias("n_folders"))


@query("change_log_folders", f"""
SELECT DISTINCT {FOLDER_SQL} AS folder FROM events
WHERE {FOLDER_SQL} >= '2024-01-10T00.00.00Z' AND {FOLDER_SQL} < '2024-01-20T00.00.00Z'""")
def q_change_log_folders(spark, sf_dir):
    """Folder list from the comma-separated change log, then last <= f < current."""
    from ..operators.increment import folder_range
    root = write_change_folders(spark, sf_dir, scratch_path(spark, "cdm"))
    folders = io.read_change_log(spark, f"{root}/changelog")
    return folder_range(folders, "2024-01-10T00.00.00Z", "2024-01-20T00.00.00Z").distinct()


AUDIT_AT = "2024-01-31 12:00:00"


@query("audit_log", PLAN_SQL.replace(
    "SELECT table_name,\n       CAST(CASE",
    "SELECT table_name, 20240131 AS _datekey, 202401 AS _monthkey, true AS secret_masked,\n       CAST(CASE"))
def q_audit_log(spark, sf_dir):
    """Work plan rows appended as JSON under _yearkey/_monthkey/_datekey with
    the secret column replaced, then read back."""
    from ..sources.sinks import write_audit_log
    plan = q_load_plan(spark, sf_dir)
    rows = plan.select("*", F.lit("app-key-value").alias("app_key"),
                       F.lit(AUDIT_AT).cast("timestamp_ntz").alias("job_time"))
    root = scratch_path(spark, "audit")
    write_audit_log(rows, root, "job_time", secret_cols=("app_key",))
    back = spark.read.json(root)
    return back.select("table_name", F.col("_datekey").cast("int").alias("_datekey"),
                       F.col("_monthkey").cast("int").alias("_monthkey"),
                       (F.col("app_key") != "app-key-value").alias("secret_masked"),
                       F.col("n_folders").cast("int").alias("n_folders"), "new_watermark", "last_watermark",
                       "is_exists", "has_data", "is_first_load")


# The first wave of change folders has no value column, the second one does.
JOB_COLS = ["Id", "SinkModifiedOn", "createdon", "IsDelete", "event_id"]


def _job_sql() -> str:
    """Both waves of every entity, deduplicated and merged; one statement for all entities."""
    wave = f"""
SELECT *, row_number() OVER (PARTITION BY event_type, Id ORDER BY SinkModifiedOn DESC, __folder DESC, event_id DESC) AS rn
FROM ({ENTITY_SQL}) e WHERE SinkModifiedOn"""
    merged = merge_sql(
        f"SELECT event_type, {', '.join(JOB_COLS)} FROM ({wave} < TIMESTAMP '{SPLIT_TS}') x WHERE rn = 1",
        f"SELECT event_type, {', '.join(JOB_COLS)}, value FROM ({wave} >= TIMESTAMP '{SPLIT_TS}') x WHERE rn = 1",
        ["event_type", *JOB_COLS], ["event_type", *JOB_COLS, "value"], keys=("event_type", "Id"))
    return f"""
WITH runs AS (SELECT event_type, bool_or(ts < TIMESTAMP '{SPLIT_TS}') AS early, bool_or(ts >= TIMESTAMP '{SPLIT_TS}') AS late
              FROM events GROUP BY 1)
SELECT m.*, runs.early, runs.late FROM ({merged}) m JOIN runs ON m.event_type = runs.event_type"""


def write_wave(spark, rows, root, columns, kinds=None):
    """Rows as change folders: ``<folder>/<entity>/*.csv`` and ``<folder>/model.json``.
    ``kinds``: types that the manifest names instead of those of the rows."""
    stage = scratch_path(spark, "wave")
    kinds = dict(rows.dtypes) | (kinds or {})
    (rows.select("__folder", "event_type", *columns).write.partitionBy("__folder", "event_type").option("header", True)
     .option("timestampNTZFormat", CSV_TIMES).csv(stage))
    attributes = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(kinds[c]).alias("dataType")) for c in columns])
    names = rows.select("__folder", "event_type").distinct().groupBy("__folder").agg(
        F.sort_array(F.collect_set("event_type")).alias("names")).collect()  # one row per folder
    manifests = spark.createDataFrame(names, "folder string, names array<string>").select(
        "folder", F.transform("names", lambda n: F.struct(n.alias("name"), attributes.alias("attributes"))).alias("entities"))
    manifests.write.partitionBy("folder").json(f"{stage}-manifests")
    # give the folders the layout in which change exports arrive
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in names:
        fs.mkdirs(path(f"{root}/{r['__folder']}"))
        for n in r["names"]:
            fs.rename(path(f"{stage}/__folder={r['__folder']}/event_type={n}"), path(f"{root}/{r['__folder']}/{n}"))
        part = [f.getPath() for f in fs.listStatus(path(f"{stage}-manifests/folder={r['__folder']}"))][0]
        fs.rename(part, path(f"{root}/{r['__folder']}/model.json"))


@query("ingest_job", _job_sql())
def q_ingest_job(spark, sf_dir):
    """Two runs of the whole job over change folders on storage: the first run
    loads every table, the second merges the newer folders, which have one
    more column, into them. Returns all tables as read back, with whether
    each run loaded them."""
    from ..operators.reshape import union_by_name
    from ..sources.state import StateTable
    root = scratch_path(spark, "ingest")
    rows = entity_rows(spark, sf_dir)
    late = F.col("SinkModifiedOn") >= F.lit(SPLIT_TS).cast("timestamp_ntz")
    state = StateTable(spark, f"{root}/state")
    ran = []
    for wave, columns, bound in ((~late, JOB_COLS, "2024-01-16"), (late, [*JOB_COLS, "value"], "9999")):
        write_wave(spark, rows.where(wave), f"{root}/changes", columns)
        status = ingest_folders(spark, f"{root}/changes", state, f"{root}/tables", tie=("event_id",), current_folder=bound)
        ran.append({r.table_name for r in status.collect() if r.status == "SUCCEEDED"})
    tables = [SnapshotTable(spark, f"{root}/tables/{t}").read()
              .select(F.lit(t).alias("event_type"), "*", F.lit(t in ran[0]).alias("early"), F.lit(t in ran[1]).alias("late"))
              for t in sorted(ran[0] | ran[1])]
    return union_by_name(tables).select("event_type", *JOB_COLS, "value", "early", "late")


@query("ingest_quarantine", f"""
SELECT event_type AS entity, {FOLDER_SQL} AS folder, CASE event_id % 10 WHEN 3 THEN 'unparsable' ELSE 'no key' END AS reason,
       count(*) AS n_rows
FROM events WHERE event_id % 10 IN (3, 7) GROUP BY ALL
UNION ALL
SELECT event_type, NULL, 'in the table', count(DISTINCT user_id) FROM events WHERE event_id % 10 NOT IN (3, 7) GROUP BY 1""")
def q_ingest_quarantine(spark, sf_dir):
    """The whole job over change folders with broken lines: in every tenth row a value
    that is no number, in another tenth no key. Returns what was rejected by
    folder and reason, and the number of rows of the tables."""
    from ..operators.ingest_job import REJECTED_SCHEMA
    from ..operators.reshape import union_by_name
    from ..sources.state import StateTable
    root = scratch_path(spark, "quarantine")
    rows = entity_rows(spark, sf_dir)
    digit = F.col("event_id") % 10
    broken = (rows.withColumn("value", F.when(digit == 3, "n/a").otherwise(F.coalesce(F.col("value").cast("string"), F.lit(""))))
              .withColumn("Id", F.when(digit != 7, F.col("Id"))))
    write_wave(spark, broken, f"{root}/changes", [*JOB_COLS, "value"], {"value": "double"})
    status = ingest_folders(spark, f"{root}/changes", StateTable(spark, f"{root}/state"), f"{root}/tables", tie=("event_id",),
                            current_folder="9999")
    entity = F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1).alias("entity")
    count = F.count(F.lit(1)).alias("n_rows")
    rejected = (spark.read.schema(REJECTED_SCHEMA).parquet(f"{root}/tables/*/rejected/*")
                .groupBy(entity, "folder", "reason").agg(count))
    loaded = [SnapshotTable(spark, f"{root}/tables/{r.table_name}").read().agg(count)
              .select(F.lit(r.table_name).alias("entity"), F.lit(None).cast("string").alias("folder"), F.lit("in the table").alias("reason"), "n_rows")
              for r in status.collect()]
    return union_by_name([rejected, *loaded])
