"""Queries: maintenance decisions (T1-T3), nearest station (J10), station series (J11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.geo import nearest_with_data, station_series
from ..operators.maintenance import compact, expired_files, input_bytes, maintenance_candidates
from ..session import scratch_path
from ..sources.files import list_files
from ..sources.sinks import write_parquet
from ..sources.tables import Tables
from .registry import query, rounded


@query("maintenance_candidates", """
WITH h AS (SELECT user_id AS table_name, event_type AS operation, ts AS timestamp,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT table_name, count(*) AS n_merges FROM h
WHERE rn <= 20 AND operation = 'purchase'
  AND timestamp >= CAST(CAST((SELECT max(ts) FROM events) AS DATE) - 1 AS TIMESTAMP)
  AND timestamp <= (SELECT max(ts) FROM events)
GROUP BY 1 HAVING count(*) > 1""")
def q_maintenance_candidates(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    hist = e.select(F.col("user_id").alias("table_name"), F.col("event_type").alias("operation"),
                    F.col("ts").alias("timestamp"), "event_id")
    now = e.agg(F.max("ts")).scalar()  # fixed "now": latest commit in the history
    return maintenance_candidates(hist, now=now, op_value="purchase", tie=["event_id"])


@query("compact_rowset", "SELECT * FROM events")
def q_compact_rowset(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "compact")
    compact(t.events, ["ts"], input_bytes(spark, t.path("events"))).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("retention_anti", """
SELECT o_orderkey, o_orderdate FROM orders o
WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 168 HOUR
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def q_retention_anti(spark, sf_dir):
    """Expired = older than 168 h before the latest entry and no longer
    referenced by the live set (anti join)."""
    t = Tables(spark, sf_dir)
    o = t.orders
    now = o.agg(F.max("o_orderdate")).scalar()
    live = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    old = o.where(F.col("o_orderdate") < now - F.expr("INTERVAL 168 HOURS")).select("o_orderkey", "o_orderdate")
    return old.join(live, "o_orderkey", "left_anti")


@query("expired_files", """
SELECT DISTINCT 'load_1/event_type=' || event_type AS dir FROM events""")
def q_expired_files(spark, sf_dir):
    """Real files of two loads: those of the first, which is no longer live, are past
    their retention eight days from now. Report only."""
    root = scratch_path(spark, "loads")
    for load in ("load_1", "load_2"):
        write_parquet(Tables(spark, sf_dir).events, f"{root}/{load}", partition_by=["event_type"])
    files = list_files(spark, root, "*.parquet")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    live = files.select(folder.alias("dir")).where(F.col("dir").contains("/load_2/")).distinct()
    gone = expired_files(files, live, F.current_timestamp() + F.expr("INTERVAL 8 DAYS"))
    return gone.select(F.regexp_extract("path", r"/(load_\d/[^/]+)/[^/]+$", 1).alias("dir")).distinct()


def _stations(t):
    s = t.supplier
    return s.select(F.col("s_suppkey").alias("st_id"),
                    (F.pmod(F.col("s_suppkey") * 37, F.lit(180)) - 90 + 0.5).cast("double").alias("lat"),
                    (F.pmod(F.col("s_suppkey") * 71, F.lit(360)) - 180 + 0.25).cast("double").alias("lon"),
                    F.when(F.col("s_acctbal") >= 0, F.to_date(F.lit("2024-12-31"))).alias("daily_end"))


def _locations(t):
    n = t.nation
    return n.select(F.col("n_nationkey").alias("loc_id"), (F.col("n_nationkey") * 0.5 + 8.0).alias("lat"),
                    (F.col("n_regionkey") * 1.5 + 102.0).alias("lon"))


HAV_SQL = ("2 * 6371.0088 * asin(sqrt(pow(sin(radians(s.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * "
           "cos(radians(s.lat)) * pow(sin(radians(s.lon - l.lon) / 2), 2)))")
NEAREST_SQL = f"""
st AS (SELECT s_suppkey AS st_id, CAST(((s_suppkey * 37) % 180) - 90 + 0.5 AS DOUBLE) AS lat,
              CAST(((s_suppkey * 71) % 360) - 180 + 0.25 AS DOUBLE) AS lon,
              CASE WHEN s_acctbal >= 0 THEN DATE '2024-12-31' END AS daily_end FROM supplier),
lo AS (SELECT n_nationkey AS loc_id, n_nationkey * 0.5::DOUBLE + 8.0::DOUBLE AS lat,
              n_regionkey * 1.5::DOUBLE + 102.0::DOUBLE AS lon FROM nation),
pr AS (SELECT l.loc_id, s.st_id, s.daily_end, {HAV_SQL} AS distance_km FROM lo l, st s),
rk AS (SELECT *, row_number() OVER (PARTITION BY loc_id ORDER BY distance_km, st_id) AS rank FROM pr),
k5 AS (SELECT * FROM rk WHERE rank <= 5 AND daily_end IS NOT NULL),
best AS (SELECT loc_id, st_id, distance_km, rank FROM (
           SELECT *, row_number() OVER (PARTITION BY loc_id ORDER BY rank) AS r1 FROM k5) x WHERE r1 = 1)"""


@query("nearest_point", f"""
WITH {NEAREST_SQL}
SELECT loc_id, st_id, round(distance_km, 3) + 0.0 AS distance_km, CAST(rank AS INTEGER) AS rank FROM best""")
def q_nearest_point(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = nearest_with_data(_locations(t), _stations(t), k=5)
    return rounded(out, 3)


@query("station_series", f"""
WITH {NEAREST_SQL},
daily AS (SELECT l_suppkey AS st_id, CAST(l_shipdate AS DATE) AS day, count(*) AS n_obs,
                 avg(l_tax) AS tavg FROM lineitem GROUP BY 1, 2)
SELECT b.loc_id, b.st_id, d.day, d.n_obs, round(d.tavg, 6) + 0.0 AS tavg FROM best b JOIN daily d USING (st_id)""")
def q_station_series(spark, sf_dir):
    t = Tables(spark, sf_dir)
    best = nearest_with_data(_locations(t), _stations(t), k=5)
    daily = (t.lineitem.groupBy(F.col("l_suppkey").alias("st_id"), F.to_date("l_shipdate").alias("day"))
             .agg(F.count(F.lit(1)).alias("n_obs"), F.avg("l_tax").alias("tavg")))
    return rounded(station_series(best, daily).select("loc_id", "st_id", "day", "n_obs", "tavg"))
