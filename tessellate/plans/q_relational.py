"""Queries: aggregation, joins, dedup, set and reshape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import week_bucket
from ..operators import aggs, dedup, joins, reshape
from ..operators.quantiles import quantiles
from ..sources.tables import Tables
from . import fixtures as fx
from .registry import fast_round, query, rounded


@query("weekly_sum", f"SELECT l_suppkey, l_returnflag, date, round(qty, 6) + 0.0 AS qty FROM ({fx.P2_SQL}) t")
def weekly_sum(spark, sf_dir):
    return rounded(fx.p2(spark, sf_dir))


@query("weekly_count", fx.P1_SQL)
def weekly_count(spark, sf_dir):
    return fx.p1(spark, sf_dir)


@query("release_min", f"""
SELECT l_suppkey, l_returnflag, min(date) AS release FROM ({fx.P2_SQL}) t
WHERE qty > 0 GROUP BY 1, 2""")
def release_min(spark, sf_dir):
    p = fx.p2(spark, sf_dir)
    return (p.where(F.col("qty") > 0).groupBy("l_suppkey", "l_returnflag")
            .agg(F.min("date").alias("release")))


PRICE_SQL = "l_extendedprice / l_quantity"


@query("price_stats", f"""
SELECT l_suppkey, round(max({PRICE_SQL}), 6) + 0.0 AS price_max, round(min({PRICE_SQL}), 6) + 0.0 AS price_min,
       round(stddev_samp({PRICE_SQL}), 6) + 0.0 AS price_std, round(CAST(sum(CAST(CAST({PRICE_SQL} AS VARCHAR) AS DECIMAL(38,8))) AS DOUBLE) / count({PRICE_SQL}), 6) + 0.0
         AS price_mean,
       count(DISTINCT {PRICE_SQL}) AS price_nunique
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1""")
def price_stats(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(
        "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return rounded(aggs.group_stats(li, ["l_suppkey"], "price", money=True))


@query("value_counts", """
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def value_counts(spark, sf_dir):
    return aggs.value_counts(Tables(spark, sf_dir).orders, "o_orderpriority")


MONTHS_SQL = """
SELECT o_custkey, list_sort(list(DISTINCT date_trunc('month', o_orderdate)::DATE)) AS months,
       max(date_trunc('month', o_orderdate)::DATE) AS max_month
FROM orders GROUP BY 1"""


def _months(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_custkey", F.trunc("o_orderdate", "month").alias("month"))
    return aggs.collect_sorted(o, ["o_custkey"], ["month"], "month", "months")


@query("collect_folders", f"""
SELECT o_custkey, CAST(len(months) AS INTEGER) AS n_months, months[1] AS first_month, max_month
FROM ({MONTHS_SQL}) t""")
def collect_folders(spark, sf_dir):
    m = _months(spark, sf_dir)
    return m.select("o_custkey", F.size("months").alias("n_months"),
                    F.col("months")[0]["month"].alias("first_month"), "max_month")


@query("array_filter", f"""
SELECT o_custkey, CAST(len(list_filter(months, lambda m: m > DATE '1998-01-01')) AS INTEGER) AS n_new,
       list_filter(months, lambda m: m > DATE '1998-01-01')[1] AS first_new
FROM ({MONTHS_SQL}) t""")
def array_filter(spark, sf_dir):
    m = _months(spark, sf_dir)
    kept = aggs.filter_items("months", "month", F.to_date(F.lit("1998-01-01")))
    return m.select("o_custkey", F.size(kept).alias("n_new"), F.get(kept, 0)["month"].alias("first_new"))


@query("global_offset", f"""
WITH t AS (SELECT l_orderkey, l_linenumber,
                  CAST(({fx.week_sql('l_shipdate')} - DATE '1970-01-06') / 7 AS INTEGER) AS wk
           FROM lineitem WHERE l_quantity > 45)
SELECT l_orderkey, l_linenumber, wk - (SELECT min(wk) FROM t) AS week_offset FROM t""")
def global_offset(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.where(F.col("l_quantity") > 45)
    t = li.select("l_orderkey", "l_linenumber",
                  (F.datediff(week_bucket("l_shipdate"), F.lit("1970-01-06")) / 7).cast("int").alias("wk"))
    # global minimum as a scalar subquery: no single-partition window
    return t.select("l_orderkey", "l_linenumber",
                    (F.col("wk") - t.agg(F.min("wk")).scalar()).alias("week_offset"))


STATUS_SQL = ("CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'SKIPPED' "
              "ELSE 'SUCCEEDED' END")


def _status(o):
    return (F.when(F.col("o_orderstatus") == "F", "FAILED")
            .when(F.col("o_orderstatus") == "P", "SKIPPED").otherwise("SUCCEEDED"))


@query("status_summary", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE s = 'FAILED') AS failed,
       count(*) - count(*) FILTER (WHERE s = 'FAILED') AS succeeded,
       count(*) FILTER (WHERE s = 'SKIPPED') AS skipped,
       count(*) - count(*) FILTER (WHERE s = 'FAILED') - count(*) FILTER (WHERE s = 'SKIPPED') AS loaded
FROM (SELECT {STATUS_SQL} AS s FROM orders) t""")
def status_summary(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return aggs.status_summary(o.select(_status(o).alias("status")), "status")


@query("failed_list", """
SELECT o_orderkey, concat(CAST(o_orderkey AS VARCHAR), '=>', CAST(o_custkey AS VARCHAR)) AS dataflow
FROM orders WHERE o_orderstatus = 'F'""")
def failed_list(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.where(_status(o) == "FAILED")
            .select("o_orderkey", F.concat_ws("=>", "o_orderkey", "o_custkey").alias("dataflow")))


@query("quartiles", f"""
WITH s AS (SELECT l_returnflag, l_suppkey, avg(qty) AS score FROM ({fx.P2_SQL}) t GROUP BY 1, 2)
SELECT l_returnflag, round(quantile_cont(score, 0.0), 6) + 0.0 AS q0,
       round(quantile_cont(score, 0.25), 6) + 0.0 AS q1, round(quantile_cont(score, 0.5), 6) + 0.0 AS q2,
       round(quantile_cont(score, 0.75), 6) + 0.0 AS q3, round(quantile_cont(score, 1.0), 6) + 0.0 AS q4
FROM s GROUP BY 1""")
def quartiles(spark, sf_dir):
    scores = (fx.p2(spark, sf_dir).groupBy("l_returnflag", "l_suppkey")
              .agg(F.avg("qty").alias("score")))
    return rounded(aggs.quartiles(scores, ["l_returnflag"], "score"))


@query("quartiles_rows", """
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.0), 6) + 0.0 AS q0,
       round(quantile_cont(l_extendedprice, 0.25), 6) + 0.0 AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) + 0.0 AS q2,
       round(quantile_cont(l_extendedprice, 0.75), 6) + 0.0 AS q3, round(quantile_cont(l_extendedprice, 1.0), 6) + 0.0 AS q4
FROM lineitem GROUP BY 1, 2""")
def quartiles_rows(spark, sf_dir):
    """Quartiles over the fact rows: groups of any size."""
    return rounded(quantiles(Tables(spark, sf_dir).lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice"))


PROFILE_COLS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("column_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"
    for c, t in PROFILE_COLS.items()))
def column_profile(spark, sf_dir):
    return aggs.column_profile(Tables(spark, sf_dir).lineitem, list(PROFILE_COLS))


@query("left_merge", """
SELECT o.o_orderkey, o.custkey, o.amount, c.c_name
FROM (SELECT o_orderkey, o_custkey AS custkey, o_totalprice AS amount FROM orders) o
LEFT JOIN (SELECT c_custkey AS custkey, c_acctbal AS amount, c_name FROM customer) c
  ON o.custkey IS NOT DISTINCT FROM c.custkey""")
def left_merge(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"),
                        F.col("o_totalprice").alias("amount"))
    c = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"), "c_name")
    return joins.left_merge(o, c, ["custkey"])


@query("group_stats_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, round(s.sup_avg_qty, 6) + 0.0 AS sup_avg_qty,
       s.sup_lines
FROM lineitem l LEFT JOIN (SELECT l_suppkey, avg(l_quantity) AS sup_avg_qty, count(*) AS sup_lines
                           FROM lineitem GROUP BY 1) s USING (l_suppkey)""")
def group_stats_join(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    stats = li.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("sup_avg_qty"),
                                        F.count(F.lit(1)).alias("sup_lines"))
    out = joins.attach_group_stats(li.select("l_orderkey", "l_linenumber", "l_suppkey"), stats,
                                   ["l_suppkey"])
    return rounded(out)


@query("semi_history", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_returnflag = 'R' AND l_suppkey IN (SELECT l_suppkey FROM lineitem
                                           WHERE l_shipdate < '1995-03-01')""")
def semi_history(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    hist = li.where(F.col("l_shipdate") < "1995-03-01")
    base = li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.keep_with_history(base, hist, ["l_suppkey"])


GAZ_SQL = """
(SELECT lower(trim(n_name)) AS gkey, n_nationkey * 0.5::DOUBLE + 8.0::DOUBLE AS latitude,
        n_regionkey * 1.5::DOUBLE + 102.0::DOUBLE AS longitude FROM nation
 UNION ALL SELECT '' AS gkey, 14.0583::DOUBLE AS latitude, 108.2772::DOUBLE AS longitude)"""


def _gazetteer(t):
    n = t.nation.select(F.col("n_name").alias("place"),
                        (F.col("n_nationkey") * 0.5 + 8.0).alias("latitude"),
                        (F.col("n_regionkey") * 1.5 + 102.0).alias("longitude"))
    default = t.spark.createDataFrame([("", 14.0583, 108.2772)], "place string, latitude double, longitude double")
    return n.unionByName(default)


@query("gazetteer_lookup", f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '  ' ELSE ' ' || upper(n_name) || ' ' END AS place
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, place, round(latitude, 6) + 0.0 AS latitude, round(longitude, 6) + 0.0 AS longitude,
       concat(CAST(round(latitude, 6) AS VARCHAR), '_', CAST(round(longitude, 6) AS VARCHAR)) AS latitude_longitude
FROM c LEFT JOIN {GAZ_SQL} g
  ON g.gkey = CASE WHEN lower(trim(place)) IS NULL OR lower(trim(place)) = '' THEN '' ELSE lower(trim(place)) END""")
def gazetteer_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.upper("n_name"), F.lit(" "))).alias("place"))
    out = joins.lookup_with_default(c, "place", _gazetteer(t), "place", ["latitude", "longitude"])
    out = rounded(out)
    return out.select("c_custkey", "place", "latitude", "longitude",
                      F.concat_ws("_", F.col("latitude").cast("string"),
                                  F.col("longitude").cast("string")).alias("latitude_longitude"))


EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@query("latest_by", f"""
SELECT {EVENT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id
       ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1""")
def latest_by(spark, sf_dir):
    return dedup.latest_by(Tables(spark, sf_dir).events, ["user_id"], ["ts", "event_id"])


@query("earliest_by", """
WITH e AS (SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id
           ORDER BY ts, event_id) AS rn FROM events) t WHERE rn = 1)
SELECT * FROM e WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events)""")
def earliest_by(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    first = dedup.earliest_by(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "ts")
    first_day = ev.agg(F.min(F.to_date("ts"))).scalar()
    return first.where(F.to_date("ts") == first_day)


@query("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("top_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_n(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return dedup.top_n(o.select("o_orderkey", "o_totalprice"), ["o_totalprice", F.asc("o_orderkey")], 20)


@query("top_n_per_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice, rank_in_group FROM (
  SELECT o_orderpriority, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)
              AS INTEGER) AS rank_in_group
  FROM orders) t WHERE rank_in_group <= 5""")
def top_n_per_group(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return dedup.top_n_per_group(o, ["o_orderpriority"], ["o_totalprice", F.asc("o_orderkey")], 5)


@query("union_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""")
def union_by_name(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where(~F.col("o_orderstatus").eqNullSafe("F")).select("o_orderkey", "o_orderpriority", "o_orderdate")
    return reshape.union_by_name([a, b])


@query("concat_all", """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'rest' END AS part, o_totalprice
FROM orders""")
def concat_all(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    named = {s: F.col("o_orderstatus").eqNullSafe(s) for s in ("F", "O")}
    named["rest"] = ~(named["F"] | named["O"])
    parts = [o.where(cond).select("o_orderkey", F.lit(s).alias("part"), "o_totalprice") for s, cond in named.items()]
    return reshape.union_by_name(parts)


@query("unpivot_wide", """
UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME variable VALUE value""")
def unpivot_wide(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return reshape.unpivot_wide(li, ["l_orderkey", "l_linenumber"],
                                ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("frame_diff", """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, round(o_totalprice, 2) AS price FROM orders),
b AS (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
             CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice + 100.0, 2) ELSE round(o_totalprice, 2) END AS price
      FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice > 1000),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
             a.o_orderstatus AS l1, b.o_orderstatus AS r1, a.o_orderpriority AS l2, b.o_orderpriority AS r2,
             a.price AS l3, b.price AS r3 FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, 'o_orderstatus' AS column, l1 AS left_value, r1 AS right_value FROM j WHERE l1 IS DISTINCT FROM r1
UNION ALL SELECT o_orderkey, 'o_orderpriority', l2, r2 FROM j WHERE l2 IS DISTINCT FROM r2
UNION ALL SELECT o_orderkey, 'price', CAST(l3 AS VARCHAR), CAST(r3 AS VARCHAR) FROM j WHERE l3 IS DISTINCT FROM r3""")
def frame_diff(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = o.select("o_orderkey", "o_orderstatus", "o_orderpriority", fast_round("o_totalprice", 2).alias("price"))
    b = (o.where((F.col("o_orderstatus") != "O") | (F.col("o_totalprice") > 1000))
         .select("o_orderkey", "o_orderstatus",
                 F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
                 .alias("o_orderpriority"),
                 F.when(F.col("o_orderstatus") == "F", fast_round(F.col("o_totalprice") + 100.0, 2))
                 .otherwise(fast_round("o_totalprice", 2)).alias("price")))
    return reshape.frame_diff(a, b, ["o_orderkey"], ["o_orderstatus", "o_orderpriority", "price"])


FOLDER_FMT = "yyyy-MM-dd'T'HH.mm.ss'Z'"


@query("increment_range", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H.%M.%SZ') AS folder FROM orders
WHERE strftime(o_orderdate, '%Y-%m-%dT%H.%M.%SZ') >= '1996-01-01T00.00.00Z'
  AND strftime(o_orderdate, '%Y-%m-%dT%H.%M.%SZ') < '1997-06-01T00.00.00Z'""")
def increment_range(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    f = F.date_format("o_orderdate", FOLDER_FMT)
    return (o.select("o_orderkey", f.alias("folder"))
            .where((F.col("folder") >= "1996-01-01T00.00.00Z") & (F.col("folder") < "1997-06-01T00.00.00Z")))
