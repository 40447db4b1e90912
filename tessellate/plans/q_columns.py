"""Queries: row-level column expressions (F1-F18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators.encode import label_codes, label_encode, narrow_types, narrow_types_plan
from ..operators.reshape import dropna_any, select_except
from ..sources.tables import Tables
from .registry import query, rounded


@query("text_contains", """
SELECT p_partkey, p_name, coalesce(regexp_matches(p_name, 'RING|bolt', 'i'), false) AS hit
FROM part""")
def text_contains(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", "p_name", fc.text_contains("p_name", "RING|bolt").alias("hit"))


@query("date_between", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN '1996-01-01' AND '1996-12-31' AND l_returnflag = 'R'""")
def date_between(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.where(F.col("l_shipdate").between("1996-01-01", "1996-12-31")
                     & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


@query("isin_filter", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def isin_filter(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & ~F.col("o_orderstatus").isin("P"))
            .select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("dropna_any", """
SELECT c_custkey, c_name, seg FROM (
  SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer) t
WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND seg IS NOT NULL""")
def dropna_any_q(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    c = c.select("c_custkey", "c_name",
                 F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"))
    return dropna_any(c)


@query("clamp_zero", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
       c_acctbal AS c_acctbal_actual FROM customer""")
def clamp_zero(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", *fc.clamp_columns(["c_acctbal"]))


@query("select_except", """
SELECT * EXCLUDE (l_extendedprice, l_discount, l_tax, l_linestatus) FROM lineitem""")
def select_except_q(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return select_except(li, ["l_extendedprice", "l_discount", "l_tax", "l_linestatus"])


@query("concat_key", """
SELECT l_orderkey, l_linenumber, concat_ws('_', l_suppkey, l_returnflag) AS partition_key
FROM lineitem""")
def concat_key(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     fc.concat_key(["l_suppkey", "l_returnflag"]).alias("partition_key"))


@query("parse_suffix", """
SELECT c_custkey, CAST(substring(c_name, 10) AS INTEGER) AS name_no FROM customer""")
def parse_suffix(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", fc.parse_suffix("c_name", len("Customer#")).alias("name_no"))


@query("load_stamp", """
SELECT event_id, (ts AT TIME ZONE 'Europe/Rome') AT TIME ZONE 'UTC' AS loaded_at FROM events""")
def load_stamp(spark, sf_dir):
    """Load times noted on a local clock, as UTC."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", fc.utc_stamp("ts", "Europe/Rome").alias("loaded_at"))


@query("price_cents", """
SELECT p_partkey, round(p_retailprice % 1, 6) + 0.0 AS p_retailprice_cent,
       round((-p_retailprice) % 1, 6) + 0.0 AS neg_cent FROM part""")
def price_cents(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return rounded(p.select("p_partkey", fc.signed_fraction("p_retailprice").alias("p_retailprice_cent"),
                            fc.signed_fraction(-F.col("p_retailprice")).alias("neg_cent")))


def _narrow_sql(table, cols):
    parts = []
    for c, kind in cols:
        if kind == "int":
            t = ("CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
                 "WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
                 "WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END")
        else:
            t = ("CASE WHEN min({c}) >= -3.4028234663852886e38 AND max({c}) <= 3.4028234663852886e38 "
                 "THEN 'float' ELSE 'double' END")
        parts.append(f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) + 0.0 AS min_value, "
                     f"CAST(max({c}) AS DOUBLE) + 0.0 AS max_value, {t.format(c=c)} AS narrow_type FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("narrow_types", _narrow_sql("lineitem", [
    ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
    ("l_quantity", "float"), ("l_extendedprice", "float"), ("l_discount", "float"), ("l_tax", "float")]))
def narrow_types_q(spark, sf_dir):
    return rounded(narrow_types_plan(Tables(spark, sf_dir).lineitem))


@query("narrowed_rows", """
SELECT l_orderkey, l_linenumber, l_quantity, '{types}' AS l_types FROM lineitem""".replace("'{types}'", """
(SELECT max(CASE WHEN {0} THEN 'tinyint' WHEN {1} THEN 'smallint' WHEN {2} THEN 'int' ELSE 'bigint' END)
 FROM (SELECT min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem) r)""".format(
    *[f"lo >= -{2 ** b} AND hi < {2 ** b}" for b in (7, 15, 31)])))
def narrowed_rows(spark, sf_dir):
    """The cast frame itself: same values, narrow types."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity")
    out = narrow_types(li)
    return out.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"),
                      F.col("l_quantity").cast("double").alias("l_quantity"), F.lit(dict(out.dtypes)["l_linenumber"]).alias("l_types"))


@query("label_encode_rows", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey,
       CAST(CASE WHEN l_suppkey IS NOT NULL THEN dense_rank() OVER (
              PARTITION BY l_returnflag ORDER BY l_suppkey NULLS LAST) - 1 END AS INTEGER) AS l_suppkey_le FROM lineitem""")
def label_encode_rows(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    return label_encode(li, ["l_returnflag"], "l_suppkey")


@query("hash_shard", """
SELECT c_custkey, c_name, CAST(('0x' || md5(c_name))::UHUGEINT % 7 AS BIGINT) AS shard FROM customer""")
def hash_shard(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", "c_name", fc.hash_shard("c_name", 7).alias("shard"))


@query("label_encode", """
SELECT DISTINCT l_returnflag, l_suppkey,
       CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey) - 1 AS INTEGER) AS l_suppkey_le
FROM (SELECT DISTINCT l_returnflag, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL) t""")
def label_encode_q(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return label_codes(li, ["l_returnflag"], "l_suppkey")
