"""Landing, loads and updates of stored tables (S3 S4 K1 K6 P15 J4), each run twice or cut short on the shared tables.

Orders stand for a spreadsheet's lines, line items for activities, customers for cows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import key_update
from ..operators.reconcile import MERGE, reconcile
from ..session import scratch_path
from ..sources import landing, loads
from ..sources.json_arrays import read_json_array
from ..sources.sinks import export_csv, store_bucketed
from ..sources.tables import table

SQL = {}
BUCKETS = 64  # of a stored table

SHEET = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.StringType()),
                      T.StructField("o_totalprice", T.DoubleType())])


def q_landed_row_ids(spark, sf):
    """Orders by date and key, saved as a sheet of many files, landed with the positions of their lines."""
    sheet, out = scratch_path(spark, "sheet"), scratch_path(spark, "landed")
    lines = table(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey")
    export_csv(lines.select("o_orderkey", "o_orderpriority", "o_totalprice"), sheet)
    return landing.land_csv(spark, sheet, SHEET, out)


SQL["landed_row_ids"] = """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id, o_orderkey,
  o_orderpriority, o_totalprice FROM orders"""


def q_load_once(spark, sf):
    """K1: a load of two tables that runs twice, one more that never got to its second table, and one after them."""
    cows, log = scratch_path(spark, "cows"), scratch_path(spark, "log")
    acts = scratch_path(spark, "acts")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"))
    old, new = F.col("id") % 3 == 0, F.col("id") % 3 != 0
    for _ in range(2):
        loads.load({cows: c.where(old), acts: o.where(old)}, log, "1")
    loads.stage(c.where(new), cows, "2")  # ended here
    loads.load({cows: c.where(new), acts: o.where(new)}, log, "3")
    rows = [loads.loaded(spark, p, log).withColumn("source", F.lit(n)) for p, n in ((cows, "cows"), (acts, "acts"))]
    return rows[0].union(rows[1])


SQL["load_once"] = """SELECT c_custkey AS id, c_name AS name, 'cows' AS source FROM customer
UNION ALL SELECT o_custkey, o_orderpriority, 'acts' FROM orders"""


def q_incremental_load(spark, sf):
    """Three runs over a growing log of line items, one of them twice, by ship date and line key."""
    path, log = scratch_path(spark, "lines"), scratch_path(spark, "log")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    for run, until in (("1", "1996-06-30"), ("2", "1999-12-31"), ("2", "1999-12-31"), ("3", "2999-01-01")):
        loads.load_new(lines.where(F.col("l_shipdate") <= F.lit(until)), path, log, run, mark="l_shipdate",
                       keys=["l_orderkey", "l_linenumber"])
    out = loads.loaded(spark, path, log)
    return out.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))


SQL["incremental_load"] = """SELECT l_orderkey, l_linenumber, strftime(min(l_shipdate), '%Y-%m-%d') AS l_shipdate
FROM lineitem GROUP BY l_orderkey, l_linenumber"""


def _balances(spark, sf):
    """Updates of the customers of every tenth range of 64 keys."""
    o = table(spark, sf, "orders").where(F.floor(F.col("o_custkey") / 64) % 10 == 0)
    return o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))


def q_touched_update(spark, sf):
    """K6: customers stored by key range; the ranges with updates are rewritten, the others stay."""
    path = scratch_path(spark, "cows")
    loads.store_ranges(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "c_custkey", 64)
    loads.update_touched(spark, path, _balances(spark, sf), "c_custkey", "c_acctbal", 64)
    return loads.stored_ranges(spark, path)


def q_snapshot_update(spark, sf):
    """K6: the same update as a new snapshot of the whole table."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return key_update(c, _balances(spark, sf), "c_custkey", "c_acctbal", unmatched_to_null=False)


SQL["touched_update"] = SQL["snapshot_update"] = """WITH u AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders
  WHERE (o_custkey // 64) % 10 = 0 GROUP BY o_custkey)
SELECT c_custkey, c_name, coalesce(u.v, c_acctbal) AS c_acctbal FROM customer LEFT JOIN u ON u.o_custkey = c_custkey"""


CUSTOMER = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                         T.StructField("place", T.StructType([T.StructField("nation", T.IntegerType())]))])


def q_json_array_dump(spark, sf):
    """Customers dumped as JSON arrays with braces and quotes in their texts and an inner object, cut by many tasks."""
    c = table(spark, sf, "customer")
    name = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, F.lit(' }{" \\')).otherwise(F.lit(", [x]")))
    row = F.struct(F.col("c_custkey"), name.alias("c_name"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"),
                   F.col("c_mktsegment").alias("segment"))
    arrays = c.groupBy(F.floor(F.col("c_custkey") / 500).alias("page")).agg(F.sort_array(F.collect_list(row)).alias("a"))
    path = scratch_path(spark, "dump")
    arrays.repartition("page").select(F.to_json("a", {"pretty": "true"})).write.text(path)
    d = read_json_array(spark, path, CUSTOMER, scratch_path(spark, "pieces"), rest="whole")
    return d.select("c_custkey", "c_name", F.col("place.nation").alias("nation"),
                    F.variant_get("whole", "$.segment", "string").alias("segment"))


SQL["json_array_dump"] = """SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' }{" \\' ELSE ', [x]' END AS c_name,
  c_nationkey AS nation, c_mktsegment AS segment FROM customer"""


def q_reconcile_bucketed(spark, sf):
    """J4 against a stored table kept in buckets of its key: only the incoming side is shuffled."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_orderpriority")
    name = f"stored_orders_{uuid.uuid4().hex[:8]}"
    stored = store_bucketed(o.where("key % 3 <> 0"), name, ["key"], BUCKETS, scratch_path(spark, "bucketed"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("n_lines"))
    return reconcile(lines, stored, ["key"]).select("key", "n_lines", "o_orderpriority", F.col(MERGE).alias("status"))


SQL["reconcile_bucketed"] = """WITH l AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0)
SELECT coalesce(l_orderkey, o_orderkey) AS key, n_lines, o_orderpriority, CASE WHEN o_orderkey IS NULL THEN 'left_only'
  WHEN l_orderkey IS NULL THEN 'right_only' ELSE 'both' END AS status FROM l FULL JOIN o ON l_orderkey = o_orderkey"""


QUERIES = {
    "json_array_dump": q_json_array_dump,
    "reconcile_bucketed": q_reconcile_bucketed,
    "landed_row_ids": q_landed_row_ids,
    "load_once": q_load_once,
    "incremental_load": q_incremental_load,
    "touched_update": q_touched_update,
    "snapshot_update": q_snapshot_update,
}
