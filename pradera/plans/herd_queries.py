"""Reconciliation, keys and joins on the order/customer/supplier tables.

Stand-ins: incoming activity rows = line items, stored activities = line
items of another status; cows = customers; activity ids = order keys; the
id high-water mark = the largest customer key (a stored table that already
holds ids).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import case_map, recode, recode_join, shift_code
from ..functions.text import composite_key, format_date, replace_value
from ..operators.aggregate import keep_last
from ..operators.keys import assign_ids, id_map, key_update, remap, zip_rows
from ..operators.reconcile import (HASH, MERGE, anti, audit_missing, enrich, hashed, join_flag, parent_lookup,
                                   reconcile, semi)
from ..operators.reshape import key_difference, key_intersection
from ..operators.runs import group_size
from ..operators.select import above_mark
from ..sources.tables import table

SQL = {}


def _t(spark, sf, name):
    return table(spark, sf, name)


# --------------------------------------------------------------------------- J4 J15 F19
def _activity_keys(df):
    return df.select(composite_key(format_date("l_shipdate", "MM/dd/yyyy"), "l_orderkey", "l_linenumber").alias("key"),
                     "l_orderkey", "l_linenumber")


def _stored_activities(spark, sf):
    return _activity_keys(_t(spark, sf, "lineitem").filter(F.col("l_linestatus") == "F")).select(
        "key", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_actividad"))


def _reconciled(spark, sf):
    li = _t(spark, sf, "lineitem")
    incoming = _activity_keys(li.filter(F.col("l_returnflag").isin("R", "A"))).distinct()
    return reconcile(hashed(incoming, "key"), hashed(_stored_activities(spark, sf), "key"), [HASH, "key"]).drop(HASH)


def q_reconcile_counts(spark, sf):
    r = _reconciled(spark, sf)
    return r.groupBy(F.col(MERGE).alias("status")).agg(F.count(F.lit(1)).alias("n"))


SQL_KEYS = """l AS (SELECT DISTINCT strftime(l_shipdate, '%m/%d/%Y') || '_' || CAST(l_orderkey AS VARCHAR) || '_'
      || CAST(l_linenumber AS VARCHAR) AS key, l_orderkey, l_linenumber
    FROM lineitem WHERE l_returnflag IN ('R', 'A')),
r AS (SELECT strftime(l_shipdate, '%m/%d/%Y') || '_' || CAST(l_orderkey AS VARCHAR) || '_'
      || CAST(l_linenumber AS VARCHAR) AS key, l_orderkey * 10 + l_linenumber AS id_actividad
    FROM lineitem WHERE l_linestatus = 'F'),
j AS (SELECT coalesce(l.key, r.key) AS key, l.l_orderkey, l.l_linenumber, r.id_actividad,
    CASE WHEN l.key IS NOT NULL AND r.key IS NOT NULL THEN 'both'
         WHEN l.key IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS status
  FROM l FULL JOIN r ON l.key = r.key)"""

SQL["reconcile_counts"] = f"""WITH {SQL_KEYS}
SELECT status, count(*) AS n FROM j GROUP BY status"""


def q_reconcile_new(spark, sf):
    r = _reconciled(spark, sf)
    return r.filter(F.col(MERGE) == "left_only").select("key", "l_orderkey", "l_linenumber")


SQL["reconcile_new"] = f"""WITH {SQL_KEYS}
SELECT key, l_orderkey, l_linenumber FROM j WHERE status = 'left_only'"""


# --------------------------------------------------------------------------- J6 J7 J8
def _building(spark, sf):
    return _t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")


def q_semi_known(spark, sf):
    o = _t(spark, sf, "orders")
    return semi(o, _building(spark, sf), ["o_custkey"], ["c_custkey"]).select("o_orderkey", "o_custkey")


SQL["semi_known"] = """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""


def q_anti_unknown(spark, sf):
    o = _t(spark, sf, "orders")
    return anti(o, _building(spark, sf), ["o_custkey"], ["c_custkey"]).select("o_orderkey", "o_custkey")


SQL["anti_unknown"] = """SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey = o.o_custkey)"""


def q_audit_missing(spark, sf):
    o = _t(spark, sf, "orders")
    dim = _t(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    return audit_missing(o, "o_custkey", dim, "c_custkey", "c_name")


SQL["audit_missing"] = """SELECT DISTINCT o.o_custkey FROM orders o
LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
WHERE c.c_name IS NULL"""


# --------------------------------------------------------------------------- J1 F11 F12 F17 F26 F27 F28
def q_recode_default(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    r = recode_join(c, n, "c_nationkey", "n_nationkey", "n_regionkey", "id_region", default=34)
    return r.select("c_custkey", F.col("id_region").cast("int").alias("id_region"))


SQL["recode_default"] = """SELECT c.c_custkey, CAST(coalesce(n.n_regionkey, 34) AS INTEGER) AS id_region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

# fixed values of the stand-in recodes
PRIORITY_IDS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
STATUS_CASE = {"F": 1, "O": 2}


def q_recode_case(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey",
                    recode("o_orderpriority", PRIORITY_IDS, default=35, keep_unmatched=False).cast("int").alias("prio_id"),
                    recode("o_orderpriority", {"5-LOW": "LOW"}).alias("prio_text"),
                    case_map("o_orderstatus", STATUS_CASE, default=3).cast("int").alias("status_id"))


SQL["recode_case"] = """SELECT o_orderkey,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 35 END AS INTEGER) AS prio_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'LOW' ELSE o_orderpriority END AS prio_text,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS status_id
FROM orders"""


def q_case_arith(spark, sf):
    p = _t(spark, sf, "part")
    size_txt = p["p_size"].cast("string")
    return p.select("p_partkey",
                    shift_code(F.col("p_size") - 25).cast("int").alias("shifted"),
                    (F.col("p_size") - 101).cast("int").alias("breed"),
                    replace_value(F.col("p_size") - 26, 0, 1).cast("int").alias("fixed"),
                    size_txt.cast("int").alias("size_int"))


SQL["case_arith"] = """SELECT p_partkey,
  CAST(CASE WHEN p_size - 25 <= 0 THEN p_size - 25 + 2 WHEN p_size - 25 > 0 THEN p_size - 25 + 1 END AS INTEGER) AS shifted,
  CAST(p_size - 101 AS INTEGER) AS breed,
  CAST(CASE WHEN p_size - 26 = 0 THEN 1 ELSE p_size - 26 END AS INTEGER) AS fixed,
  CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS size_int
FROM part"""


# --------------------------------------------------------------------------- J2 J3 J17
def q_lookup_inner(spark, sf):
    li = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").select(
        "l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus")


SQL["lookup_inner"] = """SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def q_full_then_filter(spark, sf):
    li = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "full").filter(F.col("o_orderkey").isNotNull())
    return j.select("o_orderkey", "l_linenumber")


SQL["full_then_filter"] = """SELECT o_orderkey, l_linenumber
FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey IS NOT NULL"""


def q_child_to_parity(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = enrich(li, o, ["l_orderkey"])
    return j.select("l_orderkey", "l_linenumber", format_date("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


SQL["child_to_parity"] = """SELECT l_orderkey, l_linenumber, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


# --------------------------------------------------------------------------- J9
def q_parent_lookup(spark, sf):
    s = _t(spark, sf, "supplier")
    s = s.withColumn("parent_name", F.concat(F.lit("Supplier#"), F.lpad(F.col("s_nationkey").cast("string"), 9, "0")))
    return parent_lookup(s, "parent_name", _t(spark, sf, "supplier"), "s_name", "s_suppkey", "parent_id").select(
        "s_suppkey", "parent_name", "parent_id")


SQL["parent_lookup"] = """WITH s AS (SELECT s_suppkey, 'Supplier#' || lpad(CAST(s_nationkey AS VARCHAR), 9, '0') AS parent_name FROM supplier)
SELECT s.s_suppkey, s.parent_name, p.s_suppkey AS parent_id FROM s LEFT JOIN supplier p ON s.parent_name = p.s_name"""


# --------------------------------------------------------------------------- A4 A5 W10 P16 J5
def q_keep_last(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity",
                                           "l_shipdate")
    k = keep_last(li, ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return k.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")


SQL["keep_last"] = """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1"""


def q_group_size_filter(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    g = group_size(li, ["l_partkey", "l_suppkey"], "duplicados")
    big = _t(spark, sf, "part").filter(F.col("p_size") > 10).select(F.col("p_partkey"))
    j = join_flag(g, big, ["l_partkey"], ["p_partkey"])
    return j.filter((F.col("duplicados") < 2) & (F.col(MERGE) == "both")).select(
        "l_orderkey", "l_linenumber", F.col("duplicados").cast("bigint").alias("duplicados"))


SQL["group_size_filter"] = """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey,
    count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS duplicados FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(duplicados AS BIGINT) AS duplicados FROM g
WHERE duplicados < 2 AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)"""


def q_distinct_rows(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_partkey", "l_suppkey").distinct()


SQL["distinct_rows"] = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"


def q_name_join_flag(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = join_flag(o, _building(spark, sf).select("c_custkey"), ["o_custkey"], ["c_custkey"])
    return j.select("o_orderkey", F.col(MERGE).alias("status"))


SQL["name_join_flag"] = """SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN 'both' ELSE 'left_only' END AS status
FROM orders o LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c ON o.o_custkey = c.c_custkey"""


# --------------------------------------------------------------------------- B5 J18
def q_dup_report(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")
    g = group_size(d, ["text_md5"], "duplicados").filter(F.col("duplicados") > 1)
    lab = _t(spark, sf, "labels").select("doc_id", F.col("quality").alias("lang_q"), "toxic")
    e = enrich(g, lab, ["doc_id"])
    return e.select("doc_id", "text_md5", F.col("duplicados").cast("bigint").alias("duplicados"), "lang", "source",
                    "lang_q", "toxic")


SQL["dup_report"] = """WITH d AS (SELECT doc_id, md5(text) AS text_md5, lang, source,
    count(*) OVER (PARTITION BY md5(text)) AS duplicados FROM documents)
SELECT d.doc_id, d.text_md5, CAST(d.duplicados AS BIGINT) AS duplicados, d.lang, d.source,
  l.quality AS lang_q, l.toxic
FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.duplicados > 1"""


# --------------------------------------------------------------------------- J12 J13 J14 K6 U1 P15
def _mark(spark, sf):
    return _t(spark, sf, "customer").select(F.max("c_custkey")).scalar()


def q_id_map(spark, sf):
    o = _t(spark, sf, "orders")
    return id_map(o, "o_orderkey", _mark(spark, sf))


SQL["id_map"] = """SELECT o_orderkey AS old_id,
  (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderkey) AS new_id
FROM (SELECT DISTINCT o_orderkey FROM orders)"""


def q_fk_remap(spark, sf):
    o = _t(spark, sf, "orders")
    map_f = id_map(o.filter(F.col("o_orderstatus") == "F"), "o_orderkey", _mark(spark, sf))
    supp_mark = _t(spark, sf, "supplier").select(F.max("s_suppkey")).scalar()
    map_o = id_map(o.filter(F.col("o_orderstatus") != "F"), "o_orderkey", supp_mark)
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    r = remap(li, "l_orderkey", [map_f, map_o], out="new_orderkey")
    return r.select("l_orderkey", "l_linenumber", "new_orderkey")


SQL["fk_remap"] = """WITH mf AS (SELECT o_orderkey AS old_id,
    (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderkey) AS new_id
  FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F')),
mo AS (SELECT o_orderkey AS old_id,
    (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY o_orderkey) AS new_id
  FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'F')),
m AS (SELECT * FROM mf UNION ALL SELECT * FROM mo)
SELECT l_orderkey, l_linenumber, m.new_id AS new_orderkey FROM lineitem LEFT JOIN m ON l_orderkey = m.old_id"""


def q_bulk_update(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    last = keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_orderkey"))
    return key_update(c, last, "c_custkey", "last_orderkey")


SQL["bulk_update"] = """WITH l AS (SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
SELECT c_custkey, c_name, l.o_orderkey AS last_orderkey FROM customer LEFT JOIN l ON c_custkey = l.o_custkey"""


def q_zip_rows(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey")
    c = _t(spark, sf, "customer").select("c_custkey")
    z = zip_rows(o, c, ["o_orderkey"], ["c_custkey"])
    return z.select(F.col("_pos").cast("bigint").alias("pos"), "o_orderkey", "c_custkey")


SQL["zip_rows"] = """WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders),
b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer)
SELECT CAST(coalesce(a.pos, b.pos) AS BIGINT) AS pos, a.o_orderkey, b.c_custkey FROM a FULL JOIN b ON a.pos = b.pos"""


def q_above_mark(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey")
    return above_mark(o, "o_orderkey", _t(spark, sf, "customer"), "c_custkey")


SQL["above_mark"] = "SELECT o_orderkey FROM orders WHERE o_orderkey > (SELECT max(c_custkey) FROM customer)"


def q_new_activity_ids(spark, sf):
    """J13 on the reconcile output: ids for new activities start after the stored maximum."""
    r = _reconciled(spark, sf)
    stored_max = _stored_activities(spark, sf).select(F.max("id_actividad")).scalar()  # the full join keeps all of them
    new = r.filter(F.col(MERGE) == "left_only").select("key", "l_orderkey", "l_linenumber")
    n = assign_ids(new.withColumn("_ord", F.col("l_orderkey") * 100 + F.col("l_linenumber")), "_ord", stored_max,
                   "id_actividad", tie=["key"])
    return n.select("key", "id_actividad")


SQL["new_activity_ids"] = f"""WITH {SQL_KEYS}
SELECT key, (SELECT max(id_actividad) FROM j) + row_number() OVER (ORDER BY l_orderkey * 100 + l_linenumber, key) AS id_actividad
FROM j WHERE status = 'left_only'"""


# --------------------------------------------------------------------------- U3
def q_set_difference(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    o = _t(spark, sf, "orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return key_difference(c, o, ["c_custkey"])


SQL["set_difference"] = """SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"""


def q_set_intersection(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    o = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return key_intersection(c, o, ["c_custkey"])


SQL["set_intersection"] = "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"


def q_rowid_join(spark, sf):
    """An order-level total put back on each line without a window over the order."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    tot = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("order_qty"))
    j = li.join(tot, "l_orderkey", "left")
    return j.select("l_orderkey", "l_linenumber", F.round("order_qty", 4).alias("order_qty"))


SQL["rowid_join"] = """SELECT l_orderkey, l_linenumber,
  round(sum(l_quantity) OVER (PARTITION BY l_orderkey), 4) AS order_qty FROM lineitem"""


QUERIES = {
    "reconcile_counts": q_reconcile_counts,
    "reconcile_new": q_reconcile_new,
    "semi_known": q_semi_known,
    "anti_unknown": q_anti_unknown,
    "audit_missing": q_audit_missing,
    "recode_default": q_recode_default,
    "recode_case": q_recode_case,
    "case_arith": q_case_arith,
    "lookup_inner": q_lookup_inner,
    "full_then_filter": q_full_then_filter,
    "child_to_parity": q_child_to_parity,
    "parent_lookup": q_parent_lookup,
    "keep_last": q_keep_last,
    "group_size_filter": q_group_size_filter,
    "distinct_rows": q_distinct_rows,
    "name_join_flag": q_name_join_flag,
    "dup_report": q_dup_report,
    "id_map": q_id_map,
    "fk_remap": q_fk_remap,
    "bulk_update": q_bulk_update,
    "zip_rows": q_zip_rows,
    "above_mark": q_above_mark,
    "new_activity_ids": q_new_activity_ids,
    "set_difference": q_set_difference,
    "set_intersection": q_set_intersection,
    "rowid_join": q_rowid_join,
}
