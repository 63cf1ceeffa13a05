"""The original's results where they differ from the stated intent: T2 (null keys match), T7 and T8 (runs and change
points that go on over key borders), on the stand-ins of ``paddock_queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.reconcile import MERGE, reconcile
from ..operators.runs import change_flags, movement_path, run_sum_reset
from ..sources.tables import table
from .paddock_queries import SQL_GRID, SQL_ORDER, _ds, _herd_rows, events_grid, order

SQL = {}


def q_since_purchase_legacy(spark, sf):
    """Rows since the last purchase; a paddock's first rows go on counting where the paddock before ended."""
    g = events_grid(spark, sf)
    flag = F.when(F.col("event_type").eqNullSafe(F.lit("purchase")), 0).otherwise(1)
    d = run_sum_reset(g, ["user_id"], order(), flag, "dias_sin_purchase", legacy=True)
    return d.select("user_id", _ds("date").alias("date"), "event_id",
                    F.col("dias_sin_purchase").cast("bigint").alias("dias_sin_purchase"))


SQL["since_purchase_legacy"] = f"""WITH {SQL_GRID},
f AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM 'purchase' THEN 0 ELSE 1 END AS flag FROM grid),
r AS (SELECT *, sum(1 - flag) OVER (ORDER BY user_id, {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM f)
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id, CAST(nullif(sum(flag) OVER (PARTITION BY grp
  ORDER BY user_id, {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS dias_sin_purchase FROM r"""


def q_change_flags_legacy(spark, sf):
    """A paddock's first row is compared with the last one of the paddock before."""
    d = change_flags(events_grid(spark, sf), ["user_id"], order(), "event_type", legacy=True)
    return d.select("user_id", _ds("date").alias("date"), "event_id", "lote_change", "actividad_change")


SQL["change_flags_legacy"] = f"""WITH {SQL_GRID}
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id, user_id IS DISTINCT FROM lag(user_id) OVER w AS lote_change,
  coalesce(event_type = lag(event_type) OVER w, false) AS actividad_change
FROM grid WINDOW w AS (ORDER BY user_id, {SQL_ORDER})"""


def _shared_places(spark, sf):
    """The herds' rows on ten places, so that one herd often begins where the herd before it ended."""
    return _herd_rows(spark, sf).withColumn("lote", F.col("lote") % 10 - F.col("lote") % 5)


def q_path_lags_legacy(spark, sf):
    """A herd's first row is no change point where the herd before it ended in the same place."""
    p = movement_path(_shared_places(spark, sf), ["herd"], order(), place="lote", depth=3, legacy=True)
    return p.select("herd", _ds("date").alias("date"), "event_id", "lote", "lag_1", "lag_2", "lag_3")


SQL["path_lags_legacy"] = f"""WITH hz AS (SELECT 'HATO ' || CAST(user_id % 5 AS VARCHAR) AS herd, user_id % 10 - user_id % 5 AS lote,
    CAST(ts AS DATE) AS date, ts, event_id FROM events WHERE event_type = 'purchase'),
c AS (SELECT *, lote IS DISTINCT FROM lag(lote) OVER (ORDER BY herd, {SQL_ORDER}) AS cp FROM hz),
cl AS (SELECT event_id, lag(lote, 1) OVER w AS l1, lag(lote, 2) OVER w AS l2, lag(lote, 3) OVER w AS l3
  FROM c WHERE cp WINDOW w AS (PARTITION BY herd ORDER BY {SQL_ORDER}))
SELECT c.herd, CAST(c.date AS VARCHAR) AS date, c.event_id, c.lote, last_value(cl.l1 IGNORE NULLS) OVER w AS lag_1,
  last_value(cl.l2 IGNORE NULLS) OVER w AS lag_2, last_value(cl.l3 IGNORE NULLS) OVER w AS lag_3
FROM c LEFT JOIN cl ON c.event_id = cl.event_id WINDOW w AS (PARTITION BY c.herd ORDER BY c.date, c.ts NULLS FIRST,
  c.event_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def q_reconcile_null_keys(spark, sf):
    """Customers without a usable id meet suppliers without one, each with each (a few, by name)."""
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 100 != 0, F.col("c_custkey")).alias("id"), "c_name")
    s = table(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 20 != 0, F.col("s_suppkey")).alias("id"), "s_name")
    return reconcile(c, s, ["id"], null_safe=True).select("id", "c_name", "s_name", F.col(MERGE).alias("status"))


SQL["reconcile_null_keys"] = """WITH c AS (SELECT CASE WHEN c_custkey % 100 <> 0 THEN c_custkey END AS cid, c_name, 1 AS l FROM customer),
s AS (SELECT CASE WHEN s_suppkey % 20 <> 0 THEN s_suppkey END AS sid, s_name, 1 AS r FROM supplier)
SELECT coalesce(cid, sid) AS id, c_name, s_name, CASE WHEN l = 1 AND r = 1 THEN 'both' WHEN l = 1 THEN 'left_only'
  ELSE 'right_only' END AS status FROM c FULL JOIN s ON cid IS NOT DISTINCT FROM sid"""

QUERIES = {
    "since_purchase_legacy": q_since_purchase_legacy,
    "change_flags_legacy": q_change_flags_legacy,
    "path_lags_legacy": q_path_lags_legacy,
    "reconcile_null_keys": q_reconcile_null_keys,
}
