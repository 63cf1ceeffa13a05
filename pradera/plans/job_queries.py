"""The jobs themselves, run on the shared tables landed as their inputs.

Paddock jobs (B6, B10) run on ``events`` landed as a paddock log; the
herd-database diagnosis load (B12) runs on ``orders`` landed as the
operations extract (priority -> operation type, customer -> cow, customer
key mod 30 / 25 -> result / officer) and ``lineitem`` as its detail rows,
with ``nation`` as the result map and the largest supplier key as the id mark.

Paddock mapping:
every user is a paddock of farm EL RECODO (POTRERO = user id);
``purchase`` -> PASTOREO, ``click`` -> FUMIGADA, ``signup`` -> SIEMBRA,
``view`` -> ABONADA, ``error`` -> ROTOBO; animals = floor(value); milk =
value; herd = RECODO 1..3 / JUNCAL / ISLA by user id; forage by value;
``row_id`` = event id (events are landed in id order).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import pad_suffix, paddock_code
from ..sources.tables import table
from . import herd_db_jobs as H
from . import paddock_jobs as J

SQL = {}
# fixed values of the stand-in: event type -> paddock activity
ACTIVITY_OF_EVENT = {"purchase": "PASTOREO", "click": "FUMIGADA", "signup": "SIEMBRA", "view": "ABONADA",
                     "error": "ROTOBO"}
HERDS = ("RECODO 1", "RECODO 2", "RECODO 3", "JUNCAL", "ISLA")


def landed_log(spark, sf):
    e = table(spark, sf, "events")
    act = None
    for k, v in ACTIVITY_OF_EVENT.items():
        act = F.when(F.col("event_type") == k, v) if act is None else act.when(F.col("event_type") == k, v)
    herd = F.element_at(F.array(*[F.lit(h) for h in HERDS]), (F.col("user_id") % 5 + 1).cast("int"))
    grazing = F.col("event_type") == "purchase"
    return e.select(
        F.col("event_id").alias("row_id"), F.lit("EL RECODO").alias("FINCA"),
        F.col("user_id").cast("string").alias("POTRERO"), act.alias("ACTIVIDAD"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("FECHA ACTIVIDAD"),
        F.when(grazing, herd).alias("HATO"),
        F.when(grazing, F.when(F.col("value") >= 100, "RAYGRAS").otherwise("KYKUYO")).alias("TIPO DE FORRAJE"),
        F.when(grazing, F.floor("value").cast("int")).alias("NUMERO ANIMALES"),
        F.when(grazing, F.col("value")).alias("LECHE TOTAL"),
        F.when(~grazing, F.col("event_type")).alias("PRODUCTO"),
        *[F.lit(None).cast(t).alias(c) for c, t in (
            ("AÑO", "int"), ("MES", "int"), ("AREA M2", "double"), ("FECHA ENTRADA", "string"),
            ("FECHA SALIDA", "string"), ("FECHA PROYECTADA FUMIGACION", "string"), ("ANO FUMIGACION", "int"),
            ("MES FUMIGACION", "int"), ("AFORO", "double"), ("LECHE POR DIA", "double"), ("LECHE POR VACA", "double"),
            ("FORRAJE FRECIDO", "double"), ("DIAS ESTADIA", "int"), ("DIAS ANTIGUEDAD PASTOS", "int"))])


def paddock_dim(spark, sf):
    u = table(spark, sf, "events").select("user_id").distinct()
    return u.select(F.lit(1).alias("Finca"), F.col("user_id").alias("lote_id"),
                    pad_suffix(paddock_code(F.lit("EL RECODO"), F.col("user_id").cast("string"))).alias("nombre_lote"))


def q_job_daily_tracking(spark, sf):
    """B6 end to end: clean, dense paddock x day grid, grazing state, rows-since counters, paddock output."""
    clean = J.clean_log(landed_log(spark, sf), start=None)
    out = J.paddock_output(J.daily_tracking(clean, paddock_dim(spark, sf)))
    return out.select("lote_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "row_id", "ACTIVIDAD",
                      "TIPO DE FORRAJE", F.date_format("ultimo_pastoreo", "yyyy-MM-dd").alias("ultimo_pastoreo"),
                      F.col("ultimo_animales").cast("bigint").alias("ultimo_animales"),
                      F.col("dias_de_pastoreo").cast("bigint").alias("dias_de_pastoreo"),
                      F.col("dias_sin_pastoreo").cast("bigint").alias("dias_sin_pastoreo"),
                      *[F.col(f"dias_sin_{a.lower()}").cast("bigint").alias(f"dias_sin_{a.lower()}")
                        for a in J.OTHER_ACTIVITIES])


def _sql_job_tracking():
    acts = [a for a in J.OTHER_ACTIVITIES]
    act_case = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIVITY_OF_EVENT.items()) + " END"
    flags = ",\n  ".join(
        f"CASE WHEN pos = 1 OR act IS NOT DISTINCT FROM '{a}' THEN 0 ELSE 1 END AS f_{a.lower()}" for a in acts)
    grps = ",\n  ".join(
        f"sum(1 - f_{a.lower()}) OVER w AS g_{a.lower()}" for a in acts)
    outs = ",\n  ".join(
        f"CAST(sum(f_{a.lower()}) OVER (PARTITION BY user_id, g_{a.lower()} ORDER BY date, row_id NULLS FIRST "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS dias_sin_{a.lower()}" for a in acts)
    return f"""WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
grid AS (SELECT k.user_id, cal.date, e.event_id AS row_id, e.value,
    {act_case.replace('event_type', 'e.event_type')} AS act
  FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN cal
  LEFT JOIN events e ON e.user_id = k.user_id AND CAST(e.ts AS DATE) = cal.date),
s AS (SELECT *, (act IS NOT DISTINCT FROM 'PASTOREO') AS g,
    CASE WHEN act = 'PASTOREO' THEN CASE WHEN value >= 100 THEN 'RAYGRAS' ELSE 'KYKUYO' END END AS forage0,
    CAST(floor(value) AS BIGINT) AS animals,
    row_number() OVER (PARTITION BY user_id ORDER BY date, row_id NULLS FIRST) AS pos
  FROM grid),
f AS (SELECT *, CASE WHEN pos = 1 OR g THEN 0 ELSE 1 END AS rest, CASE WHEN g THEN 1 ELSE 0 END AS graze,
  {flags} FROM s),
r AS (SELECT *, sum(1 - rest) OVER w AS gr, sum(1 - graze) OVER w AS gg,
  {grps} FROM f
  WINDOW w AS (PARTITION BY user_id ORDER BY date, row_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *,
    nullif(sum(rest) OVER (PARTITION BY user_id, gr ORDER BY date, row_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS sin0,
    nullif(sum(graze) OVER (PARTITION BY user_id, gg ORDER BY date, row_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS de0,
  {outs}
  FROM r)
SELECT user_id AS lote_id, CAST(date AS VARCHAR) AS date, row_id, act AS ACTIVIDAD,
  last_value(forage0 IGNORE NULLS) OVER w AS "TIPO DE FORRAJE",
  CAST(last_value(CASE WHEN g THEN date END IGNORE NULLS) OVER w AS VARCHAR) AS ultimo_pastoreo,
  CAST(last_value(CASE WHEN g THEN nullif(animals, 0) END IGNORE NULLS) OVER w AS BIGINT) AS ultimo_animales,
  CAST(last_value(de0 IGNORE NULLS) OVER w AS BIGINT) AS dias_de_pastoreo,
  CAST(CASE WHEN g THEN 0 ELSE last_value(sin0 IGNORE NULLS) OVER w END AS BIGINT) AS dias_sin_pastoreo,
  {", ".join(f"dias_sin_{a.lower()}" for a in acts)}
FROM q WINDOW w AS (PARTITION BY user_id ORDER BY date, row_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


SQL["job_daily_tracking"] = _sql_job_tracking()


def q_job_herd_milk(spark, sf):
    """B10 end to end on the landed log."""
    clean = J.clean_log(landed_log(spark, sf), start=None)
    m = J.herd_milk(clean)
    return m.select(F.col("ID_HATO").cast("int").alias("ID_HATO"), "HATO_texto",
                    F.date_format("FECHA_ACTIVIDAD", "yyyy-MM-dd HH:mm:ss").alias("FECHA_ACTIVIDAD"),
                    F.col("Numero_Animales").cast("bigint").alias("Numero_Animales"),
                    F.round("Leche_Total", 4).alias("Leche_Total"), "ID_OPERARIO")


SQL["job_herd_milk"] = """WITH l AS (
  SELECT ['RECODO 1', 'RECODO 2', 'RECODO 3', 'JUNCAL', 'ISLA'][user_id % 5 + 1] AS hato,
    CAST(floor(value) AS INTEGER) AS animals, value AS milk,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS fecha
  FROM events WHERE event_type = 'purchase' AND value > 0),
m AS (SELECT *, CASE hato WHEN 'ISLA' THEN 5 WHEN 'JUNCAL' THEN 4 WHEN 'RECODO 1' THEN 1 WHEN 'RECODO 2' THEN 2
    WHEN 'RECODO 3' THEN 3 END AS id FROM l)
SELECT CAST(id AS INTEGER) AS ID_HATO, CASE WHEN id IS NULL THEN hato END AS HATO_texto, fecha AS FECHA_ACTIVIDAD,
  CAST(coalesce(sum(animals), 0) AS BIGINT) AS Numero_Animales, round(coalesce(sum(milk), 0), 4) AS Leche_Total,
  35 AS ID_OPERARIO
FROM m GROUP BY id, CASE WHEN id IS NULL THEN hato END, fecha"""


# --------------------------------------------------------------------------- B12 on orders / line items
# fixed values of the stand-in: order priority -> herd-database operation type
PRIORITY_OPERATION = {"1-URGENT": 91, "2-HIGH": 92, "3-MEDIUM": 96, "4-NOT SPECIFIED": 106, "5-LOW": 23}


def _operations(spark, sf):
    o = table(spark, sf, "orders")
    op = None
    for k, v in PRIORITY_OPERATION.items():
        op = F.when(F.col("o_orderpriority") == k, v) if op is None else op.when(F.col("o_orderpriority") == k, v)
    return o.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("Animal"), op.alias("OperationType"),
                    (F.col("o_custkey") % 30).cast("int").alias("Result"),
                    (F.col("o_custkey") % 25).cast("int").alias("Officer"), F.col("o_orderdate").alias("Date"),
                    F.col("o_orderstatus").alias("Remarks"), F.lit(1).alias("Done"))


def _diagnosis(spark, sf):
    li = table(spark, sf, "lineitem")
    detail = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_suppkey").alias("Animal"),
                       F.col("l_linenumber").alias("Result"), F.floor("l_quantity").cast("int").alias("Days"),
                       F.col("l_partkey").alias("Service"), F.col("l_orderkey").alias("OpID"))
    cows = table(spark, sf, "customer").select(F.col("c_custkey").alias("ID_VACA"), F.col("c_name").alias("Nombre_Vaca"))
    stored = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ID_Actividad"))
    rmap = table(spark, sf, "nation").select(F.col("n_nationkey").alias("ID"), F.col("n_regionkey").alias("id_resultado_destino"))
    return H.detail_load(_operations(spark, sf), detail, stored, cows, H.DIAGNOSIS, result_map=rmap)


def q_job_diagnosis_activities(spark, sf):
    """Activities of the diagnosis extract with their new ids."""
    a = _diagnosis(spark, sf)["activities"]
    return a.select("ID_Actividad", "ID_VACA", "ID_TipoOperacion", F.col("ID_Resultado").cast("int").alias("ID_Resultado"),
                    "ID_OPERARIO", "ID_Categoria", F.date_format("Fecha", "yyyy-MM-dd").alias("Fecha"), "Comentario")


def q_job_diagnosis_detail(spark, sf):
    """Diagnosis detail rows pointing at the new activity ids."""
    return _diagnosis(spark, sf)["detail"].select("IDdiagpre", "ID_VACA", "ID_Resultado", "Dias", "ID_servicio",
                                                  "ID_ACTIVIDAD")


SQL_DIAG = """ops AS (SELECT o_orderkey AS Old_ID, o_custkey AS ID_VACA,
    CASE o_orderpriority WHEN '1-URGENT' THEN 91 WHEN '2-HIGH' THEN 92 WHEN '3-MEDIUM' THEN 96
      WHEN '4-NOT SPECIFIED' THEN 106 ELSE 23 END AS op,
    CAST(o_custkey % 30 AS INTEGER) AS res, CAST(o_custkey % 25 AS INTEGER) AS off, o_orderdate AS Fecha,
    o_orderstatus AS Comentario FROM orders),
acts AS (SELECT DISTINCT Old_ID, ID_VACA,
    CAST(CASE op WHEN 91 THEN 7 WHEN 92 THEN 4 WHEN 93 THEN 5 WHEN 96 THEN 3 WHEN 101 THEN 3 WHEN 102 THEN 5 ELSE 6 END
      AS INTEGER) AS ID_TipoOperacion, res,
    CAST(CASE off WHEN 3 THEN 33 WHEN 7 THEN 25 WHEN 12 THEN 36 WHEN 13 THEN 9 WHEN 15 THEN 9 WHEN 17 THEN 7
      WHEN 19 THEN 2 WHEN 20 THEN 23 ELSE 35 END AS INTEGER) AS ID_OPERARIO,
    18 AS ID_Categoria, Fecha, Comentario
  FROM ops WHERE op IN (91, 92, 93, 96, 101, 102, 106)),
ids AS (SELECT a.*, CAST(coalesce(n.n_regionkey, 34) AS INTEGER) AS ID_Resultado,
    (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY Old_ID) AS ID_Actividad
  FROM acts a LEFT JOIN nation n ON a.res = n.n_nationkey)"""

SQL["job_diagnosis_activities"] = f"""WITH {SQL_DIAG}
SELECT ID_Actividad, ID_VACA, ID_TipoOperacion, ID_Resultado, ID_OPERARIO, ID_Categoria,
  strftime(Fecha, '%Y-%m-%d') AS Fecha, Comentario FROM ids"""

SQL["job_diagnosis_detail"] = f"""WITH {SQL_DIAG},
d AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS IDdiagpre, l_suppkey AS ID_VACA, l_linenumber AS ID_Resultado,
    CAST(floor(l_quantity) AS INTEGER) AS Dias, l_partkey AS ID_servicio, l_orderkey AS op_id FROM lineitem)
SELECT d.IDdiagpre, d.ID_VACA, d.ID_Resultado, d.Dias, d.ID_servicio, ids.ID_Actividad AS ID_ACTIVIDAD
FROM d LEFT JOIN ids ON d.op_id = ids.Old_ID"""


QUERIES = {
    "job_daily_tracking": q_job_daily_tracking,
    "job_herd_milk": q_job_herd_milk,
    "job_diagnosis_activities": q_job_diagnosis_activities,
    "job_diagnosis_detail": q_job_diagnosis_detail,
}
