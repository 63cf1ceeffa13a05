"""The paddock and series jobs (B1 B6-B9 B20 B21), run through their own functions on landed shared tables.

Paddock log: ``job_queries.landed_log`` with the cases that its clean form has not: every 13th event has no activity,
every 11th grazing row no herd, every 7th error an activity without an id, small values a forage without an id.
Satellite bands: events as (paddock, band = type, day, value).  Soil: parts as property rows (sector text as in
``split_explode``), dated over forty days by part key, with nulls in the element columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from . import paddock_jobs as J
from . import series_jobs as S
from .function_queries import _sectors
from .function_queries import SQL as FUNCTION_SQL
from .job_queries import HERDS, landed_log, paddock_dim

SQL = {}


def odd_log(spark, sf):
    e = F.col("row_id")
    grazing = F.col("ACTIVIDAD") == "PASTOREO"
    d = landed_log(spark, sf)
    return d.withColumns({
        "HATO": F.when(e % 11 != 0, F.col("HATO")),
        "TIPO DE FORRAJE": F.when(grazing & (F.col("LECHE TOTAL") < 20), "ESTRELLA").otherwise(F.col("TIPO DE FORRAJE")),
        "ACTIVIDAD": F.when(e % 13 != 0, F.when((F.col("ACTIVIDAD") == "ROTOBO") & (e % 7 == 0), "CHAPEO")
                            .otherwise(F.col("ACTIVIDAD")))})


_HERDS = "[" + ", ".join(f"'{h}'" for h in HERDS) + "]"
SQL_LOG = f"""l AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, value,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS fecha,
    CASE WHEN user_id < 10 THEN 'RC0' ELSE 'RC' END || CAST(user_id AS VARCHAR) AS lote_c,
    CASE WHEN event_id % 13 <> 0 THEN CASE event_type WHEN 'purchase' THEN 'PASTOREO' WHEN 'click' THEN 'FUMIGADA'
      WHEN 'signup' THEN 'SIEMBRA' WHEN 'view' THEN 'ABONADA'
      WHEN 'error' THEN CASE WHEN event_id % 7 = 0 THEN 'CHAPEO' ELSE 'ROTOBO' END END END AS act,
    CASE WHEN event_type = 'purchase' AND event_id % 11 <> 0 THEN {_HERDS}[user_id % 5 + 1] END AS hato,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 20 THEN 'ESTRELLA' WHEN value >= 100 THEN 'RAYGRAS'
      ELSE 'KYKUYO' END END AS forage,
    CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS animals,
    CASE WHEN event_type <> 'purchase' THEN event_type END AS producto
  FROM events)"""


def _clean(spark, sf):
    return J.clean_log(odd_log(spark, sf), start=None)


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# --------------------------------------------------------------------------- B1
def q_job_raw_activities(spark, sf):
    d = J.raw_activity_load(odd_log(spark, sf))
    return d.select("FINCA", "POTRERO", "ACTIVIDAD", F.col("FECHA ACTIVIDAD").alias("fecha"), "PRODUCTO")


SQL["job_raw_activities"] = f"""WITH {SQL_LOG}
SELECT 'EL RECODO' AS FINCA, CAST(user_id AS VARCHAR) AS POTRERO, act AS ACTIVIDAD, fecha, producto AS PRODUCTO
FROM l WHERE act IS DISTINCT FROM 'PASTOREO'"""


# --------------------------------------------------------------------------- B6 forage and other activities
def q_job_forage_changes(spark, sf):
    changes, _ = J.forage_history(_clean(spark, sf), paddock_dim(spark, sf))
    return changes.select("lote_id", "lote_c", F.col("TIPO DE FORRAJE").alias("forage"),
                          _stamp("FECHA ACTIVIDAD").alias("fecha"))


SQL_FORAGE = f"""{SQL_LOG},
ch AS (SELECT user_id AS lote_id, lote_c, forage, max(fecha) AS fecha FROM l WHERE act = 'PASTOREO' GROUP BY ALL)"""
SQL["job_forage_changes"] = f"WITH {SQL_FORAGE} SELECT lote_id, lote_c, forage, fecha FROM ch"
SQL_CURRENT = f"""{SQL_FORAGE},
cur AS (SELECT lote_id, lote_c, forage FROM ch
  QUALIFY row_number() OVER (PARTITION BY lote_id, lote_c ORDER BY fecha DESC, forage DESC) = 1)"""


def q_job_forage_current(spark, sf):
    _, current = J.forage_history(_clean(spark, sf), paddock_dim(spark, sf))
    return current.select("lote_id", "lote_c", F.col("TIPO DE FORRAJE").alias("forage"))


SQL["job_forage_current"] = f"WITH {SQL_CURRENT} SELECT lote_id, lote_c, forage FROM cur"


def q_job_forage_payload(spark, sf):
    """The PATCH bodies; a forage without an id goes by its name."""
    _, current = J.forage_history(_clean(spark, sf), paddock_dim(spark, sf))
    return J.forage_payload(current).select("ID_LOTE", "payload")


SQL["job_forage_payload"] = f"""WITH {SQL_CURRENT}
SELECT CAST(lote_id AS INTEGER) AS ID_LOTE, '{{"ID_LOTE":' || CAST(lote_id AS VARCHAR) || ',"ID_variedad":' ||
  CASE forage WHEN 'KYKUYO' THEN '1' WHEN 'RAYGRAS' THEN '2' ELSE '"' || forage || '"' END || '}}' AS payload FROM cur"""


def q_job_other_activities(spark, sf):
    o = J.other_activities(_clean(spark, sf), paddock_dim(spark, sf))
    return o.select("lote_id", "lote_c", _stamp("FECHA ACTIVIDAD").alias("fecha"), "ACTIVIDAD", "PRODUCTO")


SQL["job_other_activities"] = f"""WITH {SQL_LOG}
SELECT user_id AS lote_id, lote_c, fecha, act AS ACTIVIDAD, producto AS PRODUCTO
FROM l WHERE act IS DISTINCT FROM 'PASTOREO'"""


# --------------------------------------------------------------------------- B8
def q_job_coded_activities(spark, sf):
    d = J.coded_activity_load(J.other_activities(_clean(spark, sf), paddock_dim(spark, sf)))
    return d.withColumn("FECHA_ACTIVIDAD", _stamp("FECHA_ACTIVIDAD"))


_ACT_IDS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in J.ACTIVITY_IDS.items())
SQL["job_coded_activities"] = f"""WITH {SQL_LOG},
o AS (SELECT *, CAST(CASE act {_ACT_IDS} END AS INTEGER) AS id FROM l WHERE act IS DISTINCT FROM 'PASTOREO')
SELECT 0 AS ID_ACT_LOTE, user_id AS ID_LOTE, fecha AS FECHA_ACTIVIDAD, id AS ID_Tipo_Actividad,
  CASE WHEN id IS NULL THEN act END AS Actividad_texto, producto AS Producto, 34 AS ID_OPERARIO FROM o"""


# --------------------------------------------------------------------------- B7
def _herds(spark, sf):
    return J.herd_tracking(*J.grazing_rows(_clean(spark, sf), paddock_dim(spark, sf)))


def q_job_herd_tracking(spark, sf):
    h, _ = _herds(spark, sf)
    return h.select("lote_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "row_id", "HATO", "lote_c", "lag_1",
                    "lag_2", "lag_3", F.col("lag_ultimo_animales").cast("bigint").alias("lag_ultimo_animales"),
                    F.col("lag_dias_de_pastoreo").cast("bigint").alias("lag_dias_de_pastoreo"))


_W = "PARTITION BY user_id ORDER BY date, row_id NULLS FIRST"
_WR = f"{_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_H = "PARTITION BY hato ORDER BY date, user_id, row_id"
SQL_HERD = f"""{SQL_LOG},
b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
grid AS (SELECT k.user_id, cal.date, l.event_id AS row_id, l.act, l.hato, l.lote_c, l.animals,
    act IS NOT DISTINCT FROM 'PASTOREO' AS g
  FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN cal LEFT JOIN l ON l.user_id = k.user_id AND l.day = cal.date),
s AS (SELECT *, lag(act) OVER ({_W}) AS prev_act, CASE WHEN g THEN 1 ELSE 0 END AS graze FROM grid),
r AS (SELECT *, sum(1 - graze) OVER ({_WR}) AS gg FROM s),
q AS (SELECT *, nullif(sum(graze) OVER (PARTITION BY user_id, gg ORDER BY date, row_id NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS de0 FROM r),
st AS (SELECT *, last_value(CASE WHEN g THEN nullif(animals, 0) END IGNORE NULLS) OVER ({_WR}) AS ua,
    last_value(de0 IGNORE NULLS) OVER ({_WR}) AS de, coalesce(act = prev_act, false) AS same FROM q),
gz AS (SELECT *, lag(ua) OVER ({_W}) AS pa, lag(de) OVER ({_W}) AS pd FROM st WHERE g),
w7 AS (SELECT *, last_value(CASE WHEN NOT same THEN pa END IGNORE NULLS) OVER ({_WR}) AS lag_a,
    last_value(CASE WHEN NOT same THEN pd END IGNORE NULLS) OVER ({_WR}) AS lag_d FROM gz),
c AS (SELECT *, lote_c IS DISTINCT FROM lag(lote_c) OVER ({_H}) AS cp FROM w7 WHERE hato IS NOT NULL),
cl AS (SELECT row_id AS rid, lag(lote_c, 1) OVER ({_H}) AS l1, lag(lote_c, 2) OVER ({_H}) AS l2,
    lag(lote_c, 3) OVER ({_H}) AS l3 FROM c WHERE cp),
pl AS (SELECT c.user_id, c.date, c.row_id, c.hato, c.lote_c, c.lag_a, c.lag_d,
    last_value(l1 IGNORE NULLS) OVER w AS lag_1, last_value(l2 IGNORE NULLS) OVER w AS lag_2,
    last_value(l3 IGNORE NULLS) OVER w AS lag_3
  FROM c LEFT JOIN cl ON c.row_id = cl.rid
  WINDOW w AS ({_H} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT user_id, date, row_id, hato, lote_c, lag_a, lag_d, NULL, NULL, NULL FROM w7 WHERE hato IS NULL)"""
SQL["job_herd_tracking"] = f"""WITH {SQL_HERD}
SELECT user_id AS lote_id, CAST(date AS VARCHAR) AS date, row_id, hato AS HATO, lote_c, lag_1, lag_2, lag_3,
  CAST(lag_a AS BIGINT) AS lag_ultimo_animales, CAST(lag_d AS BIGINT) AS lag_dias_de_pastoreo FROM pl"""


def q_job_herd_path_long(spark, sf):
    _, solo = _herds(spark, sf)
    return solo.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "HATO", "variable", "value", "HATO_C")


SQL["job_herd_path_long"] = f"""WITH {SQL_HERD},
m AS (SELECT date, hato, 'lote_c' AS variable, lote_c AS value FROM pl UNION ALL SELECT date, hato, 'lag_1', lag_1 FROM pl
  UNION ALL SELECT date, hato, 'lag_2', lag_2 FROM pl UNION ALL SELECT date, hato, 'lag_3', lag_3 FROM pl)
SELECT CAST(date AS VARCHAR) AS date, hato AS HATO, variable, value,
  CASE variable WHEN 'lag_1' THEN hato || '_1' WHEN 'lag_2' THEN hato || '_2' WHEN 'lag_3' THEN hato || '_3'
    ELSE hato END AS HATO_C FROM m"""


# --------------------------------------------------------------------------- B20
def _bands(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("lote_id"), F.concat(F.lit("RC"), F.col("user_id").cast("string")).alias("name_c"),
        F.col("event_type").alias("band"), F.date_trunc("day", "ts").alias("date"), F.col("value").alias("mean_value"))
    return S.band_series(e, ["click", "view"], start="20240103")


def q_job_band_rows(spark, sf):
    filtered, _, _ = _bands(spark, sf)
    return filtered.select("lote_id", "name_c", "band", F.date_format("date", "yyyy-MM-dd").alias("date"), "mean_value")


SQL_BANDS = """b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
k AS (SELECT DISTINCT user_id, event_type AS band FROM events),
g AS (SELECT k.user_id, k.band, cal.date, e.value, strftime(cal.date, '%Y-%m') AS ym
  FROM k CROSS JOIN cal LEFT JOIN events e ON e.user_id = k.user_id AND e.event_type = k.band AND CAST(e.ts AS DATE) = cal.date
  WHERE cal.date >= DATE '2024-01-03')"""
SQL["job_band_rows"] = f"""WITH {SQL_BANDS}
SELECT user_id AS lote_id, 'RC' || CAST(user_id AS VARCHAR) AS name_c, band, CAST(date AS VARCHAR) AS date,
  value AS mean_value FROM g WHERE band IN ('click', 'view')"""


def q_job_band_documents(spark, sf):
    return _bands(spark, sf)[2]


SQL["job_band_documents"] = f"""WITH {SQL_BANDS},
per AS (SELECT user_id, ym, band AS k, '"' || band || '":[' || string_agg(CASE WHEN value IS NULL THEN 'null'
    ELSE '"' || CAST(value AS VARCHAR) || '"' END, ',' ORDER BY date, value) || ']' AS part FROM g GROUP BY user_id, ym, band),
ds AS (SELECT user_id, ym, '"' || ym || '":[' || string_agg(DISTINCT '"' || strftime(date, '%Y-%m-%d') || '"', ','
    ORDER BY '"' || strftime(date, '%Y-%m-%d') || '"') || ']' AS part FROM g GROUP BY user_id, ym),
allp AS (SELECT user_id, ym, ym AS k, part FROM ds UNION ALL SELECT user_id, ym, k, part FROM per)
SELECT CAST(user_id AS VARCHAR) || '/' || ym AS key, '{{' || string_agg(part, ',' ORDER BY k) || '}}' AS json
FROM allp GROUP BY user_id, ym"""


# --------------------------------------------------------------------------- B21
ELEMENTS = ["N", "P", "K", "CA", "MG"]
SOIL_THRESH, SOIL_START = 8, "20240110"


def _soil_props(spark, sf):
    s = _sectors(spark, sf)
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    j = s.join(p, "p_partkey")
    fecha = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 40).cast("int"))
    price = F.col("p_retailprice").cast("double")
    return j.select(
        F.col("p_partkey").alias("row_id"), F.col("farm").alias("FINCA"), F.col("sector").alias("SECTOR"),
        F.date_format(fecha, "MM/dd/yyyy").alias("FECHA"), price.alias("N"),
        *[F.when(F.col("p_partkey") % k != 0, F.col("p_size").cast("double") * k).alias(e)
          for k, e in ((2, "P"), (3, "K"), (5, "CA"), (7, "MG"))])


def _soil_job(spark, sf):
    return S.soil_chemistry(_soil_props(spark, sf), ELEMENTS, SOIL_START, thresh=SOIL_THRESH)


def q_job_soil_filled(spark, sf):
    kept = _soil_job(spark, sf)[0]
    return kept.select("name_c", F.date_format("date", "yyyy-MM-dd").alias("date"), "FINCA", "SECTOR", *ELEMENTS)


_SPLIT = FUNCTION_SQL["split_explode"]
SQL_SOIL = f"""names AS ({_SPLIT}),
props AS (SELECT p_partkey AS row_id, CASE WHEN p_size % 2 = 0 THEN 'RECODO' ELSE 'ISLA' END AS FINCA,
    ['LOTE', 'JUNCAL', 'PARAISO', 'MANGA LARGA'][p_size % 4 + 1] || ' ' || CAST(p_size % 9 + 1 AS VARCHAR) || ','
      || CAST(p_size % 13 + 2 AS VARCHAR) || ':' || CAST(p_partkey % 7 AS VARCHAR) || ',x,' || CAST(p_size % 5 + 8 AS VARCHAR) AS SECTOR,
    CAST(DATE '2024-01-01' + CAST(p_partkey % 40 AS INTEGER) AS DATE) AS fecha, CAST(p_retailprice AS DOUBLE) AS N,
    CASE WHEN p_partkey % 2 <> 0 THEN p_size * 2.0::DOUBLE END AS P, CASE WHEN p_partkey % 3 <> 0 THEN p_size * 3.0::DOUBLE END AS K,
    CASE WHEN p_partkey % 5 <> 0 THEN p_size * 5.0::DOUBLE END AS CA, CASE WHEN p_partkey % 7 <> 0 THEN p_size * 7.0::DOUBLE END AS MG
  FROM part),
pr AS (SELECT n.name_c, p.* FROM names n JOIN props p ON n.p_partkey = p.row_id),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(fecha) FROM pr), (SELECT max(fecha) FROM pr), INTERVAL 1 DAY)) AS DATE) AS date),
f AS (SELECT k.name_c, cal.date, {", ".join(f"last_value(pr.{c} IGNORE NULLS) OVER w AS {c}" for c in ["FINCA", "SECTOR", *ELEMENTS])}
  FROM (SELECT DISTINCT name_c FROM pr) k CROSS JOIN cal LEFT JOIN pr ON pr.name_c = k.name_c AND pr.fecha = cal.date
  WHERE cal.date >= DATE '2024-01-10'
  WINDOW w AS (PARTITION BY k.name_c ORDER BY cal.date, pr.row_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_CELLS = ["name_c", "date", "FINCA", "SECTOR", *ELEMENTS]
_FULL = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _CELLS)
SQL["job_soil_filled"] = f"""WITH {SQL_SOIL}
SELECT name_c, CAST(date AS VARCHAR) AS date, FINCA, SECTOR, {", ".join(ELEMENTS)} FROM f WHERE {_FULL} >= {SOIL_THRESH}"""


def q_job_soil_completeness(spark, sf):
    return _soil_job(spark, sf)[5].select("total_cells", "na_cells", F.round("na_ratio", 6).alias("na_ratio"))


_NA = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _CELLS)
SQL["job_soil_completeness"] = f"""WITH {SQL_SOIL}
SELECT CAST(count(*) * {len(_CELLS)} AS BIGINT) AS total_cells, CAST({_NA} AS BIGINT) AS na_cells,
  round(CAST({_NA} AS DOUBLE) / (count(*) * {len(_CELLS)}), 6) AS na_ratio FROM f"""


def q_job_soil_changes(spark, sf):
    return _soil_job(spark, sf)[1].select(F.date_format("FECHA", "yyyy-MM-dd").alias("fecha"))


SQL["job_soil_changes"] = """SELECT DISTINCT CAST(CAST(DATE '2024-01-01' + CAST(p_partkey % 40 AS INTEGER) AS DATE) AS VARCHAR) AS fecha
FROM part WHERE DATE '2024-01-01' + CAST(p_partkey % 40 AS INTEGER) >= DATE '2024-01-10'"""


QUERIES = {
    "job_raw_activities": q_job_raw_activities,
    "job_forage_changes": q_job_forage_changes,
    "job_forage_current": q_job_forage_current,
    "job_forage_payload": q_job_forage_payload,
    "job_other_activities": q_job_other_activities,
    "job_coded_activities": q_job_coded_activities,
    "job_herd_tracking": q_job_herd_tracking,
    "job_herd_path_long": q_job_herd_path_long,
    "job_band_rows": q_job_band_rows,
    "job_band_documents": q_job_band_documents,
    "job_soil_filled": q_job_soil_filled,
    "job_soil_completeness": q_job_soil_completeness,
    "job_soil_changes": q_job_soil_changes,
}
