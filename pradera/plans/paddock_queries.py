"""Paddock time-series queries on the shared ``events`` table.

Stand-ins: paddock = ``user_id``; activity = ``event_type`` with ``purchase``
as grazing; animals = ``floor(value)``; milk = ``value``; herd =
``'HATO ' || user_id % 5`` (a paddock -> herd mapping); forage =
RAYGRAS/KYKUYO from the value of a grazing row.  Rows are ordered by
(day, ts, event_id) inside a paddock; calendar-filled days have a null ts.

Each ``q_*`` returns the Spark DataFrame; ``SQL`` holds the DuckDB oracle.
Dates are returned as ``yyyy-MM-dd`` text so both engines hash alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import latest_by, last_non_null_by_group
from ..operators.calendar import dense_grid
from ..operators.reshape import unpivot
from ..operators.intervals import days, fact_days, fact_rows, filled, grazing, rows_since
from ..operators.runs import movement_path, previous_run_values
from ..functions.recode import recode_with_fallback
from ..functions.codes import herd_label
from ..sources.tables import table

def order():
    """Row order inside a paddock / herd: day, then event time, then event id."""
    return [F.col("date"), F.col("ts"), F.col("event_id")]
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

SQL_ORDER = "date, ts NULLS FIRST, event_id NULLS FIRST"
SQL_GRID = """
b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
grid AS (
  SELECT k.user_id, cal.date, e.event_id, e.ts, e.event_type, e.value
  FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN cal
  LEFT JOIN events e ON e.user_id = k.user_id AND CAST(e.ts AS DATE) = cal.date)"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def events_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Dense paddock x day grid with the day's events (fan-out kept)."""
    e = events(spark, sf)
    return dense_grid(e, ["user_id"], e, ["user_id"], "ts")


def event_days(spark: SparkSession, sf: str, extra=(), activity: str | None = "event_type"):
    """The events as the facts of that grid (``extra``: columns on top)."""
    e = events(spark, sf).withColumns(dict(extra))
    return fact_days(e, ["user_id"], e, ["user_id"], "ts", ["ts", "event_id"], activity=activity)


def _ds(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd")


# --------------------------------------------------------------------------- R3 J10 J11
def q_calendar_grid(spark, sf):
    g = events_grid(spark, sf)
    return g.select("user_id", _ds("date").alias("date"), "event_id", "event_type", "value")


SQL = {}
SQL["calendar_grid"] = f"""WITH {SQL_GRID}
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id, event_type, value FROM grid"""


# --------------------------------------------------------------------------- W3
def q_since_purchase(spark, sf):
    """W3 with zeros as null: rows since the last purchase (0 -> null)."""
    d = rows_since(event_days(spark, sf), "event_type", ["purchase"], first=False)
    return d.select("user_id", _ds("date").alias("date"), "event_id",
                    F.nullif(F.col("dias_sin_purchase"), F.lit(0)).cast("bigint").alias("dias_sin_purchase"))


SQL["since_purchase"] = f"""WITH {SQL_GRID},
f AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM 'purchase' THEN 0 ELSE 1 END AS flag FROM grid),
r AS (SELECT *, sum(1 - flag) OVER (PARTITION BY user_id ORDER BY {SQL_ORDER}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM f)
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id,
  CAST(nullif(sum(flag) OVER (PARTITION BY user_id, grp ORDER BY {SQL_ORDER}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS dias_sin_purchase
FROM r"""


# --------------------------------------------------------------------------- W1 W5
def q_since_all_types(spark, sf):
    d = rows_since(event_days(spark, sf), "event_type", EVENT_TYPES)
    cols = [F.col(f"dias_sin_{t}").cast("bigint").alias(f"dias_sin_{t}") for t in EVENT_TYPES]
    return d.select("user_id", _ds("date").alias("date"), "event_id", *cols)


def _sql_since_all():
    flags = ",\n  ".join(
        f"CASE WHEN pos = 1 OR event_type IS NOT DISTINCT FROM '{t}' THEN 0 ELSE 1 END AS f_{t}"
        for t in EVENT_TYPES)
    grps = ",\n  ".join(
        f"sum(1 - f_{t}) OVER (PARTITION BY user_id ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g_{t}"
        for t in EVENT_TYPES)
    outs = ",\n  ".join(
        f"CAST(sum(f_{t}) OVER (PARTITION BY user_id, g_{t} ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS dias_sin_{t}"
        for t in EVENT_TYPES)
    return f"""WITH {SQL_GRID},
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {SQL_ORDER}) AS pos FROM grid),
f AS (SELECT *,
  {flags} FROM p),
r AS (SELECT *,
  {grps} FROM f)
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id,
  {outs}
FROM r"""


SQL["since_all_types"] = _sql_since_all()


# --------------------------------------------------------------------------- W2 W4 W6 W11 T9
def _state(spark, sf, paddock_output=True):
    purchase = F.col("event_type") == "purchase"
    facts = event_days(spark, sf, {
        "animals": F.floor("value").cast("bigint"),
        "forage": F.when(purchase, F.when(F.col("value") >= 100, "RAYGRAS").otherwise("KYKUYO"))})
    return grazing(facts, activity="event_type", animals="animals", grazing="purchase", fill=["forage"],
                   paddock_output=paddock_output)


def q_grazing_state(spark, sf):
    d = days(*_state(spark, sf))
    return d.select("user_id", _ds("date").alias("date"), "event_id", "event_type", "forage",
                    _ds("ultimo_pastoreo").alias("ultimo_pastoreo"),
                    F.col("ultimo_animales").cast("bigint").alias("ultimo_animales"),
                    F.col("dias_de_pastoreo").cast("bigint").alias("dias_de_pastoreo"),
                    F.col("dias_sin_pastoreo").cast("bigint").alias("dias_sin_pastoreo"),
                    "lote_change", "actividad_change")


SQL_STATE = f"""WITH {SQL_GRID},
s AS (SELECT *, (event_type IS NOT DISTINCT FROM 'purchase') AS g,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN value >= 100 THEN 'RAYGRAS' ELSE 'KYKUYO' END END AS forage0,
    CAST(floor(value) AS BIGINT) AS animals,
    row_number() OVER w AS pos, lag(event_type) OVER w AS prev_act
  FROM grid WINDOW w AS (PARTITION BY user_id ORDER BY {SQL_ORDER})),
f AS (SELECT *, CASE WHEN pos = 1 OR g THEN 0 ELSE 1 END AS rest, CASE WHEN g THEN 1 ELSE 0 END AS graze FROM s),
r AS (SELECT *, sum(1 - rest) OVER w AS gr, sum(1 - graze) OVER w AS gg FROM f
  WINDOW w AS (PARTITION BY user_id ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *,
    nullif(sum(rest) OVER (PARTITION BY user_id, gr ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS sin0,
    nullif(sum(graze) OVER (PARTITION BY user_id, gg ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS de0
  FROM r),
st AS (SELECT user_id, date, ts, event_id, event_type, value, g,
    last_value(forage0 IGNORE NULLS) OVER w AS forage,
    last_value(CASE WHEN g THEN date END IGNORE NULLS) OVER w AS ultimo_pastoreo,
    last_value(CASE WHEN g THEN nullif(animals, 0) END IGNORE NULLS) OVER w AS ultimo_animales,
    last_value(de0 IGNORE NULLS) OVER w AS dias_de_pastoreo,
    last_value(sin0 IGNORE NULLS) OVER w AS dias_sin_pastoreo,
    pos = 1 AS lote_change,
    coalesce(event_type = prev_act, false) AS actividad_change
  FROM q WINDOW w AS (PARTITION BY user_id ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

SQL["grazing_state"] = f"""{SQL_STATE}
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id, event_type, forage,
  CAST(ultimo_pastoreo AS VARCHAR) AS ultimo_pastoreo,
  CAST(ultimo_animales AS BIGINT) AS ultimo_animales,
  CAST(dias_de_pastoreo AS BIGINT) AS dias_de_pastoreo,
  CAST(CASE WHEN g THEN 0 ELSE dias_sin_pastoreo END AS BIGINT) AS dias_sin_pastoreo,
  lote_change, actividad_change
FROM st"""


# --------------------------------------------------------------------------- W7
def q_prev_run_values(spark, sf):
    d, layout = fact_rows(*_state(spark, sf, paddock_output=False), where=F.col("event_type") == "purchase")
    p = previous_run_values(d, ["user_id"], order(), activity="event_type", grazing="purchase", layout=layout)
    return p.select("user_id", _ds("date").alias("date"), "event_id",
                    F.col("lag_ultimo_animales").cast("bigint").alias("lag_ultimo_animales"),
                    F.col("lag_dias_de_pastoreo").cast("bigint").alias("lag_dias_de_pastoreo"))


SQL["prev_run_values"] = f"""{SQL_STATE},
gz AS (SELECT *, lag(ultimo_animales) OVER w AS pa, lag(dias_de_pastoreo) OVER w AS pd
  FROM st WHERE g WINDOW w AS (PARTITION BY user_id ORDER BY {SQL_ORDER}))
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id,
  CAST(last_value(CASE WHEN NOT actividad_change THEN pa END IGNORE NULLS) OVER w AS BIGINT) AS lag_ultimo_animales,
  CAST(last_value(CASE WHEN NOT actividad_change THEN pd END IGNORE NULLS) OVER w AS BIGINT) AS lag_dias_de_pastoreo
FROM gz WINDOW w AS (PARTITION BY user_id ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


# --------------------------------------------------------------------------- W8 W9 R1 F3
def _herd_rows(spark, sf):
    e = events(spark, sf).filter(F.col("event_type") == "purchase")
    return e.select(F.concat(F.lit("HATO "), (F.col("user_id") % 5).cast("string")).alias("herd"),
                    F.col("user_id").alias("lote"), F.to_date("ts").alias("date"), "ts", "event_id")


def _path(spark, sf):
    return movement_path(_herd_rows(spark, sf), ["herd"], order(), place="lote", depth=3)


def q_path_lags(spark, sf):
    p = _path(spark, sf)
    return p.select("herd", _ds("date").alias("date"), "event_id", "lote", "lag_1", "lag_2", "lag_3")


SQL_PATH = f"""hz AS (SELECT 'HATO ' || CAST(user_id % 5 AS VARCHAR) AS herd, user_id AS lote,
    CAST(ts AS DATE) AS date, ts, event_id FROM events WHERE event_type = 'purchase'),
c AS (SELECT *, lote IS DISTINCT FROM lag(lote) OVER (PARTITION BY herd ORDER BY {SQL_ORDER}) AS cp FROM hz),
cl AS (SELECT event_id, lag(lote, 1) OVER w AS l1, lag(lote, 2) OVER w AS l2, lag(lote, 3) OVER w AS l3
  FROM c WHERE cp WINDOW w AS (PARTITION BY herd ORDER BY {SQL_ORDER})),
pl AS (SELECT c.herd, c.date, c.ts, c.event_id, c.lote,
    last_value(cl.l1 IGNORE NULLS) OVER w AS lag_1,
    last_value(cl.l2 IGNORE NULLS) OVER w AS lag_2,
    last_value(cl.l3 IGNORE NULLS) OVER w AS lag_3
  FROM c LEFT JOIN cl ON c.event_id = cl.event_id
  WINDOW w AS (PARTITION BY c.herd ORDER BY c.date, c.ts NULLS FIRST, c.event_id NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

SQL["path_lags"] = f"""WITH {SQL_PATH}
SELECT herd, CAST(date AS VARCHAR) AS date, event_id, lote, lag_1, lag_2, lag_3 FROM pl"""


def q_path_unpivot(spark, sf):
    p = _path(spark, sf).select("date", "herd", F.col("lote").alias("lote_c"), "lag_1", "lag_2", "lag_3")
    u = unpivot(p, ["date", "herd"], ["lote_c", "lag_1", "lag_2", "lag_3"])
    return u.select(_ds("date").alias("date"), "herd", "variable", "value",
                    herd_label("herd", "variable").alias("herd_c"))


SQL["path_unpivot"] = f"""WITH {SQL_PATH},
m AS (SELECT date, herd, 'lote_c' AS variable, lote AS value FROM pl
  UNION ALL SELECT date, herd, 'lag_1', lag_1 FROM pl
  UNION ALL SELECT date, herd, 'lag_2', lag_2 FROM pl
  UNION ALL SELECT date, herd, 'lag_3', lag_3 FROM pl)
SELECT CAST(date AS VARCHAR) AS date, herd, variable, value,
  CASE variable WHEN 'lag_1' THEN herd || '_1' WHEN 'lag_2' THEN herd || '_2'
    WHEN 'lag_3' THEN herd || '_3' ELSE herd END AS herd_c
FROM m"""


# --------------------------------------------------------------------------- A2 A3 T6
def _forage_rows(spark, sf):
    e = events(spark, sf).filter(F.col("event_type") == "purchase")
    return e.select("user_id", F.to_date("ts").alias("date"),
                    F.when(F.col("value") >= 100, "RAYGRAS").otherwise("KYKUYO").alias("forage"))


def _forage_changes(spark, sf):
    return last_non_null_by_group(_forage_rows(spark, sf), ["user_id", "forage"], "date", "date")


def q_forage_changes(spark, sf):
    return _forage_changes(spark, sf).select("user_id", "forage", _ds("date").alias("last_date"))


SQL_FORAGE = """fr AS (SELECT user_id, CAST(ts AS DATE) AS date,
    CASE WHEN value >= 100 THEN 'RAYGRAS' ELSE 'KYKUYO' END AS forage
  FROM events WHERE event_type = 'purchase'),
fc AS (SELECT user_id, forage, max(date) AS last_date FROM fr GROUP BY user_id, forage)"""

SQL["forage_changes"] = f"""WITH {SQL_FORAGE}
SELECT user_id, forage, CAST(last_date AS VARCHAR) AS last_date FROM fc"""


def q_forage_current(spark, sf):
    c = _forage_changes(spark, sf)
    return latest_by(c, ["user_id"], "forage", [F.col("date"), F.col("forage")])


SQL["forage_current"] = f"""WITH {SQL_FORAGE}
SELECT user_id, forage FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_date DESC, forage DESC) AS rn FROM fc)
WHERE rn = 1"""


def q_forage_current_legacy(spark, sf):
    c = _forage_changes(spark, sf)
    return c.groupBy("user_id").agg(F.max("forage").alias("forage"))


SQL["forage_current_legacy"] = f"""WITH {SQL_FORAGE}
SELECT user_id, max(forage) AS forage FROM fc GROUP BY user_id"""


# --------------------------------------------------------------------------- B10: P7 F13 A1 P6 T3
# fixed values of the stand-in herd-name -> herd-id map (unmapped names stay as text)
HERD_IDS = {"HATO 0": 1, "HATO 1": 2, "HATO 2": 3, "HATO 3": 1}


def q_herd_daily_sum(spark, sf):
    from ..operators.aggregate import herd_day_totals
    e = events(spark, sf).filter(F.col("event_type") == "purchase")
    e = e.select(F.concat(F.lit("HATO "), (F.col("user_id") % 5).cast("string")).alias("herd"),
                 F.to_date("ts").alias("fecha"),
                 F.nullif(F.floor("value").cast("bigint"), F.lit(0)).alias("animals"),
                 F.col("value").alias("milk"))
    e = e.filter(F.col("milk") > 0)
    e = recode_with_fallback(e, "herd", HERD_IDS, id_col="id_hato", raw_col="hato_raw")
    g = herd_day_totals(e, ["id_hato", "hato_raw", "fecha"], animals="animals", milk="milk", operator_id=35)
    return g.select("id_hato", "hato_raw", _ds("fecha").alias("fecha"),
                    F.col("numero_animales").cast("bigint").alias("numero_animales"),
                    F.round("leche_total", 4).alias("leche_total"), "id_operario")


SQL["herd_daily_sum"] = """WITH e AS (
  SELECT 'HATO ' || CAST(user_id % 5 AS VARCHAR) AS herd, CAST(ts AS DATE) AS fecha,
    nullif(CAST(floor(value) AS BIGINT), 0) AS animals, value AS milk
  FROM events WHERE event_type = 'purchase' AND value > 0),
m AS (SELECT *, CASE herd WHEN 'HATO 0' THEN 1 WHEN 'HATO 1' THEN 2 WHEN 'HATO 2' THEN 3 WHEN 'HATO 3' THEN 1 END AS id_hato FROM e)
SELECT CAST(id_hato AS INTEGER) AS id_hato, CASE WHEN id_hato IS NULL THEN herd END AS hato_raw,
  CAST(fecha AS VARCHAR) AS fecha,
  CAST(coalesce(sum(animals), 0) AS BIGINT) AS numero_animales,
  round(coalesce(sum(milk), 0), 4) AS leche_total, 35 AS id_operario
FROM m GROUP BY id_hato, CASE WHEN id_hato IS NULL THEN herd END, fecha"""


# --------------------------------------------------------------------------- P8 T1
def q_ne_null_safe(spark, sf):
    from ..operators.select import not_equal_keep_null
    g = events_grid(spark, sf)
    return not_equal_keep_null(g, "event_type", "purchase").select(
        "user_id", _ds("date").alias("date"), "event_id", "event_type")


SQL["ne_null_safe"] = f"""WITH {SQL_GRID}
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id, event_type FROM grid
WHERE event_type IS DISTINCT FROM 'purchase'"""


# --------------------------------------------------------------------------- W6 forward fill alone
def q_fill_forward(spark, sf):
    d = filled(event_days(spark, sf, {"v_view": F.when(F.col("event_type") == "view", F.col("value"))}, None), ["v_view"])
    return d.select("user_id", _ds("date").alias("date"), "event_id", "v_view")


SQL["fill_forward"] = f"""WITH {SQL_GRID}
SELECT user_id, CAST(date AS VARCHAR) AS date, event_id,
  last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id
    ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_view
FROM grid"""


QUERIES = {
    "calendar_grid": q_calendar_grid,
    "since_purchase": q_since_purchase,
    "since_all_types": q_since_all_types,
    "grazing_state": q_grazing_state,
    "prev_run_values": q_prev_run_values,
    "path_lags": q_path_lags,
    "path_unpivot": q_path_unpivot,
    "forage_changes": q_forage_changes,
    "forage_current": q_forage_current,
    "forage_current_legacy": q_forage_current_legacy,
    "herd_daily_sum": q_herd_daily_sum,
    "ne_null_safe": q_ne_null_safe,
    "fill_forward": q_fill_forward,
}
