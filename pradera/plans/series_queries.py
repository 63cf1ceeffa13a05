"""Satellite-band series (B20) and soil-chemistry fill (B21) on ``events``.

Stand-ins: paddock = ``user_id``; band = ``event_type``; the band's values of a
day = the values of that day's events of the type, all of them, in event
order; soil element columns = the value of each event type.  The
calendar runs from the first to the last event day; days before ``START``
are cut before the join (trap T13: a value dated earlier is not carried in).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import format_date
from ..operators.aggregate import change_dates, completeness, nested_series
from ..operators.calendar import date_bounds, key_days
from ..operators.intervals import fact_days, filled
from ..operators.select import keep_min_non_null
from ..sources.sinks import nested_documents
from ..sources.tables import table
from .paddock_queries import EVENT_TYPES

SQL = {}
START = "20240103"
START_SQL = "DATE '2024-01-03'"


def _band_grid(spark, sf, start=START):
    """B20 front: (paddock, band) x days, left joined with all values of the band, from ``start`` on."""
    e = table(spark, sf, "events").select(
        "user_id", F.col("event_type").alias("band"), F.to_date("ts").alias("day"), "event_id", "value")
    lo, hi = date_bounds(e, "day")
    grid = key_days(e, ["user_id", "band"], lo, hi, "date")
    grid = grid.filter(F.col("date") >= F.to_date(F.lit(start), "yyyyMMdd"))
    f = e.withColumnsRenamed({"user_id": "_u", "band": "_b"})
    j = grid.join(f, (F.col("user_id") == F.col("_u")) & (F.col("band") == F.col("_b")) & (F.col("date") == F.col("day")),
                  "left")
    return j.drop("_u", "_b", "day")


def _vals_text(arr):
    return F.array_join(F.transform(arr, lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ",")


def q_band_series(spark, sf):
    """A9 long form: per paddock, month and band, the values in date order (nulls kept)."""
    g = _band_grid(spark, sf).withColumn("ym", format_date("date", "yyyy-MM"))
    st = F.struct(F.col("date"), F.col("event_id"), F.col("value"))
    per = g.groupBy("user_id", "ym", "band").agg(F.array_sort(F.collect_list(st)).alias("_l"))
    return per.select("user_id", "ym", "band", _vals_text(F.transform("_l", lambda s: s["value"])).alias("vals"))


SQL_BAND = f"""b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
dv AS (SELECT user_id, event_type AS band, CAST(ts AS DATE) AS day, event_id, value FROM events),
k AS (SELECT DISTINCT user_id, band FROM dv),
g AS (SELECT k.user_id, k.band, cal.date, e.event_id, e.value, strftime(cal.date, '%Y-%m') AS ym
  FROM k CROSS JOIN cal LEFT JOIN dv e ON e.user_id = k.user_id AND e.band = k.band AND e.day = cal.date
  WHERE cal.date >= {START_SQL})"""

SQL["band_series"] = f"""WITH {SQL_BAND}
SELECT user_id, ym, band,
  string_agg(coalesce(CAST(value AS VARCHAR), 'null'), ',' ORDER BY date, event_id) AS vals
FROM g GROUP BY user_id, ym, band"""


def q_band_dates(spark, sf):
    """Per paddock and month, the sorted distinct days."""
    g = _band_grid(spark, sf).withColumn("ym", format_date("date", "yyyy-MM"))
    d = g.groupBy("user_id", "ym").agg(F.array_sort(F.collect_set(format_date("date", "yyyy-MM-dd"))).alias("_d"))
    return d.select("user_id", "ym", F.array_join("_d", ",").alias("dates"))


SQL["band_dates"] = f"""WITH {SQL_BAND}
SELECT user_id, ym, string_agg(DISTINCT strftime(date, '%Y-%m-%d'), ',' ORDER BY strftime(date, '%Y-%m-%d')) AS dates
FROM g GROUP BY user_id, ym"""


def q_band_filter(spark, sf):
    """The band-filtered rows the function returns."""
    g = _band_grid(spark, sf).filter(F.col("band").isin("click", "view"))
    return g.select("user_id", "band", format_date("date", "yyyy-MM-dd").alias("date"), "value")


SQL["band_filter"] = f"""WITH {SQL_BAND}
SELECT user_id, band, strftime(date, '%Y-%m-%d') AS date, value FROM g WHERE band IN ('click', 'view')"""


def q_band_series_doc(spark, sf):
    """K4: one JSON document per paddock and month (keys sorted)."""
    g = _band_grid(spark, sf).withColumns({"ym": format_date("date", "yyyy-MM"), "day": format_date("date", "yyyy-MM-dd")})
    docs = nested_series(g, ["user_id"], "ym", "band", ["date", "event_id"], "value", "day")
    return nested_documents(docs.withColumn("key", F.concat_ws("/", F.col("user_id").cast("string"), "ym")), "key")


SQL["band_series_doc"] = f"""WITH {SQL_BAND},
per AS (SELECT user_id, ym, band AS k, '"' || band || '":[' || string_agg(CASE WHEN value IS NULL THEN 'null'
    ELSE '"' || CAST(value AS VARCHAR) || '"' END, ',' ORDER BY date, event_id) || ']' AS part FROM g GROUP BY user_id, ym, band),
ds AS (SELECT user_id, ym, '"' || ym || '":[' || string_agg(DISTINCT '"' || strftime(date, '%Y-%m-%d') || '"', ','
    ORDER BY '"' || strftime(date, '%Y-%m-%d') || '"') || ']' AS part FROM g GROUP BY user_id, ym),
allp AS (SELECT user_id, ym, ym AS k, part FROM ds UNION ALL SELECT user_id, ym, k, part FROM per)
SELECT CAST(user_id AS VARCHAR) || '/' || ym AS key, '{{' || string_agg(part, ',' ORDER BY k) || '}}' AS json
FROM allp GROUP BY user_id, ym"""


# --------------------------------------------------------------------------- B21: F5 R3 J10 J11 W6 A10 A11 P12
ELEMENTS = [f"e_{t}" for t in EVENT_TYPES]


def _soil(spark, sf, start=START):
    e = table(spark, sf, "events")
    e = e.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id",
                 *[F.when(F.col("event_type") == t, F.col("value")).alias(f"e_{t}") for t in EVENT_TYPES])
    facts = fact_days(e, ["user_id"], e, ["user_id"], "day", ["ts", "event_id"], start=start)
    return filled(facts, ELEMENTS).select("user_id", "date", *ELEMENTS)  # time and id only order the rows: they are no cells


def q_fill_and_thresh(spark, sf):
    kept = keep_min_non_null(_soil(spark, sf), 5)
    return kept.select("user_id", format_date("date", "yyyy-MM-dd").alias("date"), *ELEMENTS)


def _sql_soil():
    fills = ",\n  ".join(
        f"last_value(CASE WHEN e.event_type = '{t}' THEN e.value END IGNORE NULLS) OVER w AS e_{t}" for t in EVENT_TYPES)
    return f"""b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
k AS (SELECT DISTINCT user_id FROM events),
s AS (SELECT k.user_id, cal.date, e.event_id,
  {fills}
  FROM k CROSS JOIN cal LEFT JOIN events e ON e.user_id = k.user_id AND CAST(e.ts AS DATE) = cal.date
  WHERE cal.date >= {START_SQL}
  WINDOW w AS (PARTITION BY k.user_id ORDER BY cal.date, e.ts NULLS FIRST, e.event_id NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_NN = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in ["user_id", "date", *ELEMENTS])
SQL["fill_and_thresh"] = f"""WITH {_sql_soil()}
SELECT user_id, strftime(date, '%Y-%m-%d') AS date, {", ".join(ELEMENTS)} FROM s WHERE {_NN} >= 5"""


def q_completeness(spark, sf):
    c = completeness(_soil(spark, sf))
    return c.select("total_cells", "na_cells", F.round("na_ratio", 6).alias("na_ratio"))


_NULLS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["user_id", "date", *ELEMENTS])
SQL["completeness"] = f"""WITH {_sql_soil()}
SELECT CAST(count(*) * 7 AS BIGINT) AS total_cells, CAST({_NULLS} AS BIGINT) AS na_cells,
  round(CAST({_NULLS} AS DOUBLE) / (count(*) * 7), 6) AS na_ratio FROM s"""


def q_change_dates(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").alias("fecha"))
    return change_dates(e, "fecha", START).select(format_date("fecha", "yyyy-MM-dd").alias("fecha"))


SQL["change_dates"] = f"""SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS fecha FROM events
WHERE CAST(ts AS DATE) >= {START_SQL}"""


QUERIES = {
    "band_series": q_band_series,
    "band_dates": q_band_dates,
    "band_filter": q_band_filter,
    "band_series_doc": q_band_series_doc,
    "fill_and_thresh": q_fill_and_thresh,
    "completeness": q_completeness,
    "change_dates": q_change_dates,
}
