"""Paddock jobs on the landed paddock log.

Inputs: the paddock log (``schemas.PADDOCK_LOG``, with ``row_id``) and the
paddock dimension from the API dump (``Finca, lote_id, nombre_lote``).
Each job returns DataFrames; writing is left to ``sources.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import herd_label, pad_suffix, paddock_code
from ..functions.recode import recode_with_fallback
from ..functions.text import parse_date, safe_ratio
from ..operators.aggregate import herd_day_totals, last_non_null_by_group, latest_by
from ..operators.intervals import days, fact_days, fact_rows, grazing
from ..operators.reshape import unpivot
from ..operators.runs import movement_path, previous_run_values, zero_on
from ..operators.select import not_equal_keep_null
from ..sources.sinks import patch_payload

GRAZING = "PASTOREO"
# fixed values: activities with a "rows since last" counter
OTHER_ACTIVITIES = ("FUMIGADA", "SIEMBRA", "RENOVADA", "DESBROSADA", "ABONADA", "ENMIENDA", "ROTOBO")
# fixed values: activity name -> activity type id
ACTIVITY_IDS = {"FUMIGADA": 1, "ABONADA": 2, "RENOVADA": 3, "SIEMBRA": 4, "FOLIAR": 5, "ENMIENDA": 6,
                "ENCALADA": 7, "ENCALADO": 7, "DESBROSADA": 8, "CORTE": 9, "HENOLAJE": 10, "INTERSIEMBRA": 11,
                "RASTRILLO": 12, "RIEGO": 13, "ROTOVO": 14, "ROTOBO": 14}
# fixed values: forage name -> variety id
FORAGE_IDS = {"KYKUYO": 1, "RAYGRAS": 2}
# fixed values: herd name -> herd id
HERD_IDS = {"ISLA": 5, "JUNCAL": 4, "PARAISO": 5, "PROXIMAS JUN": 4, "RECODO 1": 1, "RECODO 2": 2, "RECODO 3": 3}
DATE_FMT = "yyyy-MM-dd HH:mm:ss"


def order():
    return [F.col("date"), F.col("row_id")]


def raw_activity_load(log: DataFrame) -> DataFrame:
    """B1: non-grazing rows (null activity kept), five columns, by activity date."""
    d = not_equal_keep_null(log, "ACTIVIDAD", GRAZING)
    return d.select("FINCA", "POTRERO", "ACTIVIDAD", "FECHA ACTIVIDAD", "PRODUCTO").orderBy("FECHA ACTIVIDAD")


def clean_log(log: DataFrame, start: str | None = "20100101") -> DataFrame:
    """B6 first steps: dates (bad text -> null), paddock code, milk per cow, date threshold."""
    d = log.withColumns({
        "FECHA ACTIVIDAD": parse_date("FECHA ACTIVIDAD", DATE_FMT),
        "FECHA ENTRADA": parse_date("FECHA ENTRADA", DATE_FMT),
        "FECHA SALIDA": parse_date("FECHA SALIDA", DATE_FMT),
        "FECHA PROYECTADA FUMIGACION": parse_date("FECHA PROYECTADA FUMIGACION", DATE_FMT),
    })
    if start:
        d = d.filter(F.col("FECHA ACTIVIDAD") >= F.to_timestamp(F.lit(start), "yyyyMMdd"))
    d = d.withColumn("lote_c", pad_suffix(paddock_code("FINCA", "POTRERO")))
    d = d.withColumn("LECHE VACA", safe_ratio("LECHE TOTAL", "NUMERO ANIMALES"))
    return d.drop("AÑO", "MES", "FINCA", "POTRERO", "AREA M2", "ANO FUMIGACION", "MES FUMIGACION", "FECHA SALIDA",
                  "FECHA ENTRADA", "FORRAJE FRECIDO", "FECHA PROYECTADA FUMIGACION", "DIAS ESTADIA", "LECHE POR DIA",
                  "LECHE POR VACA")


def forage_history(clean: DataFrame, lotes: DataFrame, legacy: bool = False):
    """A2 + A3: (pasto_cambios, pasto_actual).  ``legacy`` picks the
    alphabetically last forage instead of the most recent (trap T6)."""
    g = clean.filter(F.col("ACTIVIDAD") == GRAZING).select("lote_c", "FECHA ACTIVIDAD", "TIPO DE FORRAJE")
    g = g.join(lotes.select("lote_id", F.col("nombre_lote").alias("lote_c")), "lote_c", "left")
    changes = last_non_null_by_group(g, ["lote_id", "lote_c", "TIPO DE FORRAJE"], "FECHA ACTIVIDAD", "FECHA ACTIVIDAD")
    if legacy:
        current = changes.groupBy("lote_id", "lote_c").agg(F.max("TIPO DE FORRAJE").alias("TIPO DE FORRAJE"))
    else:
        current = latest_by(changes, ["lote_id", "lote_c"], "TIPO DE FORRAJE", ["FECHA ACTIVIDAD", "TIPO DE FORRAJE"])
    return changes, current


def other_activities(clean: DataFrame, lotes: DataFrame) -> DataFrame:
    """Non-grazing rows with the paddock id (``otras``)."""
    o = not_equal_keep_null(clean, "ACTIVIDAD", GRAZING).select("lote_c", "FECHA ACTIVIDAD", "ACTIVIDAD", "PRODUCTO")
    return o.join(lotes.select("lote_id", F.col("nombre_lote").alias("lote_c")), "lote_c", "left")


def _tracked(clean: DataFrame, lotes: DataFrame):
    """The log's facts per paddock, with grazing state and rows-since counters of the daily grid."""
    # a paddock is an id and a name; the name may be missing
    paddocks = lotes.select("lote_id", F.col("nombre_lote").alias("name_c")).withColumn("_name", F.to_json(F.struct("name_c")))
    facts = fact_days(paddocks, ["name_c", "lote_id", "_name"], clean, ["lote_c"], "FECHA ACTIVIDAD", ["row_id"],
                      activity="ACTIVIDAD", scan_keys=["lote_id", "_name"])
    return grazing(facts, activity="ACTIVIDAD", animals="NUMERO ANIMALES", grazing=GRAZING, fill=["TIPO DE FORRAJE"],
                   paddock_output=False, since=OTHER_ACTIVITIES)


def daily_tracking(clean: DataFrame, lotes: DataFrame) -> DataFrame:
    """Every paddock (id and name) x every day of the log, with grazing state and
    rows-since counters (before the paddock-output zeroing)."""
    return days(*_tracked(clean, lotes)).drop("_name")


def grazing_rows(clean: DataFrame, lotes: DataFrame):
    """The grazing rows of ``daily_tracking``, without making its days, and their layout."""
    return fact_rows(*_tracked(clean, lotes), where=F.col("ACTIVIDAD") == GRAZING)


def paddock_output(tracked: DataFrame) -> DataFrame:
    """B6 output ``full_seguimiento``: herd and milk columns dropped, rest days 0 on grazing rows."""
    d = zero_on(tracked, "dias_sin_pastoreo", "ACTIVIDAD", GRAZING)
    return d.drop("lote_c", "FECHA ACTIVIDAD", "DIAS ANTIGUEDAD PASTOS", "AFORO", "NUMERO ANIMALES", "HATO",
                  "LECHE TOTAL", "LECHE VACA", "lote_change", "actividad_change")


def herd_tracking(tracked: DataFrame, layout=None):
    """(seguimiento_hatos, lag_lotes), of ``daily_tracking`` or of ``grazing_rows`` with their layout.  Grazing rows per paddock get the
    previous run's animals and length (W7); per herd, change points of the
    paddock give the 1-3 previous paddocks (W8 W9), unpivoted (R1 F3).
    Grazing rows without a herd stay in both outputs, with null previous paddocks."""
    key = ["lote_id", "_name"] if layout else ["lote_id"]
    prev = previous_run_values(tracked, key, order(), activity="ACTIVIDAD", grazing=GRAZING, layout=layout)
    path = movement_path(prev, ["HATO"], [F.col("date"), F.col("lote_id"), F.col("row_id")], place="lote_c")
    hatos = path.drop("name_c", "_name", "FECHA ACTIVIDAD", "ACTIVIDAD", "PRODUCTO", "DIAS ANTIGUEDAD PASTOS", "lote_change",
                      "actividad_change", "ultimo_pastoreo", "ultimo_animales")
    solo = unpivot(hatos.select("date", "HATO", "lote_c", "lag_1", "lag_2", "lag_3"), ["date", "HATO"],
                   ["lote_c", "lag_1", "lag_2", "lag_3"])
    return hatos, solo.withColumn("HATO_C", herd_label("HATO", "variable"))


def coded_activity_load(otras: DataFrame) -> DataFrame:
    """``Actividades_Lotes`` rows; activity names to ids (unmapped names kept as text)."""
    d = recode_with_fallback(otras, "ACTIVIDAD", ACTIVITY_IDS, "ID_Tipo_Actividad", "Actividad_texto")
    d = d.select(F.lit(0).alias("ID_ACT_LOTE"), F.col("lote_id").alias("ID_LOTE"),
                 F.col("FECHA ACTIVIDAD").alias("FECHA_ACTIVIDAD"), "ID_Tipo_Actividad", "Actividad_texto",
                 F.col("PRODUCTO").alias("Producto"), F.lit(34).alias("ID_OPERARIO"))
    return d.filter(F.col("ID_LOTE").isNotNull())


def forage_payload(pasto_actual: DataFrame) -> DataFrame:
    """One PATCH body per paddock; a forage without an id is sent by its name, a missing one is left out."""
    d = recode_with_fallback(pasto_actual, "TIPO DE FORRAJE", FORAGE_IDS, "ID_variedad", "variedad_texto")
    d = d.select(F.col("lote_id").cast("int").alias("ID_LOTE"), "ID_variedad", "variedad_texto")
    by_id = patch_payload(d, ["ID_LOTE", "ID_variedad"])
    by_name = F.to_json(F.struct("ID_LOTE", F.col("variedad_texto").alias("ID_variedad")))
    return by_id.withColumn("payload", F.when(F.col("ID_variedad").isNull(), by_name).otherwise(F.col("payload")))


def herd_milk(clean: DataFrame) -> DataFrame:
    """``Leche_Hatos``: animals and milk per herd and day on grazing rows with milk."""
    d = clean.filter((F.col("ACTIVIDAD") == GRAZING) & (F.col("LECHE TOTAL") > 0))
    d = recode_with_fallback(d, "HATO", HERD_IDS, "ID_HATO", "HATO_texto")
    g = herd_day_totals(d, ["ID_HATO", "HATO_texto", "FECHA ACTIVIDAD"], animals="NUMERO ANIMALES",
                        milk="LECHE TOTAL", operator_id=35, either=("ID_HATO", "HATO_texto"))
    return g.withColumnsRenamed({"FECHA ACTIVIDAD": "FECHA_ACTIVIDAD", "numero_animales": "Numero_Animales",
                                 "leche_total": "Leche_Total", "id_operario": "ID_OPERARIO"})
