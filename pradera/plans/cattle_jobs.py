"""Cow jobs: mastitis incremental load, transfers, missing cows, duplicate
report and the animals extract (B2 B3 B4 B5 B11).

Generated activity ids come from ``assign_ids`` after the stored maximum
(no append + read back + positional zip).  Operator-name maps are data
passed in by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.categories import name_to_id
from ..functions.recode import recode, shift_code
from ..functions.text import (composite_key, format_date, null_if, parse_date, percent_to_fraction, replace_value,
                              strip)
from ..operators.aggregate import keep_last
from ..operators.keys import assign_ids
from ..operators.reconcile import HASH, MERGE, anti, enrich, hashed, join_flag, parent_lookup, reconcile, semi
from ..operators.runs import group_size
from ..operators.select import conform, skip_first
from ..schemas import VACAS

# fixed values: quarter score recodes (P, p -> 5; in the PI column also PI -> 0); null -> 0
QUARTER_SCORES = {"P": "5", "p": "5"}
PI_SCORES = {"P": "5", "PI": "0", "p": "5"}
# fixed values: type, result and category of a mastitis check, operator of unknown names
MASTITIS_TYPE, MASTITIS_RESULT, MASTITIS_CATEGORY, DEFAULT_OPERATOR = 9, 34, 1, 35
# fixed values: transfer group -> herd id
GROUP_IDS = {"NI": "9", "CF": "8", "JCAL": "4", "R 2": "2", "R 1": "1", "R 3": "3", "PARAI": "5", "HOR.1": "6",
             "HO.JU": "7"}
# fixed values: breed text -> breed id, sex text -> sex id (cow master export)
BREED_IDS = {"AN": "6", "AY": "18", "GY(50%) x HO(50%)": "3", "HO": "2", "HO(50%) x JE(50%)": "2",
             "HO(75%) x GY(25%)": "2", "HO(75%) x JE(25%)": "2", "HO(88%) x GY(13%)": "2", "HO(88%) x JE(13%)": "2",
             "HO(92%) x JE(8%)": "2", "??": "17"}
SEX_IDS = {"He:Rp": "1"}
# fixed values: dates that the two loads are booked under
TRANSFER_DATE = "2021-04-27"
REGISTER_DATE = "2021-04-25"


def mastitis_checks(mastitis: DataFrame, operators: Mapping[str, int]):
    """B2: the cleaned checks (date in ``_fecha``) and ``rejected``, the rows whose date is a text that is no date.

    A text with a slash can only be of the second format, one without only of the first: each is parsed once."""
    m = mastitis.withColumns({
        "ID_OPERARIO": name_to_id("ORDEÑADOR", operators, DEFAULT_OPERATOR),
        "ID_TipoOperacion": F.lit(MASTITIS_TYPE), "ID_Resultado": F.lit(MASTITIS_RESULT),
        "ID_Categoria": F.lit(MASTITIS_CATEGORY),
        "_fecha": F.to_date(F.when(F.col("Fecha").cast("string").contains("/"), parse_date("Fecha", "MM/dd/yyyy"))
                            .otherwise(parse_date("Fecha", "yyyy-MM-dd"))),
    }).filter(F.col("ID_VACA").isNotNull())
    unread = F.col("Fecha").isNotNull() & F.col("_fecha").isNull()
    return m.where(~unread), m.where(unread).select(*mastitis.columns)


def mastitis_reconciled(checks: DataFrame, stored: DataFrame) -> DataFrame:
    """B2: the checks' activities against the stored ones of their type, by date, cow and type.

    Keys begin alike, which makes sorting them slow; a hash in front of them sorts as a number."""
    acts = checks.select("ID_VACA", "ID_TipoOperacion", "ID_Resultado", "ID_OPERARIO", "ID_Categoria",
                         F.col("_fecha").alias("Fecha"), "Comentario").distinct()
    key = composite_key(format_date("Fecha", "MM/dd/yyyy"), "ID_VACA", "ID_TipoOperacion")
    old = stored.filter(F.col("ID_TipoOperacion") == MASTITIS_TYPE)
    acts, old = acts.withColumn("key", key), old.select(key.alias("key"), "ID_Actividad")
    return reconcile(hashed(acts, "key"), hashed(old, "key"), [HASH, "key"]).drop(HASH)


def mastitis_new(reconciled: DataFrame, stored: DataFrame, cows: DataFrame) -> DataFrame:
    """B2: activities that aren't stored yet, of known cows, with ids after the stored maximum."""
    new = reconciled.filter(F.col(MERGE) == "left_only").drop("ID_Actividad", MERGE)
    new = semi(new, cows, ["ID_VACA"])                      # drop cows unknown to the cow table
    mark = stored.select(F.max("ID_Actividad")).scalar()
    new = assign_ids(new, "ID_VACA", mark, "ID_Actividad", tie=["key", "Comentario", "ID_OPERARIO"])
    return new.drop("key")


def mastitis_detail(new: DataFrame, checks: DataFrame) -> DataFrame:
    """B2: one detail row per new activity: key without the type (trap T18), the last file row of that key.

    File rows are reduced to the last of each key before the join, which then has a row per activity."""
    dkey = composite_key(format_date("Fecha", "MM/dd/yyyy"), "ID_VACA")
    det = checks.withColumn("Fecha", F.col("_fecha")).select(
        dkey.alias("_k2"), "row_id", "AI", "AD", "PI", "PD", "Chequeo_revision", "Ubre_sana", "Calificacion", "GAP")
    # dealt by key first, as few rows share one; values are read behind that: dates and values in one piece of generated
    # code are more than the JVM compiles
    det = hashed(det, "_k2").where("_k2 is not null").repartition(HASH, "_k2").withColumns({
        **{c: F.coalesce(recode(c, PI_SCORES if c == "PI" else QUARTER_SCORES), F.lit("0")).cast("int")
           for c in ("AI", "AD", "PI", "PD")},
        **{c: percent_to_fraction(c) for c in ("Ubre_sana", "Calificacion", "GAP")}})
    det = keep_last(det, [HASH, "_k2"], ["row_id"]).drop("row_id")
    ids = hashed(new.select("ID_Actividad", dkey.alias("_k2")), "_k2")
    return ids.join(det, [HASH, "_k2"], "left").drop(HASH, "_k2")


def mastitis_load(mastitis: DataFrame, stored: DataFrame, cows: DataFrame, operators: Mapping[str, int]):
    """B2: returns (new_activities, mastitis_detail, missing_in_file, existing, rejected).

    ``rejected`` are rows whose date is a text that is no date; they are not loaded.

    ``mastitis``: landed history (``schemas.MASTITIS``); ``stored``: the
    activities table; ``cows``: the cow table.  New activities are numbered when this is called; who wants the outputs
    without ids alone takes the steps above."""
    checks, rejected = mastitis_checks(mastitis, operators)
    r = mastitis_reconciled(checks, stored)
    new = mastitis_new(r, stored, cows)
    return (new, mastitis_detail(new, checks), r.filter(F.col(MERGE) == "right_only"),
            r.filter(F.col(MERGE) == "both"), rejected)


def transfers(transfers_file: DataFrame, cows: DataFrame):
    """Returns (Traslado_Vacas, Ubicacion_Vacas, matched rows with ``duplicados``)."""
    t = transfers_file.withColumn("Grupo", recode("Grupo", GROUP_IDS).cast("int"))
    t = skip_first(t, "row_id").withColumn("ID", strip("ID"))
    t = keep_last(t, ["ID", "Grupo"], ["row_id"])           # drop_duplicates on the row's values
    c = cows.filter((F.col("IDTipoSalida") == 2) | (F.col("IDTipoSalida") == 1)).select("ID_VACA", "Nombre_Vaca")
    j = join_flag(t, c, ["ID"], ["Nombre_Vaca"])
    j = group_size(j, ["ID"], "duplicados").withColumn("Fecha_Traslado", F.lit(TRANSFER_DATE).cast("date"))
    ready = j.filter((F.col("duplicados") < 2) & (F.col(MERGE) != "left_only"))
    ready = ready.select("Fecha_Traslado", "ID_VACA", F.col("Grupo").alias("ID_HATO"), "row_id")
    ready = keep_last(ready, ["ID_VACA"], ["row_id"]).drop("row_id")
    location = ready.select("ID_VACA", "ID_HATO", F.lit(9999).alias("ID_LOTE"))
    return ready, location, j


def _id_and_text(code, kind: str, name: str):
    """The id that a code is, and beside it the text of a code that is none."""
    number = code.try_cast(kind)
    return number.alias(name), F.when(number.isNull(), code).alias(f"{name}_texto")


def register_missing_cows(matched: DataFrame, export: DataFrame, cows: DataFrame) -> DataFrame:
    """Cows named in the transfers but not in the cow table, from the master export.

    A breed, sex or sire that is no known code stays as text beside its null id.  Of several export rows or mothers
    the last counts: by transfer row, then export row, then mother id.  So a name's last transfer row and a mother
    name's largest id are taken before the joins, which then make no more rows than the export and the missing names.
    """
    missing = matched.filter(F.col("ID_VACA").isNull()).groupBy("ID").agg(F.max("row_id").alias("row_id"))
    mothers = cows.groupBy("Nombre_Vaca").agg(F.max("ID_VACA").alias("ID_VACA"))
    ex = export.withColumn("ID", strip("ID")).withColumnRenamed("row_id", "_export_row")
    d = missing.join(ex, "ID", "left")
    d = d.select(
        F.coalesce(F.col("Nombre"), F.col("ID")).alias("Nombre_Vaca"),
        F.col("`Id. Electr?ica`").alias("ElectronicID"),
        *_id_and_text(recode("Raza", BREED_IDS), "int", "Raza"),
        *_id_and_text(recode("Sexo/ tipo", SEX_IDS), "int", "Sexo"),
        F.coalesce(F.col("Madre "), F.col("`Madre gen.`")).alias("_madre"),
        F.lit(REGISTER_DATE).cast("date").alias("FechaRegistro"),
        F.to_date(parse_date("Nacimiento", "dd/MM/yyyy")).alias("FechaNacimiento"),
        *_id_and_text(F.col("Padre"), "long", "Sire"),
        F.lit(1).alias("ID_CLIENTE"), F.lit(2).alias("IDTipoOrigen"), F.lit(2).alias("IDTipoSalida"), "row_id",
        "_export_row")
    d = anti(d, cows, ["Nombre_Vaca"])
    d = parent_lookup(d, "_madre", mothers, "Nombre_Vaca", "ID_VACA", "VacaMadre").drop("_madre")
    d = keep_last(d, ["Nombre_Vaca"], ["row_id", "_export_row", "VacaMadre"])
    cols = ["ID_CLIENTE", "ElectronicID", "Nombre_Vaca", "Raza", "Sexo", "VacaMadre", "FechaRegistro", "IDTipoOrigen",
            "FechaNacimiento", "IDTipoSalida", "Sire"]
    texts = ["Raza_texto", "Sexo_texto", "Sire_texto"]
    return conform(d, T.StructType([*VACAS.fields, *[T.StructField(c, T.StringType()) for c in texts]])).select(
        *cols, *texts)


def duplicate_report(matched: DataFrame, cows: DataFrame) -> DataFrame:
    """Rows whose name occurs more than once, with both registrations (the duplicate-name report)."""
    d = matched.filter(F.col("duplicados") > 1).select("ID_VACA", "Nombre_Vaca", "row_id")
    d = keep_last(d, ["ID_VACA", "Nombre_Vaca"], ["row_id"]).drop("row_id")
    return enrich(d, cows, ["ID_VACA"])


def animals_extract(animals: DataFrame) -> DataFrame:
    """The cow table from the herd database's animals."""
    return animals.select(
        F.col("ID").alias("ID_VACA"), F.lit(1).alias("ID_CLIENTE"), F.lit(0).alias("ID_FINCA"), "ElectronicID",
        F.col("Name").alias("Nombre_Vaca"), (F.col("Breed") - 101).alias("Raza"), F.col("Sex").alias("Sexo"),
        F.col("DamB").alias("VacaMadre"), F.col("DamParity").alias("IDparto"), F.col("OrigDate").alias("FechaRegistro"),
        shift_code("OrigType").alias("IDTipoOrigen"), F.col("BirthDate").alias("FechaNacimiento"),
        shift_code("Fate").alias("IDTipoSalida"), F.col("FateDate").alias("FechaSalida"), "Sire")


def animals_extract_older(animals: DataFrame) -> DataFrame:
    """B11 in its older form: the sentinels 0 of ids and -101 of breeds replaced, blank electronic ids null, two states."""
    d = animals_extract(animals)
    return d.withColumns({
        "ID_VACA": replace_value("ID_VACA", 0, 1), "ElectronicID": null_if("ElectronicID", ""),
        "Raza": replace_value("Raza", -101, 0), "VacaMadre": replace_value("VacaMadre", 0, 1),
        "Estado": F.lit(1), "Estado_Final": F.lit(1)})
