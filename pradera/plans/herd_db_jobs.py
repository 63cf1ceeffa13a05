"""Herd-database migration jobs.

All detail loads share one shape (``detail_load``): filter and recode the
operations extract, audit unknown cows, recode results through a map table,
give the new activities ids after the stored maximum, emit the old -> new
id map and attach the new ids to the detail rows.  The SQL of the extracts
is written as DataFrame code over the landed tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.categories import calving_category, refine_category, service_category, vocabulary_category
from ..functions.recode import case_map, recode_join
from ..functions.text import blanks_to_null, null_if
from ..operators.keys import assign_ids, key_update
from ..operators.reconcile import audit_missing
from ..operators.reshape import union_by_name

# fixed values: herd-database officer -> operator id (default 35)
OFFICER_IDS = {3: 33, 7: 25, 12: 36, 13: 9, 15: 9, 17: 7, 19: 2, 20: 23}
DEFAULT_OPERATOR = 35
DEFAULT_RESULT = 34


@dataclass(frozen=True)
class DetailSpec:
    """What one detail load takes from the operations extract."""
    operation_types: Sequence[int]
    type_case: Mapping[int, int] | None = None     # OperationType -> activity type (CASE)
    type_default: int | None = None
    type_const: int | None = None
    result_case: Mapping[int, int] | None = None   # OperationType -> result (CASE on the type)
    result_default: int | None = None
    result_const: int | None = None
    officer_case: bool = True
    category_case: Mapping[int, int] | None = None
    category_default: int | None = None
    category_const: int | None = None
    comment_rule: str | None = None                 # "calving" | "service"
    detail_cols: Mapping[str, str] = field(default_factory=dict)
    detail_op: str = "OpID"


# fixed values of the five extracts
DIAGNOSIS = DetailSpec(operation_types=(91, 92, 93, 96, 101, 102, 106),
                       type_case={91: 7, 92: 4, 93: 5, 96: 3, 101: 3, 102: 5}, type_default=6,
                       category_const=18,
                       detail_cols={"ID": "IDdiagpre", "Animal": "ID_VACA", "Result": "ID_Resultado", "Days": "Dias",
                                    "Service": "ID_servicio"})
EXAMS = DetailSpec(operation_types=(18, 53, 73, 5, 107, 135, 123, 66, 21, 19, 40, 29, 89, 100, 136, 72, 88, 90, 43, 55,
                                    65, 85), category_const=1)
CALVINGS = DetailSpec(operation_types=(15, 90), type_const=1, result_const=1, officer_case=False,
                      category_case={15: 1, 90: 11}, category_default=0, comment_rule="calving",
                      detail_cols={"ID": "IDparto", "Animal": "ID_VACA", "Number": "Numero_Parto", "Sire": "Sire"},
                      detail_op="OpPar")
WEIGHINGS = DetailSpec(operation_types=(23,), type_const=10, result_const=1, officer_case=False, category_const=1,
                       detail_cols={"ID": "IDpeso", "Animal": "ID_VACA", "Weight": "Peso"})
SERVICES = DetailSpec(operation_types=(17, 56), type_case={17: 2, 56: 12}, type_default=2,
                      result_case={17: 2, 56: 1}, result_default=2, category_const=12, comment_rule="service",
                      detail_cols={"ID": "IDservicio", "Animal": "ID_VACA", "Sire": "Sire", "EmbryoDonor": "ID_Embrion"})


def _pick(col: str, case: Mapping | None, default, const) -> Column:
    if const is not None:
        return F.lit(const)
    if case is not None:
        return case_map(col, case, default)
    return F.col(col)


def activities_extract(operations: DataFrame, spec: DetailSpec) -> DataFrame:
    """The operations query of one extract."""
    ops = operations.filter(F.col("OperationType").isin(*spec.operation_types) & (F.col("Done") == 1))
    officer = case_map("Officer", OFFICER_IDS, DEFAULT_OPERATOR) if spec.officer_case else F.lit(DEFAULT_OPERATOR)
    acts = ops.select(
        F.col("ID").alias("Old_ID_Actividad"), F.col("Animal").alias("ID_VACA"),
        _pick("OperationType", spec.type_case, spec.type_default, spec.type_const).cast("int").alias("ID_TipoOperacion"),
        _pick("OperationType" if spec.result_case else "Result", spec.result_case, spec.result_default,
              spec.result_const).cast("int").alias("ID_Resultado"),
        officer.cast("int").alias("ID_OPERARIO"),
        _pick("OperationType", spec.category_case, spec.category_default, spec.category_const).cast("int").alias("ID_Categoria"),
        F.col("Date").alias("Fecha"), F.col("Remarks").alias("Comentario")).distinct()
    if spec.comment_rule == "calving":
        acts = acts.withColumn("ID_Categoria", refine_category("ID_Categoria", calving_category("Comentario")))
    elif spec.comment_rule == "service":
        acts = acts.withColumn("ID_Categoria", service_category("Comentario"))
    return acts


# Map tables are data passed in by the caller: result map (ID, id_resultado_destino), operation-type map
# (OperationType, id_tipo_destino), breed map (ID, id_raza_destino), older result map (ID_RESUL_IH,
# id_resultado_destino, id_categoria_destino).


def detail_load(operations: DataFrame, detail: DataFrame | None, stored: DataFrame, cows: DataFrame, spec: DetailSpec,
                result_map: DataFrame | None = None, result_key: str = "ID", result_value: str = "id_resultado_destino",
                type_map: DataFrame | None = None):
    """Returns dict(activities, id_map, detail, audit)."""
    acts = activities_extract(operations, spec)
    audit = audit_missing(acts, "ID_VACA", cows, "ID_VACA", "Nombre_Vaca")
    if result_map is not None:
        acts = recode_join(acts, result_map, "ID_Resultado", result_key, result_value, "ID_Resultado",
                           default=DEFAULT_RESULT)
    if type_map is not None:                         # exam operation types through a map, no default
        acts = recode_join(acts, type_map, "ID_TipoOperacion", "OperationType", "id_tipo_destino", "ID_TipoOperacion")
    mark = stored.select(F.max("ID_Actividad")).scalar()
    # a map with repeated keys makes several rows of one operation: their other values order them
    acts = assign_ids(acts, "Old_ID_Actividad", mark, "ID_Actividad",
                      tie=[c for c in acts.columns if c != "Old_ID_Actividad"])
    id_map = acts.select("ID_VACA", F.col("Old_ID_Actividad").alias("ID_Actividad_x"),
                         F.col("ID_Actividad").alias("ID_Actividad_y"))
    out = {"activities": acts.drop("Old_ID_Actividad"), "id_map": id_map, "audit": audit, "detail": None}
    if detail is not None:
        d = detail.distinct().select(*[F.col(k).alias(v) for k, v in spec.detail_cols.items()],
                                     F.col(spec.detail_op).alias("_op"))
        m = id_map.select(F.col("ID_Actividad_x").alias("_op"), F.col("ID_Actividad_y").alias("ID_ACTIVIDAD"))
        out["detail"] = d.join(m, "_op", "left").drop("_op")
    return out


# fixed values of the older calving script: operation type, activity type, result, operator
OLD_CALVING, OLD_TYPE, OLD_RESULT, OLD_OPERATOR = 15, 1, 1, 36


def calvings_load_older(operations: DataFrame, parities: DataFrame, stored: DataFrame, cows: DataFrame):
    """B14 in its older form: returns dict(activities, parities, cows, map).

    Calvings with their parity; the category is the comment's vocabulary word (F16).  ``parities`` are the
    ``Actividad_Partos`` rows; in ``cows`` the parity of birth points at the new activity, null where its parity has
    none.  ``map`` keeps every calving with its new id."""
    ops = operations.filter(F.col("OperationType") == OLD_CALVING).select(
        F.col("ID").alias("ID_OP"), F.col("Animal").alias("ID_VACA"), F.col("Date").alias("Fecha"),
        F.col("Remarks").alias("Comentario"))
    par = parities.select(F.col("OpPar").alias("_op"), F.col("Animal").alias("VACA"),
                          F.col("Number").alias("NumeroDePartos"), F.col("ID").alias("ID_PARTO"))
    p = ops.join(par, ops["ID_OP"] == par["_op"], "left").drop("_op").distinct()
    p = p.withColumns({"ID_TipoOperacion": F.lit(OLD_TYPE), "ID_Resultado": F.lit(OLD_RESULT),
                       "ID_OPERARIO": F.lit(OLD_OPERATOR), "ID_Categoria": vocabulary_category("Comentario")})
    p = assign_ids(p, "ID_OP", stored.select(F.max("ID_Actividad")).scalar(), "ID_Actividad",
                   tie=["ID_PARTO", "NumeroDePartos", "VACA", "ID_VACA", "Fecha", "Comentario"])
    born = cows.filter(F.col("IDparto").isNotNull()).select("ID_VACA", F.col("IDparto").alias("ID_PARTO"))
    born = born.join(p.select("ID_PARTO", "ID_Actividad"), "ID_PARTO").select("ID_VACA", "ID_Actividad")
    return {"activities": p.select("ID_Actividad", "ID_VACA", "ID_TipoOperacion", "ID_Resultado", "ID_OPERARIO",
                                   "ID_Categoria", "Fecha", "Comentario"),
            "parities": p.select("ID_Actividad", "NumeroDePartos"),
            "cows": key_update(cows, born, "ID_VACA", "IDparto", "ID_Actividad", order=["ID_Actividad"]), "map": p}


def sires_load(sires: DataFrame, breed_map: DataFrame) -> DataFrame:
    """Sires with breeds recoded through the map (unmapped -> null) and blanks -> null."""
    s = sires.distinct().select(F.col("ID").alias("IDsire"), "Active", "IDOfficial", "AINumber",
                                F.col("LongName").alias("Nombre_Largo"), F.col("Registration").alias("Registro"),
                                F.col("Breed").alias("Raza"), F.col("Discontinued").alias("Fecha_descontinuado"))
    s = recode_join(s, breed_map, "Raza", "ID", "id_raza_destino", "Raza")
    return blanks_to_null(s)


def supplies_load(supplies, suppliers, classes, class_map, lots_orig, lots, lots_dest, activity_maps: Sequence[DataFrame]):
    """Six tables; supply uses get their activity ids remapped through
    the union of the detail loads' id maps (unmapped -> null, trap T17)."""
    sup = blanks_to_null(supplies.distinct().select(
        F.col("ID").alias("IDsuministro"), "Code", F.col("Name").alias("Nombre"), F.col("Unit").alias("Unidad"),
        F.col("DefaultValue").alias("Valor_Default"), "Sire", F.col("Supplier").alias("Proveedor"),
        F.col("Discontinued").alias("Fecha_descontinuado")))
    prov = blanks_to_null(suppliers.distinct().select(
        F.col("ID").alias("IDproveedor"), "Code", F.col("Name").alias("Nombre"), F.col("Tel").alias("Telefono"),
        F.col("Email").alias("email"), F.col("Contact").alias("contacto"), F.col("PostalCorr").alias("PostCode"),
        F.col("Discontinued").alias("Fecha_descontinuado")))
    cls = blanks_to_null(classes.distinct().select(
        F.col("ID").alias("IDClase_sumi"), "Code", F.col("Name").alias("Nombre"), "Semen",
        F.col("InMEdReg").alias("Medicina"), F.col("Feed").alias("Alimento"),
        F.col("Discontinued").alias("Fecha_descontinuado")))
    cmap = blanks_to_null(class_map.distinct().select(
        "ID", F.col("Supply").alias("ID_Suministro"), F.col("Class").alias("ID_Clase"),
        F.col("Discontinued").alias("Fecha_descontinuado")))
    orig = lots_orig.join(lots, lots_orig["ID"] == lots["OrigLot"], "inner").select(
        lots_orig["ID"], F.col("Supply").alias("ID_Suministro"), null_if("Supplier", 0).alias("ID_proveedor"),
        F.col("Units").alias("Unidades"), null_if("UnitCost", 0).alias("Costo_unitaro"),
        F.col("OrigDate").alias("Fecha_ingreso"), F.col("Discontinued1").alias("Fecha_descontinuado"),
        F.col("WorkBal").alias("Balance")).distinct()
    orig = orig.withColumns({"fecha_vencimiento": F.lit(None).cast("date"), "numero_lote": F.lit(None).cast("string"),
                             "numero_factura": F.lit(None).cast("string"), "presentacion": F.lit(None).cast("string")})
    dest = lots_dest.distinct().select(
        "ID", F.col("Lot").alias("ID_Lote_origen"), F.col("Supply").alias("ID_suministro"),
        F.col("Units").alias("Unidades"), F.col("DestType").alias("Tipo_destino"), F.col("Date").alias("Fecha"),
        F.col("UnitCost").alias("Costo_unitaro"), F.col("Animal").alias("ID_VACA"), F.col("Event").alias("ID_ACTIVIDAD"))
    maps = union_by_name(*[m.select("ID_Actividad_x", "ID_Actividad_y") for m in activity_maps])
    dest = dest.join(maps, dest["ID_ACTIVIDAD"] == maps["ID_Actividad_x"], "left")
    dest = dest.withColumn("ID_ACTIVIDAD", F.col("ID_Actividad_y")).drop("ID_Actividad_x", "ID_Actividad_y")
    return {"Suministros": sup, "Proveedores": prov, "Tipo_suministros": cls, "Map_clases_suministros": cmap,
            "Suministros_origen": orig, "Suministros_destino": dest}


# fixed values: older vet-activity extract, operation type -> activity type (else 0)
VET_TYPES = {96: 3, 101: 3, 92: 4, 93: 5, 102: 5, 104: 6, 106: 6, 91: 7, 18: 8, 94: 8}


def vet_activities(operations: DataFrame, result_map: DataFrame) -> DataFrame:
    """B19 (older script): operations -> activities, result and category through the
    ``;`` map (duplicate map rows removed first), operator 36."""
    ops = operations.filter(F.col("OperationType").isin(*VET_TYPES.keys()))
    acts = ops.select(F.col("ID").alias("ID_OP_IH"), F.col("Animal").alias("ID_VACA"),
                      case_map("OperationType", VET_TYPES, 0).alias("ID_TipoOperacion"),
                      F.coalesce(F.col("Result"), F.lit(34)).alias("ID_RESUL_IH"), F.lit(36).alias("ID_OPERARIO"),
                      F.col("Date").alias("Fecha"), F.col("Remarks").alias("Comentario")).distinct()
    m = result_map.select("ID_RESUL_IH", F.col("id_resultado_destino").alias("ID_Resultado"),
                          F.col("id_categoria_destino").alias("ID_Categoria")).distinct()
    j = acts.join(m, "ID_RESUL_IH", "left")
    return j.select("ID_VACA", "ID_TipoOperacion", "ID_Resultado", "ID_OPERARIO", "ID_Categoria", "Fecha", "Comentario")


def stock_balance(lots_orig_out: DataFrame, dest_out: DataFrame) -> DataFrame:
    """B22 (a planned note in the original): units received minus units used per supply."""
    a = lots_orig_out.groupBy("ID_Suministro").agg(F.sum("Unidades").alias("recibido"))
    b = dest_out.groupBy(F.col("ID_suministro").alias("ID_Suministro")).agg(F.sum("Unidades").alias("usado"))
    j = a.join(b, "ID_Suministro", "full")
    return j.withColumn("balance", F.coalesce("recibido", F.lit(0.0)) - F.coalesce("usado", F.lit(0.0)))
