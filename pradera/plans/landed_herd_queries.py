"""The cattle and herd-database jobs (B2-B5 B11-B19), run through their own functions on landed shared tables.

Operations are ``orders`` (priority -> operation type, customer -> cow, customer key mod 30 / 25 -> result / officer,
remarks by order key, one in ten not done); detail rows are ``lineitem``; ids start after the largest supplier key;
``nation`` is the map table.  Mastitis checks are line items, transfers orders, the cow export parts; cows are
customers or suppliers.  What each stand-in adds (bad dates, blanks, nulls, repeated names) is stated beside it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.reconcile import MERGE
from ..sources.tables import table
from . import cattle_jobs as C
from . import herd_db_jobs as H
from .function_queries import COMMENT_WORDS, VOCAB_COMMENTS, _sql_calving

SQL = {}


def _pick(values, at):
    """Element ``at`` (a Column, from 0) of fixed values."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join("NULL" if v is None else "'" + str(v) + "'" for v in values) + "]"


def _case(col, pairs, default="NULL"):
    return f"CASE {col} " + " ".join(f"WHEN {k} THEN {v}" for k, v in pairs.items()) + f" ELSE {default} END"


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _cows(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("ID_VACA"), F.col("c_name").alias("Nombre_Vaca"))


def _stored(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ID_Actividad"))


def _operations(spark, sf, types, words):
    o = table(spark, sf, "orders")
    op = F.lit(None).cast("int")
    for k, v in types.items():
        op = F.when(F.col("o_orderpriority") == k, v).otherwise(op)
    return o.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("Animal"), op.alias("OperationType"),
                    (F.col("o_custkey") % 30).cast("int").alias("Result"),
                    (F.col("o_custkey") % 25).cast("int").alias("Officer"), F.col("o_orderdate").alias("Date"),
                    _pick(words, F.col("o_orderkey")).alias("Remarks"),
                    (F.col("o_orderkey") % 10 != 0).cast("int").alias("Done"))


def _sql_ops(types, words, done=True):
    case = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in types.items()) + " END"
    return f"""ops AS (SELECT o_orderkey AS id, o_custkey AS animal, {case} AS op, CAST(o_custkey % 30 AS INTEGER) AS res,
    CAST(o_custkey % 25 AS INTEGER) AS off, o_orderdate AS fecha, {_sql_list(words)}[o_orderkey % {len(words)} + 1] AS comment
  FROM orders{" WHERE o_orderkey % 10 <> 0" if done else ""})"""


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MARK = "(SELECT max(s_suppkey) FROM supplier)"
OFFICER = _case("off", H.OFFICER_IDS, H.DEFAULT_OPERATOR)


def _sql_acts(types, words, spec, kind, result, category, officer=OFFICER):
    return f"""{_sql_ops(types, words)},
acts AS (SELECT id, animal, fecha, comment, CAST({kind} AS INTEGER) AS kind, CAST({result} AS INTEGER) AS result,
    CAST({officer} AS INTEGER) AS officer, CAST({category} AS INTEGER) AS category,
    {MARK} + row_number() OVER (ORDER BY id) AS new_id
  FROM ops WHERE op IN ({", ".join(map(str, spec.operation_types))}))"""


_ACTS = """SELECT new_id AS ID_Actividad, animal AS ID_VACA, kind AS ID_TipoOperacion, result AS ID_Resultado,
  officer AS ID_OPERARIO, category AS ID_Categoria, strftime(fecha, '%Y-%m-%d') AS Fecha, comment AS Comentario FROM acts"""


def _activities(load):
    a = load["activities"]
    return a.select("ID_Actividad", "ID_VACA", "ID_TipoOperacion", F.col("ID_Resultado").cast("int").alias("ID_Resultado"),
                    "ID_OPERARIO", "ID_Categoria", _day("Fecha").alias("Fecha"), "Comentario")


def _result_map(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("ID"),
                                             F.col("n_regionkey").alias("id_resultado_destino"))


_RESULT = f"coalesce((SELECT n_regionkey FROM nation WHERE n_nationkey = res), {H.DEFAULT_RESULT})"

# --------------------------------------------------------------------------- B13: types through a map, no default
EXAM_TYPES = dict(zip(PRIORITIES, (18, 5, 107, 21, 23)))
WORDS = ("ok", "InterHerd", None, "x y")


def q_job_exams(spark, sf):
    tmap = table(spark, sf, "nation").select(F.col("n_nationkey").alias("OperationType"),
                                             F.col("n_regionkey").alias("id_tipo_destino"))
    load = H.detail_load(_operations(spark, sf, EXAM_TYPES, WORDS), None, _stored(spark, sf), _cows(spark, sf), H.EXAMS,
                         result_map=_result_map(spark, sf), type_map=tmap)
    return _activities(load).withColumn("ID_TipoOperacion", F.col("ID_TipoOperacion").cast("int"))


SQL["job_exams"] = f"""WITH {_sql_acts(EXAM_TYPES, WORDS, H.EXAMS,
                                       "(SELECT n_regionkey FROM nation WHERE n_nationkey = op)", _RESULT, "1")} {_ACTS}"""

# --------------------------------------------------------------------------- B14: comments decide the category
CALVING_TYPES = dict(zip(PRIORITIES, (15, 90, 15, 17, 23)))


def _parities(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_suppkey").alias("Animal"),
        F.col("l_linenumber").alias("Number"), F.col("l_partkey").alias("Sire"), F.col("l_orderkey").alias("OpPar"))


def _calvings(spark, sf):
    return H.detail_load(_operations(spark, sf, CALVING_TYPES, COMMENT_WORDS), _parities(spark, sf), _stored(spark, sf),
                         _cows(spark, sf), H.CALVINGS)


def q_job_calvings(spark, sf):
    return _activities(_calvings(spark, sf))


SQL_CALVINGS = _sql_acts(CALVING_TYPES, COMMENT_WORDS, H.CALVINGS, "1", "1",
                         f"CASE op WHEN 15 THEN {_sql_calving(1)} WHEN 90 THEN 11 ELSE 0 END", officer="35")
SQL["job_calvings"] = f"WITH {SQL_CALVINGS} {_ACTS}"


def q_job_calving_detail(spark, sf):
    return _calvings(spark, sf)["detail"]


SQL["job_calving_detail"] = f"""WITH {SQL_CALVINGS},
d AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS IDparto, l_suppkey AS ID_VACA, l_linenumber AS Numero_Parto,
    l_partkey AS Sire, l_orderkey AS op_id FROM lineitem)
SELECT IDparto, ID_VACA, Numero_Parto, Sire, new_id AS ID_ACTIVIDAD FROM d LEFT JOIN acts ON op_id = acts.id"""


# --------------------------------------------------------------------------- B14, older form
def _older(spark, sf):
    par = _parities(spark, sf).drop("Sire")  # a calving has one row for each of its parities
    cows = _cows(spark, sf).withColumn("IDparto", F.when(F.col("ID_VACA") % 4 != 0, F.col("ID_VACA") * 10 + 1))
    return H.calvings_load_older(_operations(spark, sf, CALVING_TYPES, VOCAB_COMMENTS), par, _stored(spark, sf), cows)


def q_job_older_calvings(spark, sf):
    return _activities(_older(spark, sf)).withColumn("ID_Categoria", F.col("ID_Categoria").cast("int"))


from ..functions.categories import CALVING_VOCAB, CALVING_VOCAB_IDS  # noqa: E402

_WORD = f"CASE WHEN upper(comment) IN ({', '.join(repr(w) for w in CALVING_VOCAB)}) THEN upper(comment) ELSE 'No definido' END"
SQL_OLDER = f"""{_sql_ops(CALVING_TYPES, VOCAB_COMMENTS, done=False)},
par AS (SELECT l_orderkey AS op_id, l_suppkey AS vaca, l_linenumber AS num, l_orderkey * 10 + l_linenumber AS id_parto
  FROM lineitem),
j AS (SELECT DISTINCT ops.id, animal, fecha, comment, vaca, num, id_parto FROM ops LEFT JOIN par ON par.op_id = ops.id
  WHERE op = 15),
acts AS (SELECT *, 1 AS kind, 1 AS result, 36 AS officer,
    CAST(CASE {_WORD} {" ".join(f"WHEN '{k}' THEN {v}" for k, v in CALVING_VOCAB_IDS.items())} END AS INTEGER) AS category,
    {MARK} + row_number() OVER (ORDER BY id, id_parto NULLS FIRST, num, vaca) AS new_id FROM j)"""
SQL["job_older_calvings"] = f"WITH {SQL_OLDER} {_ACTS}"


def q_job_older_parities(spark, sf):
    return _older(spark, sf)["parities"]


SQL["job_older_parities"] = f"WITH {SQL_OLDER} SELECT new_id AS ID_Actividad, num AS NumeroDePartos FROM acts"


def q_job_older_cows(spark, sf):
    return _older(spark, sf)["cows"]


SQL["job_older_cows"] = f"""WITH {SQL_OLDER}
SELECT c_custkey AS ID_VACA, c_name AS Nombre_Vaca, (SELECT max(new_id) FROM acts WHERE id_parto = CASE WHEN c_custkey % 4 <> 0
  THEN c_custkey * 10 + 1 END) AS IDparto FROM customer"""

# --------------------------------------------------------------------------- B15 B16
WEIGHT_TYPES = dict(zip(PRIORITIES, (23, 17, 23, 91, 15)))


def _weighings(spark, sf):
    detail = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_suppkey").alias("Animal"),
        F.col("l_quantity").alias("Weight"), F.col("l_orderkey").alias("OpID"))
    return H.detail_load(_operations(spark, sf, WEIGHT_TYPES, WORDS), detail, _stored(spark, sf), _cows(spark, sf),
                         H.WEIGHINGS)


def q_job_weighings(spark, sf):
    return _activities(_weighings(spark, sf))


SQL_WEIGHINGS = _sql_acts(WEIGHT_TYPES, WORDS, H.WEIGHINGS, "10", "1", "1", officer="35")
SQL["job_weighings"] = f"WITH {SQL_WEIGHINGS} {_ACTS}"


def q_job_weights(spark, sf):
    return _weighings(spark, sf)["detail"]


SQL["job_weights"] = f"""WITH {SQL_WEIGHINGS},
d AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS IDpeso, l_suppkey AS ID_VACA, l_quantity AS Peso, l_orderkey AS op_id
  FROM lineitem)
SELECT IDpeso, ID_VACA, Peso, new_id AS ID_ACTIVIDAD FROM d LEFT JOIN acts ON op_id = acts.id"""

SERVICE_TYPES = dict(zip(PRIORITIES, (17, 56, 17, 91, 15)))
SERVICE_WORDS = ("Inseminada", "toro 5", "TORO e insemi", "nada", None)


def _services(spark, sf):
    detail = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_suppkey").alias("Animal"),
        F.col("l_partkey").alias("Sire"), F.lit(None).cast("long").alias("EmbryoDonor"), F.col("l_orderkey").alias("OpID"))
    return H.detail_load(_operations(spark, sf, SERVICE_TYPES, SERVICE_WORDS), detail, _stored(spark, sf),
                         _cows(spark, sf), H.SERVICES)


def q_job_services(spark, sf):
    return _activities(_services(spark, sf))


SQL_SERVICES = _sql_acts(
    SERVICE_TYPES, SERVICE_WORDS, H.SERVICES, "CASE op WHEN 17 THEN 2 WHEN 56 THEN 12 ELSE 2 END",
    "CASE op WHEN 17 THEN 2 WHEN 56 THEN 1 ELSE 2 END",
    "CASE WHEN regexp_matches(comment, '(?i)insemi') THEN 12 WHEN regexp_matches(comment, '(?i)toro') THEN 13 ELSE 12 END")
SQL["job_services"] = f"WITH {SQL_SERVICES} {_ACTS}"


def q_job_service_detail(spark, sf):
    return _services(spark, sf)["detail"]


SQL["job_service_detail"] = f"""WITH {SQL_SERVICES},
d AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS IDservicio, l_suppkey AS ID_VACA, l_partkey AS Sire, l_orderkey AS op_id
  FROM lineitem)
SELECT IDservicio, ID_VACA, Sire, CAST(NULL AS BIGINT) AS ID_Embrion, new_id AS ID_ACTIVIDAD
FROM d LEFT JOIN acts ON op_id = acts.id"""


def q_job_exam_audit(spark, sf):
    """Cows of the weighings that the cow table has not, or not by name (one customer in seven has no name)."""
    cows = _cows(spark, sf).where("ID_VACA % 5 <> 0").withColumn(
        "Nombre_Vaca", F.when(F.col("ID_VACA") % 7 != 0, F.col("Nombre_Vaca")))
    return H.detail_load(_operations(spark, sf, WEIGHT_TYPES, WORDS), None, _stored(spark, sf), cows, H.WEIGHINGS)["audit"]


SQL["job_exam_audit"] = f"""WITH {SQL_WEIGHINGS}
SELECT DISTINCT animal AS ID_VACA FROM acts LEFT JOIN customer ON c_custkey = animal AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0
WHERE c_custkey IS NULL"""


# --------------------------------------------------------------------------- B17
def q_job_sires(spark, sf):
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    s = p.select(key.alias("ID"), (key % 2).cast("int").alias("Active"),
                 F.when(key % 3 == 0, "  ").otherwise(F.col("p_brand")).alias("IDOfficial"),
                 F.when(key % 5 == 0, "").otherwise(F.col("p_type")).alias("AINumber"), F.col("p_name").alias("LongName"),
                 F.lit(None).cast("string").alias("Registration"), (F.col("p_size") % 30).cast("int").alias("Breed"),
                 F.lit(None).cast("date").alias("Discontinued"))
    bmap = table(spark, sf, "nation").select(F.col("n_nationkey").alias("ID"), F.col("n_regionkey").alias("id_raza_destino"))
    return H.sires_load(s, bmap).withColumns({"Raza": F.col("Raza").cast("int"), "Fecha_descontinuado": _day("Fecha_descontinuado")})


SQL["job_sires"] = """SELECT DISTINCT p_partkey AS IDsire, CAST(p_partkey % 2 AS INTEGER) AS Active,
  CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS IDOfficial, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS AINumber,
  p_name AS Nombre_Largo, CAST(NULL AS VARCHAR) AS Registro, n_regionkey AS Raza, CAST(NULL AS VARCHAR) AS Fecha_descontinuado
FROM part LEFT JOIN nation ON n_nationkey = p_size % 30"""


# --------------------------------------------------------------------------- B18
def _supplies(spark, sf):
    p, s, n = table(spark, sf, "part"), table(spark, sf, "supplier"), table(spark, sf, "nation")
    none = lambda t: F.lit(None).cast(t)
    suppliers = s.select(F.col("s_suppkey").alias("ID"), F.concat(F.lit("P"), F.col("s_nationkey")).alias("Code"),
                         F.col("s_name").alias("Name"), F.when(F.col("s_suppkey") % 3 != 0, F.lit("601")).otherwise(" ").alias("Tel"),
                         F.when(F.col("s_acctbal") < 0, "").otherwise("ventas").alias("Email"), none("string").alias("Contact"),
                         none("string").alias("PostalCorr"), none("date").alias("Discontinued"))
    classes = n.select(F.col("n_nationkey").cast("long").alias("ID"), F.lit("").alias("Code"), F.col("n_name").alias("Name"),
                       (F.col("n_nationkey") % 2).cast("int").alias("Semen"), F.col("n_regionkey").cast("int").alias("InMEdReg"),
                       F.lit(0).alias("Feed"), none("date").alias("Discontinued"))
    class_map = table(spark, sf, "lineitem").select(  # with repeated rows
        (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("ID"), F.col("l_partkey").alias("Supply"),
        F.col("l_linenumber").cast("long").alias("Class"), none("date").alias("Discontinued"))
    supplies = p.select(F.col("p_partkey").alias("ID"), F.col("p_brand").alias("Code"), F.col("p_name").alias("Name"),
                        F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")).otherwise(" ").alias("Unit"),
                        F.col("p_retailprice").alias("DefaultValue"), F.lit(None).cast("long").alias("Sire"),
                        F.col("p_size").cast("long").alias("Supplier"), F.lit(None).cast("date").alias("Discontinued"))
    orig = s.select(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").cast("long").alias("Supply"),
                    (F.col("s_suppkey") % 5).alias("Supplier"))
    lots = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 150).alias("OrigLot"), F.col("c_nationkey").cast("double").alias("Units"),
        (F.col("c_custkey") % 3).cast("double").alias("UnitCost"), F.lit(None).cast("date").alias("OrigDate"),
        F.lit(None).cast("date").alias("Discontinued1"), F.col("c_acctbal").alias("WorkBal"))
    dest = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_partkey").alias("Lot"),
        F.col("l_suppkey").alias("Supply"), F.col("l_quantity").alias("Units"), F.col("l_linenumber").alias("DestType"),
        F.col("l_shipdate").alias("Date"), F.col("l_tax").alias("UnitCost"), F.col("l_suppkey").alias("Animal"),
        F.col("l_orderkey").alias("Event"))
    # calvings and services share no operation, so an event has at most one new id
    maps = [_calvings(spark, sf)["id_map"], _services_only(spark, sf)]
    return H.supplies_load(supplies, suppliers, classes, class_map, orig, lots, dest, maps)


ONLY_SERVICES = dict(zip(PRIORITIES, (91, 91, 91, 17, 91)))


def _services_only(spark, sf):
    return H.detail_load(_operations(spark, sf, ONLY_SERVICES, SERVICE_WORDS), None, _stored(spark, sf), _cows(spark, sf),
                         H.SERVICES)["id_map"]


def q_job_supplies(spark, sf):
    return _supplies(spark, sf)["Suministros"].withColumn("Fecha_descontinuado", _day("Fecha_descontinuado"))


SQL["job_supplies"] = """SELECT DISTINCT p_partkey AS IDsuministro, p_brand AS Code, p_name AS Nombre,
  CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS Unidad, p_retailprice AS Valor_Default, CAST(NULL AS BIGINT) AS Sire,
  CAST(p_size AS BIGINT) AS Proveedor, CAST(NULL AS VARCHAR) AS Fecha_descontinuado FROM part"""


def q_job_suppliers(spark, sf):
    return _supplies(spark, sf)["Proveedores"].withColumn("Fecha_descontinuado", _day("Fecha_descontinuado"))


SQL["job_suppliers"] = """SELECT s_suppkey AS IDproveedor, 'P' || s_nationkey AS Code, s_name AS Nombre,
  CASE WHEN s_suppkey % 3 <> 0 THEN '601' END AS Telefono, CASE WHEN s_acctbal >= 0 THEN 'ventas' END AS email,
  CAST(NULL AS VARCHAR) AS contacto, CAST(NULL AS VARCHAR) AS PostCode, CAST(NULL AS VARCHAR) AS Fecha_descontinuado
FROM supplier"""


def q_job_supply_classes(spark, sf):
    return _supplies(spark, sf)["Tipo_suministros"].withColumn("Fecha_descontinuado", _day("Fecha_descontinuado"))


SQL["job_supply_classes"] = """SELECT CAST(n_nationkey AS BIGINT) AS IDClase_sumi, CAST(NULL AS VARCHAR) AS Code, n_name AS Nombre,
  CAST(n_nationkey % 2 AS INTEGER) AS Semen, CAST(n_regionkey AS INTEGER) AS Medicina, 0 AS Alimento,
  CAST(NULL AS VARCHAR) AS Fecha_descontinuado FROM nation"""


def q_job_supply_class_map(spark, sf):
    return _supplies(spark, sf)["Map_clases_suministros"].withColumn("Fecha_descontinuado", _day("Fecha_descontinuado"))


SQL["job_supply_class_map"] = """SELECT DISTINCT l_partkey * 100 + l_linenumber AS ID, l_partkey AS ID_Suministro,
  CAST(l_linenumber AS BIGINT) AS ID_Clase, CAST(NULL AS VARCHAR) AS Fecha_descontinuado FROM lineitem"""


def q_job_supply_lots(spark, sf):
    o = _supplies(spark, sf)["Suministros_origen"]
    return o.select("ID", "ID_Suministro", "ID_proveedor", "Unidades", "Costo_unitaro", "Balance", "numero_lote")


SQL["job_supply_lots"] = """SELECT DISTINCT s_suppkey AS ID, CAST(s_nationkey AS BIGINT) AS ID_Suministro,
  nullif(s_suppkey % 5, 0) AS ID_proveedor, CAST(c_nationkey AS DOUBLE) AS Unidades,
  nullif(CAST(c_custkey % 3 AS DOUBLE), 0) AS Costo_unitaro, c_acctbal AS Balance, CAST(NULL AS VARCHAR) AS numero_lote
FROM supplier JOIN customer ON c_custkey % 150 = s_suppkey"""


def q_job_supply_uses(spark, sf):
    d = _supplies(spark, sf)["Suministros_destino"]
    return d.select("ID", "ID_Lote_origen", "ID_suministro", "Unidades", "Tipo_destino", _day("Fecha").alias("Fecha"),
                    "Costo_unitaro", "ID_VACA", "ID_ACTIVIDAD")


SQL["job_supply_uses"] = f"""WITH {SQL_CALVINGS},
sv AS (SELECT o_orderkey AS id, {MARK} + row_number() OVER (ORDER BY o_orderkey) AS new_id FROM orders
  WHERE o_orderkey % 10 <> 0 AND o_orderpriority = '4-NOT SPECIFIED'),
m AS (SELECT id, new_id FROM acts UNION ALL SELECT id, new_id FROM sv)
SELECT d.*, m.new_id AS ID_ACTIVIDAD FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS ID, l_partkey AS ID_Lote_origen,
    l_suppkey AS ID_suministro, l_quantity AS Unidades, l_linenumber AS Tipo_destino, strftime(l_shipdate, '%Y-%m-%d') AS Fecha,
    l_tax AS Costo_unitaro, l_suppkey AS ID_VACA, l_orderkey AS ev FROM lineitem) d LEFT JOIN m ON m.id = d.ev"""
SQL["job_supply_uses"] = SQL["job_supply_uses"].replace("SELECT d.*,", "SELECT d.* EXCLUDE (ev),")


# --------------------------------------------------------------------------- B22
def q_job_stock_balance(spark, sf):
    s = _supplies(spark, sf)
    b = H.stock_balance(s["Suministros_origen"], s["Suministros_destino"])
    return b.select("ID_Suministro", *[F.round(c, 4).alias(c) for c in ("recibido", "usado", "balance")])


SQL["job_stock_balance"] = f"""WITH a AS (SELECT ID_Suministro, sum(Unidades) AS recibido FROM ({SQL["job_supply_lots"]}) GROUP BY 1),
b AS (SELECT ID_suministro AS ID_Suministro, sum(Unidades) AS usado FROM ({SQL["job_supply_uses"]}) GROUP BY 1)
SELECT coalesce(a.ID_Suministro, b.ID_Suministro) AS ID_Suministro, round(recibido, 4) AS recibido, round(usado, 4) AS usado,
  round(coalesce(recibido, 0) - coalesce(usado, 0), 4) AS balance FROM a FULL JOIN b ON a.ID_Suministro = b.ID_Suministro"""

# --------------------------------------------------------------------------- B19
VET = dict(zip(PRIORITIES, (96, 104, 18, 77, 91)))


def q_job_vet_activities(spark, sf):
    n = table(spark, sf, "nation")
    rmap = n.union(n).select(F.col("n_nationkey").alias("ID_RESUL_IH"), F.col("n_regionkey").alias("id_resultado_destino"),
                             (F.col("n_nationkey") + 100).alias("id_categoria_destino"))  # every map row twice
    ops = _operations(spark, sf, VET, WORDS).withColumn("Result", F.when(F.col("ID") % 9 != 0, F.col("Result")))
    return H.vet_activities(ops, rmap).withColumn("Fecha", _day("Fecha"))


SQL["job_vet_activities"] = f"""WITH {_sql_ops(VET, WORDS, done=False)},
a AS (SELECT DISTINCT id, animal, {_case("op", H.VET_TYPES, 0)} AS kind,
    coalesce(CASE WHEN id % 9 <> 0 THEN res END, 34) AS ih, fecha, comment FROM ops
  WHERE op IN ({", ".join(map(str, H.VET_TYPES))}))
SELECT animal AS ID_VACA, CAST(kind AS INTEGER) AS ID_TipoOperacion, n_regionkey AS ID_Resultado, 36 AS ID_OPERARIO,
  n_nationkey + 100 AS ID_Categoria, strftime(fecha, '%Y-%m-%d') AS Fecha, comment AS Comentario
FROM a LEFT JOIN nation ON n_nationkey = ih"""


# --------------------------------------------------------------------------- B11
def _animals(spark, sf):
    c = table(spark, sf, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    none = lambda t: F.lit(None).cast(t)
    return c.select((k - 1).alias("ID"), F.when(k % 6 != 0, F.col("c_name")).otherwise("").alias("ElectronicID"),
                    F.col("c_name").alias("Name"), F.when(n % 3 == 0, 0).otherwise(n + 101).cast("int").alias("Breed"),
                    (k % 2).cast("int").alias("Sex"), (k % 4).alias("DamB"), (k * 10).alias("DamParity"),
                    none("date").alias("OrigDate"), (n % 5 - 2).cast("int").alias("OrigType"), none("date").alias("BirthDate"),
                    F.when(n % 4 != 0, n % 3 - 1).cast("int").alias("Fate"), none("date").alias("FateDate"), k.alias("Sire"))


_COW_COLS = ["ID_VACA", "ID_CLIENTE", "ID_FINCA", "ElectronicID", "Nombre_Vaca", "Raza", "Sexo", "VacaMadre", "IDparto",
             "IDTipoOrigen", "IDTipoSalida", "Sire"]


def q_job_animals(spark, sf):
    return C.animals_extract(_animals(spark, sf)).select(*_COW_COLS)


_SHIFT = "CASE WHEN {0} <= 0 THEN {0} + 2 WHEN {0} > 0 THEN {0} + 1 END"
_COWS = f"""SELECT c_custkey - 1 AS ID_VACA, 1 AS ID_CLIENTE, 0 AS ID_FINCA, CASE WHEN c_custkey % 6 <> 0 THEN c_name ELSE '' END
    AS ElectronicID, c_name AS Nombre_Vaca, CAST(CASE WHEN c_nationkey % 3 = 0 THEN -101 ELSE c_nationkey END AS INTEGER) AS Raza,
  CAST(c_custkey % 2 AS INTEGER) AS Sexo, c_custkey % 4 AS VacaMadre, c_custkey * 10 AS IDparto,
  CAST({_SHIFT.format("(c_nationkey % 5 - 2)")} AS INTEGER) AS IDTipoOrigen,
  CAST({_SHIFT.format("(CASE WHEN c_nationkey % 4 <> 0 THEN c_nationkey % 3 - 1 END)")} AS INTEGER) AS IDTipoSalida,
  c_custkey AS Sire FROM customer"""
SQL["job_animals"] = _COWS


def q_job_animals_older(spark, sf):
    return C.animals_extract_older(_animals(spark, sf)).select(*_COW_COLS, "Estado", "Estado_Final")


SQL["job_animals_older"] = f"""SELECT * REPLACE (CASE WHEN ID_VACA = 0 THEN 1 ELSE ID_VACA END AS ID_VACA,
  nullif(ElectronicID, '') AS ElectronicID, CAST(CASE WHEN Raza = -101 THEN 0 ELSE Raza END AS INTEGER) AS Raza,
  CASE WHEN VacaMadre = 0 THEN 1 ELSE VacaMadre END AS VacaMadre), 1 AS Estado, 1 AS Estado_Final FROM ({_COWS})"""

# --------------------------------------------------------------------------- B2
SCORES = ("P", "p", "0", "1", None, "3")
MILKERS = ("ANA", "PEDRO", "LUIS", None)
MILKER_IDS = {"ANA": 19, "LUIS": 28}


def _mastitis(spark, sf):
    """One check per line item: cow = supplier (one in 23 none), dates in two formats, one in 97 no date at all."""
    li = table(spark, sf, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    fecha = (F.when(k % 97 == 0, "sin fecha").when(k % 3 == 0, F.date_format("l_shipdate", "MM/dd/yyyy"))
             .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")))
    pct = lambda c: F.concat(F.round(F.col(c) * 100).cast("int").cast("string"), F.lit("%"))
    m = li.select((k * 10 + n).alias("row_id"), F.when(k % 23 != 0, F.col("l_suppkey")).alias("ID_VACA"),
                  F.lit("x").alias("NOMBRE"), F.lit("x").alias("HATO"), _pick(SCORES, k).alias("AI"),
                  _pick(SCORES, k + 1).alias("AD"), _pick(("PI", "P", "2", None), k).alias("PI"),
                  _pick(SCORES, n).alias("PD"), _pick(MILKERS, k).alias("ORDEÑADOR"), F.col("l_returnflag").alias("Comentario"),
                  fecha.alias("Fecha"), pct("l_discount").alias("Ubre_sana"), pct("l_tax").alias("Calificacion"),
                  pct("l_tax").alias("GAP"), F.col("l_linestatus").alias("Chequeo_revision"), F.lit("F").alias("FINCA"),
                  F.lit("1").alias("Potrero"), F.lit(1).alias("Contador"))
    o = table(spark, sf, "orders")
    stored = o.select(F.col("o_orderkey").alias("ID_Actividad"), (F.col("o_custkey") % 100).alias("ID_VACA"),
                      F.when(F.col("o_orderkey") % 2 == 0, 9).otherwise(2).alias("ID_TipoOperacion"),
                      F.col("o_orderdate").alias("Fecha"))
    cows = table(spark, sf, "supplier").where("s_suppkey % 10 <> 3").select(F.col("s_suppkey").alias("ID_VACA"))
    return m, stored, cows


def _mastitis_reconciled(spark, sf):
    m, stored, _ = _mastitis(spark, sf)
    return C.mastitis_reconciled(C.mastitis_checks(m, MILKER_IDS)[0], stored)


_SCORE = lambda at: (f"CAST(coalesce(CASE {at} WHEN 'P' THEN '5' WHEN 'p' THEN '5' ELSE {at} END, '0') AS INTEGER)")
_AT = lambda v, i: f"{_sql_list(v)}[CAST({i} % {len(v)} AS BIGINT) + 1]"
SQL_MASTITIS = f"""m0 AS (SELECT l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN l_orderkey % 23 <> 0 THEN l_suppkey END AS cow,
    {_SCORE(_AT(SCORES, "l_orderkey"))} AS AI, {_SCORE(_AT(SCORES, "(l_orderkey + 1)"))} AS AD,
    CAST(coalesce(CASE {_AT(("PI", "P", "2", None), "l_orderkey")} WHEN 'P' THEN '5' WHEN 'PI' THEN '0' WHEN 'p' THEN '5'
      ELSE {_AT(("PI", "P", "2", None), "l_orderkey")} END, '0') AS INTEGER) AS PI,
    {_SCORE(_AT(SCORES, "l_linenumber"))} AS PD,
    CASE {_AT(MILKERS, "l_orderkey")} WHEN 'ANA' THEN 19 WHEN 'LUIS' THEN 28 ELSE 35 END AS op, l_returnflag AS com,
    CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_shipdate AS DATE) END AS fecha, l_linestatus AS chk,
    CAST(round(l_discount * 100) AS INTEGER) / 100.0::DOUBLE AS us, CAST(round(l_tax * 100) AS INTEGER) / 100.0::DOUBLE AS tx
  FROM lineitem),
m AS (SELECT * FROM m0 WHERE cow IS NOT NULL AND fecha IS NOT NULL),
acts AS (SELECT DISTINCT cow, op, fecha, com, strftime(fecha, '%m/%d/%Y') || '_' || CAST(cow AS VARCHAR) || '_9' AS key FROM m),
old AS (SELECT o_orderkey AS id_act, strftime(o_orderdate, '%m/%d/%Y') || '_' || CAST(o_custkey % 100 AS VARCHAR) || '_9' AS key
  FROM orders WHERE o_orderkey % 2 = 0),
new AS (SELECT a.*, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY cow, key, com, op) AS id
  FROM acts a WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.key = a.key)
    AND cow IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 3))"""


def q_job_mastitis_new(spark, sf):
    return C.mastitis_load(*_mastitis(spark, sf), MILKER_IDS)[0].select(
        "ID_Actividad", "ID_VACA", "ID_TipoOperacion", "ID_Resultado", "ID_OPERARIO", "ID_Categoria",
        _day("Fecha").alias("Fecha"), "Comentario")


SQL["job_mastitis_new"] = f"""WITH {SQL_MASTITIS}
SELECT id AS ID_Actividad, cow AS ID_VACA, 9 AS ID_TipoOperacion, 34 AS ID_Resultado, op AS ID_OPERARIO, 1 AS ID_Categoria,
  CAST(fecha AS VARCHAR) AS Fecha, com AS Comentario FROM new"""


def q_job_mastitis_detail(spark, sf):
    return C.mastitis_load(*_mastitis(spark, sf), MILKER_IDS)[1]


SQL["job_mastitis_detail"] = f"""WITH {SQL_MASTITIS}
SELECT id AS ID_Actividad, AI, AD, PI, PD, chk AS Chequeo_revision, us AS Ubre_sana, tx AS Calificacion, tx AS GAP
FROM new JOIN m ON m.cow = new.cow AND m.fecha = new.fecha
QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id DESC) = 1"""


def q_job_mastitis_existing(spark, sf):
    return _mastitis_reconciled(spark, sf).where(F.col(MERGE) == "both").select(
        "key", "ID_VACA", "ID_OPERARIO", "Comentario", "ID_Actividad")


SQL["job_mastitis_existing"] = f"""WITH {SQL_MASTITIS}
SELECT a.key, cow AS ID_VACA, op AS ID_OPERARIO, com AS Comentario, id_act AS ID_Actividad FROM acts a JOIN old ON old.key = a.key"""


def q_job_mastitis_missing(spark, sf):
    return _mastitis_reconciled(spark, sf).where(F.col(MERGE) == "right_only").select("key", "ID_Actividad")


SQL["job_mastitis_missing"] = f"""WITH {SQL_MASTITIS}
SELECT key, id_act AS ID_Actividad FROM old WHERE NOT EXISTS (SELECT 1 FROM acts a WHERE a.key = old.key)"""


def q_job_mastitis_rejected(spark, sf):
    return C.mastitis_checks(_mastitis(spark, sf)[0], MILKER_IDS)[1].select("row_id", "ID_VACA", "Fecha")


SQL["job_mastitis_rejected"] = """SELECT l_orderkey * 10 + l_linenumber AS row_id, l_suppkey AS ID_VACA, 'sin fecha' AS Fecha
FROM lineitem WHERE l_orderkey % 97 = 0 AND l_orderkey % 23 <> 0"""

# --------------------------------------------------------------------------- B3 B4 B5
GROUPS = tuple(C.GROUP_IDS)


def _named_cows(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("ID_VACA"), F.concat(F.lit("COW"), (F.col("c_custkey") % 1400).cast("string"))
                    .alias("Nombre_Vaca"), (F.col("c_custkey") % 4).cast("int").alias("IDTipoSalida"),
                    F.col("c_mktsegment").alias("Estado"))


def _transfers(spark, sf):
    o = table(spark, sf, "orders")
    t = o.select(F.col("o_orderkey").alias("row_id"), F.concat(
        F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(""), F.lit("COW"),
        (F.col("o_orderkey") % 14500).cast("string"), F.lit("\t")).alias("ID"), _pick(GROUPS, F.col("o_orderkey")).alias("Grupo"))
    return C.transfers(t, _named_cows(spark, sf))


SQL_TRANSFERS = f"""c AS (SELECT c_custkey AS cow, 'COW' || CAST(c_custkey % 1400 AS VARCHAR) AS name, c_custkey % 4 AS fate,
    c_mktsegment AS estado FROM customer),
t AS (SELECT o_orderkey AS row_id, 'COW' || CAST(o_orderkey % 14500 AS VARCHAR) AS id,
    CAST({_sql_list(C.GROUP_IDS.values())}[o_orderkey % {len(GROUPS)} + 1] AS INTEGER) AS grupo FROM orders WHERE o_orderkey > 0
  QUALIFY row_number() OVER (PARTITION BY id, grupo ORDER BY row_id DESC) = 1),
j AS (SELECT t.*, cow, name, count(*) OVER (PARTITION BY id) AS dup FROM t LEFT JOIN c ON name = id AND fate IN (1, 2)),
ready AS (SELECT cow, grupo, row_id FROM j WHERE dup < 2 AND cow IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY cow ORDER BY row_id DESC) = 1)"""


def q_job_transfers(spark, sf):
    return _transfers(spark, sf)[0].withColumn("Fecha_Traslado", _day("Fecha_Traslado"))


SQL["job_transfers"] = f"""WITH {SQL_TRANSFERS}
SELECT '2021-04-27' AS Fecha_Traslado, cow AS ID_VACA, grupo AS ID_HATO FROM ready"""


def q_job_locations(spark, sf):
    return _transfers(spark, sf)[1]


SQL["job_locations"] = f"WITH {SQL_TRANSFERS} SELECT cow AS ID_VACA, grupo AS ID_HATO, 9999 AS ID_LOTE FROM ready"


def q_job_duplicate_names(spark, sf):
    d = C.duplicate_report(_transfers(spark, sf)[2], _named_cows(spark, sf))
    return d.select("ID_VACA", "Nombre_Vaca_x", "Nombre_Vaca_y", "IDTipoSalida", "Estado")


SQL["job_duplicate_names"] = f"""WITH {SQL_TRANSFERS},
d AS (SELECT DISTINCT cow, name FROM j WHERE dup > 1)
SELECT d.cow AS ID_VACA, d.name AS Nombre_Vaca_x, c.name AS Nombre_Vaca_y, CAST(c.fate AS INTEGER) AS IDTipoSalida,
  c.estado AS Estado FROM d LEFT JOIN c ON c.cow = d.cow"""

BREEDS = ("AN", "HO", "??", "JERSEY", None)


def q_job_registered_cows(spark, sf):
    """The export is parts, two rows for some names; mothers by name, sires partly no number."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    name = F.concat(F.lit("COW"), (k * 5 % 9000).cast("string"))
    export = p.select(k.alias("row_id"), F.concat(name, F.lit(" ")).alias("ID"), _pick(BREEDS, k).alias("Raza"),
                      _pick(("He:Rp", "Ma", None), k).alias("Sexo/ tipo"),
                      F.when(k % 4 == 0, F.lit("TORO")).when(k % 4 == 1, k.cast("string")).alias("Padre"),
                      F.concat(F.lit("COW"), (k % 1400).cast("string")).alias("Madre gen."),
                      F.when(k % 2 == 0, F.concat(F.lit("COW"), (k % 700).cast("string"))).alias("Madre "),
                      F.when(k % 6 == 0, "?").otherwise("03/02/2020").alias("Nacimiento"),
                      F.when(k % 3 == 0, name).alias("Nombre"), F.col("p_brand").alias("Id. Electr?ica"),
                      F.lit(None).cast("string").alias("Toro ?t. parto"))
    d = C.register_missing_cows(_transfers(spark, sf)[2], export, _named_cows(spark, sf).select("ID_VACA", "Nombre_Vaca"))
    return d.withColumns({c: _day(c) for c in ("FechaRegistro", "FechaNacimiento")})


SQL["job_registered_cows"] = f"""WITH {SQL_TRANSFERS},
x AS (SELECT p_partkey AS xr, 'COW' || CAST(p_partkey * 5 % 9000 AS VARCHAR) AS xid, p_brand AS el,
    {_AT(BREEDS, "p_partkey")} AS raza, {_AT(("He:Rp", "Ma", None), "p_partkey")} AS sexo,
    CASE p_partkey % 4 WHEN 0 THEN 'TORO' WHEN 1 THEN CAST(p_partkey AS VARCHAR) END AS padre,
    CASE WHEN p_partkey % 2 = 0 THEN 'COW' || CAST(p_partkey % 700 AS VARCHAR) ELSE 'COW' || CAST(p_partkey % 1400 AS VARCHAR) END AS madre,
    CASE WHEN p_partkey % 6 <> 0 THEN '2020-02-03' END AS nac FROM part),
d AS (SELECT j.id AS nombre, j.row_id, x.* FROM j LEFT JOIN x ON x.xid = j.id WHERE j.cow IS NULL),
e AS (SELECT d.*, c.cow AS mother FROM d LEFT JOIN c ON c.name = d.madre
  WHERE d.nombre NOT IN (SELECT name FROM c)
  QUALIFY row_number() OVER (PARTITION BY nombre ORDER BY row_id DESC, xr DESC NULLS LAST, mother DESC NULLS LAST) = 1)
SELECT 1 AS ID_CLIENTE, el AS ElectronicID, nombre AS Nombre_Vaca,
  CAST(CASE raza WHEN 'AN' THEN 6 WHEN 'HO' THEN 2 WHEN '??' THEN 17 END AS INTEGER) AS Raza,
  CAST(CASE sexo WHEN 'He:Rp' THEN 1 END AS INTEGER) AS Sexo, mother AS VacaMadre, '2021-04-25' AS FechaRegistro,
  2 AS IDTipoOrigen, nac AS FechaNacimiento, 2 AS IDTipoSalida, TRY_CAST(padre AS BIGINT) AS Sire,
  CASE WHEN raza = 'JERSEY' THEN raza END AS Raza_texto, CASE WHEN sexo = 'Ma' THEN sexo END AS Sexo_texto,
  CASE WHEN padre = 'TORO' THEN padre END AS Sire_texto FROM e"""

QUERIES = {k[2:]: v for k, v in list(globals().items()) if k.startswith("q_job_")}
