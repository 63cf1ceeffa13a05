"""Sources and sinks round trips (S3 S5-S7 K1-K3) on the shared tables.

Each query writes a table to a fresh folder under the session's shared
checkpoint folder, reads it back with an explicit schema and returns it;
the oracle is the source table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..schemas import CLIENTS
from ..sources.files import read_sheet, client_ids, herds, paddocks, read_csv
from ..sources.sinks import append, export_csv, replace
from ..sources.tables import table

SQL = {}

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
LOTES = T.StructType([
    T.StructField("ID_FINCA", T.IntegerType()), T.StructField("ID_LOTE", T.LongType()),
    T.StructField("NOMBRE_LOTE", T.StringType()), T.StructField("LATITUD", T.DoubleType()),
    T.StructField("LONGITUD", T.DoubleType()),
])
HATOS = T.StructType([
    T.StructField("ID_FINCA", T.IntegerType()), T.StructField("ID_HATO", T.LongType()),
    T.StructField("Nombre_Hato", T.StringType()), T.StructField("TIPO_Hato", T.StringType()),
])


def q_csv_roundtrip(spark, sf):
    """K3 then S3: customer to a ``;`` CSV folder and back with a declared schema."""
    path = scratch_path(spark, "csv")
    export_csv(table(spark, sf, "customer"), path, sep=";")
    return read_csv(spark, path, CUSTOMER, sep=";")


SQL["csv_roundtrip"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


SHEET = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("ID", T.StringType()),
                      T.StructField("Grupo", T.StringType()), T.StructField("note", T.StringType())])


def q_sheet_columns(spark, sf):
    """Orders landed as a sheet with its row numbers; the first three columns are read."""
    path = scratch_path(spark, "sheet")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("ID"), F.col("o_orderpriority").alias("Grupo"),
        F.lit("note").alias("note")).write.parquet(path)
    return read_sheet(spark, path, SHEET, n_cols=3, fmt="parquet")


SQL["sheet_columns"] = "SELECT o_orderkey AS row_id, o_orderstatus AS ID, o_orderpriority AS Grupo FROM orders"


def q_json_dims(spark, sf):
    """The customer table landed as a paddock API dump (one object per line), read back."""
    c = table(spark, sf, "customer")
    dump = c.select(F.col("c_nationkey").alias("ID_FINCA"), F.col("c_custkey").alias("ID_LOTE"),
                    F.col("c_name").alias("NOMBRE_LOTE"), F.col("c_acctbal").alias("LATITUD"))
    path = scratch_path(spark, "json")
    dump.write.mode("overwrite").json(path)
    return paddocks(spark, path, LOTES, coords=True)


SQL["json_dims"] = """SELECT c_nationkey AS Finca, c_custkey AS lote_id, c_name AS nombre_lote,
  c_acctbal AS x, CAST(NULL AS DOUBLE) AS y FROM customer"""


def q_json_herds(spark, sf):
    """The supplier table landed as a herd API dump, read back."""
    s = table(spark, sf, "supplier")
    dump = s.select(F.col("s_nationkey").alias("ID_FINCA"), F.col("s_suppkey").alias("ID_HATO"),
                    F.col("s_name").alias("Nombre_Hato"),
                    F.when(F.col("s_acctbal") < 0, "SECAS").otherwise("LECHE").alias("TIPO_Hato"))
    path = scratch_path(spark, "json")
    dump.write.mode("overwrite").json(path)
    return herds(spark, path, HATOS)


SQL["json_herds"] = """SELECT s_nationkey AS Finca, s_suppkey AS hato_id, s_name AS nombre_hato,
  CASE WHEN s_acctbal < 0 THEN 'SECAS' ELSE 'LECHE' END AS tipo_hato FROM supplier"""


def q_append_overwrite(spark, sf):
    """K2 then K1: replace with the supplier table (twice), append it once more."""
    path = scratch_path(spark, "parquet")
    r = table(spark, sf, "supplier")
    replace(r, path)
    replace(r, path)
    append(r, path)
    return spark.read.parquet(path)


SQL["append_overwrite"] = "SELECT * FROM supplier UNION ALL SELECT * FROM supplier"


def q_json_clients(spark, sf):
    """The client-id list landed as a JSON dump (one object per line), read back."""
    path = scratch_path(spark, "json")
    table(spark, sf, "customer").select(F.col("c_custkey").alias("ID_CLIENTE")).write.mode("overwrite").json(path)
    return client_ids(spark, path, CLIENTS)


SQL["json_clients"] = "SELECT c_custkey AS ID_CLIENTE FROM customer"


QUERIES = {
    "json_clients": q_json_clients,
    "csv_roundtrip": q_csv_roundtrip,
    "sheet_columns": q_sheet_columns,
    "json_dims": q_json_dims,
    "json_herds": q_json_herds,
    "append_overwrite": q_append_overwrite,
}
