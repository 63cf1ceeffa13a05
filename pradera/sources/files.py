"""Readers for landed files and API dumps (S1-S7), always with an explicit schema.

Spark has no spreadsheet source: a sheet is landed as CSV (or parquet)
first, with a ``row_id`` column holding its position, and read here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True,
             corrupt: str | None = None) -> DataFrame:
    """S3: CSV with a declared schema (never inferred).

    A malformed line is an error; with ``corrupt`` it becomes a row of nulls that has the line in that column."""
    r = spark.read.option("header", header).option("sep", sep)
    return _lenient(r, schema, corrupt).csv(path)


def _lenient(reader, schema: StructType, corrupt: str | None):
    if corrupt is None:
        return reader.schema(schema).option("mode", "FAILFAST")
    return (reader.schema(schema.add(corrupt, "string") if corrupt not in schema.names else schema)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt))


def read_sheet(spark: SparkSession, path: str, schema: StructType, n_cols: int | None = None, fmt: str = "csv") -> DataFrame:
    """A landed sheet; keeps the first ``n_cols`` columns (``iloc[:, 0:n]``)."""
    df = read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).parquet(path)
    if n_cols is not None:
        df = df.select(*df.columns[:n_cols])
    return df


def read_json_list(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
                   corrupt: str | None = None) -> DataFrame:
    """A landed JSON list of flat objects, one object per line, or with
    ``multi_line`` one JSON array per file (each element a row); a missing key
    reads as null.  JSON lines split across tasks; an array file is read whole
    by one task, so land large dumps as JSON lines.  A malformed object is an
    error, or with ``corrupt`` a row of nulls with its text in that column."""
    return _lenient(spark.read.option("multiLine", multi_line), schema, corrupt).json(path)


def client_ids(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """The client id list."""
    return read_json_list(spark, path, schema, multi_line).select("ID_CLIENTE")


def paddocks(spark: SparkSession, path: str, schema: StructType, coords: bool = False,
             multi_line: bool = False) -> DataFrame:
    """Paddock dimension ``(Finca, lote_id, nombre_lote[, x, y])``."""
    d = read_json_list(spark, path, schema, multi_line)
    cols = [F.col("ID_FINCA").alias("Finca"), F.col("ID_LOTE").alias("lote_id"), F.col("NOMBRE_LOTE").alias("nombre_lote")]
    if coords:
        cols += [F.col("LATITUD").alias("x"), F.col("LONGITUD").alias("y")]
    return d.select(*cols)


def herds(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Herd dimension ``(Finca, hato_id, nombre_hato, tipo_hato)``."""
    d = read_json_list(spark, path, schema, multi_line)
    return d.select(F.col("ID_FINCA").alias("Finca"), F.col("ID_HATO").alias("hato_id"),
                    F.col("Nombre_Hato").alias("nombre_hato"), F.col("TIPO_Hato").alias("tipo_hato"))


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None, properties: dict | None = None,
                 one_task: bool = False) -> dict[str, str]:
    """Options of a JDBC read: parallel ranges of ``partition_column``, or ``one_task`` said outright."""
    out = {"url": url, "dbtable": table, **{k: str(v) for k, v in (properties or {}).items()}}
    if partition_column is None:
        if not one_task:
            raise ValueError("a JDBC read needs a partition column with its bounds; one_task=True reads it in one task")
        return out
    if lower is None or upper is None or lower >= upper:
        raise ValueError("the bounds of the partition column have to be a range")
    return {**out, "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions or 8)}


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """An operational table through JDBC (``jdbc_options``); the query itself is DataFrame code on top
    (filters are pushed to the database).  Needs the database's driver jar."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
