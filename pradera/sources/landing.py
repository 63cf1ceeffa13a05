"""Landing text files with the position of every line (S3 S4; what ``row_id`` stands for everywhere else).

A large file is read in splits by many tasks, so no task knows how many lines come before its own.  ``land`` writes the
rows once, each with its split (file and first byte) and its place among the rows of the task that read it; a second,
small table holds for every split the number of rows in the splits before it, by file name and position.  ``landed`` adds the
two.  Places in a task only mean something together with the rows that were written, so nothing is numbered again when
it is read, whatever the splits of a later read would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import read_csv

_SPLIT = ["_file", "_from"]


def land(df: DataFrame, out: str) -> None:
    """Write a frame that reads a file (CSV, text or JSON lines, not filtered) to ``out``, so that ``landed`` can number it.

    Landing again replaces what is there.  Files count in the order of their names, lines in the order of the file."""
    spark = df.sparkSession
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"))
    rows.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{out}/rows")
    splits = spark.read.parquet(f"{out}/rows").groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # one row a split: few, however long the files are
    before = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n").write.mode("overwrite").parquet(
        f"{out}/splits")


def landed(spark: SparkSession, out: str, name: str = "row_id", first: int = 0, file: str | None = None) -> DataFrame:
    """The rows with their position (``first``: of the first one) in front, and with their ``file``, if it is given a name."""
    rows = spark.read.parquet(f"{out}/rows")
    splits = spark.read.parquet(f"{out}/splits")
    no = (F.col("_before") + F.col("_at") - F.col("_first") + F.lit(first)).cast("long")
    about = [F.col("_file").alias(file)] if file else []
    return rows.join(splits, _SPLIT).select(no.alias(name), *about, *[c for c in rows.columns if c not in (*_SPLIT, "_at", name)])


def land_csv(spark: SparkSession, path: str, schema: StructType, out: str, sep: str = ",", header: bool = True,
             corrupt: str | None = None, name: str = "row_id") -> DataFrame:
    """A CSV or a sheet saved as one, landed with its line positions (headers aren't counted)."""
    land(read_csv(spark, path, schema, sep=sep, header=header, corrupt=corrupt), out)
    return landed(spark, out, name)

