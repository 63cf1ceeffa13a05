"""Large JSON array files (S5-S7), cut into their elements by many tasks.

Spark reads a ``multiLine`` file in one task.  Here a file is read in pieces that end with a closing brace, as text with that
line separator, so it is split like any text file.  A brace may stand inside a string or close an inner object: the
pieces are landed in order (``landing``), and three running sums over them tell for each piece whether it begins inside a
string, how deep it ends, and of which element it is a part.  Elements are objects, nested or not; a file may hold
several arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scan import ordered_scan
from .landing import land, landed

QUOTE, BACKSLASH = '"', "\\"


def json_elements(spark: SparkSession, path: str, out: str) -> DataFrame:
    """``row_id`` (position in the dump, files by name) and ``element`` (its JSON text) of every array element.

    ``out``: folder of the landed pieces.  Objects that aren't closed at the end of the dump are kept as they are, so that who
    parses them sees the error; an array without elements gives no row."""
    land(spark.read.option("lineSep", "}").text(path), out)
    d = landed(spark, out, "_piece", file="_in")
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    d = d.withColumn("_bare", bare)
    quotes = (F.length("_bare") - F.length(F.replace(F.col("_bare"), F.lit(QUOTE), F.lit("")))).cast("long")
    d = ordered_scan(d.withColumn("_quotes", quotes), ["_in"], ["_piece"], sums={"_q": "_quotes"},
                     leads={"_next": "_piece"})
    inside = (F.col("_q") - F.col("_quotes")) % 2  # 1: the piece begins in a string
    code = F.array_join(F.filter(F.split("_bare", QUOTE), lambda x, i: (i + inside) % 2 == 0), "")
    opened = F.length(code) - F.length(F.replace(code, F.lit("{"), F.lit("")))
    closed = ((F.col("_q") % 2 == 0) & F.col("_next").isNotNull()).cast("long")  # a file's last has no brace behind it
    d = d.withColumns({"_closed": closed, "_change": opened - closed}).drop("_bare", "_quotes", "_q", "_next")
    d = ordered_scan(d, ["_in"], ["_piece"], sums={"_depth": "_change"})
    d = d.withColumn("_ends", ((F.col("_closed") == 1) & (F.col("_depth") == 0)).cast("long"))
    d = ordered_scan(d.select("_in", "_piece", "value", "_ends"), [], ["_piece"], sums={"_done": "_ends"})
    parts = d.groupBy("_in", (F.col("_done") - F.col("_ends")).alias("row_id")).agg(
        F.array_sort(F.collect_list(F.struct("_piece", "value"))).alias("p"), F.max("_ends").alias("_whole"))
    text = F.array_join(F.transform("p", lambda x: x["value"]), "}")
    text = F.regexp_replace(F.when(F.col("_whole") == 1, F.concat(text, F.lit("}"))).otherwise(text), r"^[\s,\[\]]+", "")
    return parts.select("row_id", text.alias("element")).where("element <> ''")


def read_json_array(spark: SparkSession, path: str, schema: StructType, out: str, rest: str | None = None,
                    corrupt: str | None = None) -> DataFrame:
    """The elements as rows of ``schema``; a missing field reads as null.

    ``rest``: name of a variant column that holds the whole element, fields that the schema doesn't name included.
    A malformed element is an error; with ``corrupt`` it becomes a row of nulls that has its text in that column."""
    d = json_elements(spark, path, out)
    # parsed leniently, and then looked at: an element that is no JSON has no variant either
    row = F.from_json("element", schema)
    v = F.try_parse_json("element")
    bad = v.isNull() | (F.schema_of_variant(v).startswith("OBJECT") == F.lit(False))
    if corrupt is None:
        row = F.when(bad, F.raise_error(F.concat(F.lit("malformed element: "), F.substring("element", 1, 200)))).otherwise(row)
    cols = [F.col("_row")[f.name].alias(f.name) for f in schema.fields]
    d = d.select("element", row.alias("_row"), v.alias("_v"), bad.alias("_bad"))
    if rest is not None:
        cols.append(F.col("_v").alias(rest))
    if corrupt is not None:
        cols.append(F.when(F.col("_bad"), F.col("element")).alias(corrupt))
    return d.select(*cols)
