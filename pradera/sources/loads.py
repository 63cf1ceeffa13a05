"""Loads that can be repeated (K1), incremental loads with a stored mark (P15 J4), and updates of touched ranges (K6).

A load has an id.  Each of its tables keeps the rows of a load in a partition of their own (``_load``), so a load that
runs again replaces what it wrote before.  What is written isn't read until the load is published: its id is put into the
log (``<log>/_load=<id>``), one small file after all tables.  A load that was ended between two tables is therefore not there,
and running it again leaves each row once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.keys import key_update
from ..session import write_once

LOAD, RANGE = "_load", "_range"
_LOG = f"start string, mark string, {LOAD} string"


def _own_partitions(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _tag(load_id: str) -> str:
    """An id's partition value: text, also where the id is a number."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
        raise ValueError("a load's id has letters, digits, dots, dashes and underscores")
    return f"id-{load_id}"


def stage(df: DataFrame, path: str, load_id: str) -> None:
    """Write the rows of a load into its partition of a table; they aren't read before the load is published."""
    _own_partitions(df.withColumn(LOAD, F.lit(_tag(load_id))), path, LOAD)
    if df.isEmpty():  # nothing was replaced
        fs, p = _folder(df.sparkSession, f"{path}/{LOAD}={_tag(load_id)}")
        fs.delete(p, True)


def publish(spark: SparkSession, log: str, load_id: str, start: str | None = None, mark: str | None = None) -> None:
    """Make a load's staged rows visible; with the mark that it started from and the one it reached."""
    _own_partitions(spark.createDataFrame([(start, mark, _tag(load_id))], _LOG).coalesce(1), log, LOAD)


def load(tables: Mapping[str, DataFrame], log: str, load_id: str) -> None:
    """K1 for all tables (path -> rows) of one load: each row once, however often the load runs."""
    for path, df in tables.items():
        stage(df, path, load_id)
    publish(next(iter(tables.values())).sparkSession, log, load_id)


def published(spark: SparkSession, log: str) -> DataFrame:
    """The log: a row for every published load."""
    return spark.read.schema(_LOG).parquet(log) if _there(spark, log) else spark.createDataFrame([], _LOG)


def _rows(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    if schema is None:
        return spark.read.parquet(path)
    whole = StructType([*schema.fields, StructField(LOAD, StringType())])
    return spark.read.schema(whole).parquet(path) if _there(spark, path) else spark.createDataFrame([], whole)


def loaded(spark: SparkSession, path: str, log: str, schema: StructType | None = None) -> DataFrame:
    """A table's rows of published loads (partitions of others aren't read); ``schema`` where it may have no row yet."""
    return _rows(spark, path, schema).join(published(spark, log).select(LOAD), LOAD, "left_semi").drop(LOAD)


def load_new(source: DataFrame, path: str, log: str, load_id: str, *, mark: str, keys: Sequence[str]) -> None:
    """Load the rows of ``source`` from the stored mark on whose keys aren't loaded yet.

    The mark is the largest ``mark`` value that was loaded.  It is read from the log, so a source that is partitioned by
    ``mark`` is only read from there on, and of the stored table only the keys are.  Null keys match each other; rows with a
    null mark are looked at each time.  Of rows that share their keys the one with the smallest mark is taken, so several runs
    over a growing source equal one run over all of it.  A load that runs again starts from the mark that it started from."""
    spark, tag = source.sparkSession, _tag(load_id)
    done = published(spark, log)
    kind = source.schema[mark].dataType
    again = done.where(F.col(LOAD) == tag).first()
    if again is None:
        start = done.agg(F.max(F.col("mark").cast(kind)).cast("string")).first()[0]  # a row a load
    else:
        start = again["start"]
    new = source
    if start is not None:
        new = source.where((F.col(mark) >= F.lit(start).cast(kind)) | F.col(mark).isNull())
    known = _rows(spark, path, source.schema).join(done.where(F.col(LOAD) != tag).select(LOAD), LOAD, "left_semi")
    known = known.select([F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    new = new.join(known, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)], "left_anti")
    rest = [c for c in new.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(F.col(mark).isNull(), mark, F.xxhash64(*rest)))
    new = new.groupBy(*keys).agg(first.alias("_r")).select([F.col(c) if c in keys else F.col(f"_r.{c}").alias(c)
                                                            for c in source.columns])
    stage(new, path, load_id)
    own = _rows(spark, path, source.schema).where(F.col(LOAD) == tag)
    publish(spark, log, load_id, start, own.agg(F.max(mark).cast("string")).first()[0])


def by_range(df: DataFrame, key: str, width: int) -> DataFrame:
    """``df`` with the key range that each row is stored in (null keys: none)."""
    return df.withColumn(RANGE, F.floor(F.col(key) / F.lit(width)).cast("long"))


def store_ranges(df: DataFrame, path: str, key: str, width: int) -> None:
    """Write a table by ranges of its key, as ``update_touched`` needs it."""
    by_range(df, key, width).repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(path)


def update_touched(spark: SparkSession, path: str, updates: DataFrame, key: str, col: str, width: int, **how) -> None:
    """K6 on a table that ``store_ranges`` wrote: only ranges that hold an updated key are read and written.

    Rows without an update keep their value (the form that sets them to null touches everything: ``keys.key_update``).  The new
    rows are complete in the shared folder before a range is replaced, so a job that is ended can run again."""
    touched = by_range(updates.where(F.col(key).isNotNull()).select(key), key, width).select(RANGE).distinct()
    table = spark.read.parquet(path)
    old = table.withColumn(RANGE, F.col(RANGE).cast("long")).join(write_once(touched, "touched"), RANGE, "left_semi")
    new = write_once(key_update(old, updates, key, col, unmatched_to_null=False, **how).select(*table.columns), "touched-rows")
    _own_partitions(new.repartition(RANGE), path, RANGE)


def stored_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``store_ranges`` wrote."""
    return spark.read.parquet(path).drop(RANGE)
