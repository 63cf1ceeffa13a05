"""Writers (K1-K6).

Tables are written as parquet (or through JDBC when a driver is on the
cluster's class path); exports are CSV / JSON-lines folders written by the
executors in parallel -- nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: append to a parquet table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K2: replace a parquet table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    """K1/K2 through JDBC (needs the database's driver jar; none is bundled here)."""
    df.write.mode(mode).jdbc(url, table, properties=properties or {})


def export_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """K3: CSV folder with a header line per file; values keep their blanks (Spark trims them by default)."""
    (df.write.mode(mode).option("header", True).option("sep", sep)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def nested_documents(df: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """K4: one JSON text per key from a map column (keys sorted, as ``sort_keys``)."""
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries(F.col(doc))))
    return df.select(F.col(key), F.to_json(sorted_map).alias("json"))


def export_json_documents(df: DataFrame, path: str, key: str, doc: str = "doc", mode: str = "overwrite") -> None:
    """K4: write the documents as JSON lines ``{"key": ..., "json": ...}``."""
    nested_documents(df, key, doc).write.mode(mode).json(path)


def patch_payload(df: DataFrame, fields: Sequence[str], name: str = "payload") -> DataFrame:
    """K5: one JSON object per row with null fields left out (the PATCH body)."""
    return df.withColumn(name, F.to_json(F.struct(*[F.col(f) for f in fields])))


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """A stored table kept in ``buckets`` buckets of its join key, sorted by it, and read back.

    A join of an incoming frame with it on ``keys`` shuffles the incoming side only (``operators.reconcile``)."""
    w = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", path) if path else w).saveAsTable(name)
    return df.sparkSession.table(name)
