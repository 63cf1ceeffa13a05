"""Helpers shared by the operators: table reads, shared-folder cuts, block pairs and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.session import write_once


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and read it back: cuts lineage, survives lost executors."""
    return write_once(df, name)


def block_pairs(rows: DataFrame, group: str, block_rows: int) -> DataFrame:
    """Deal each group's rows into block pairs, so that every unordered pair of rows of one group meets in one task.

    ``rows`` has ``group`` and ``id`` (unique in a group).  A group of n rows is cut into b = ceil(n / block_rows)
    blocks by a hash of ``id``; a row of block k goes to the b pairs that hold k.  Adds ``bi`` <= ``bj`` (the pair) and
    ``blk`` (the row's own block).  Rows are repeated b times, never once per partner.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("int").alias("_nb"))
    dealt = rows.join(sizes, group).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("_nb")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    return (dealt.withColumn("_other", others)
            .withColumn("bi", F.least("blk", "_other")).withColumn("bj", F.greatest("blk", "_other"))
            .drop("_nb", "_other"))


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id per vertex, by alternating large-star and small-star rounds.

    ``edges`` has ``a``, ``b`` (long, any direction; loops and repeats allowed).  Returns ``id``, ``component`` for
    every vertex of an edge with a != b.  Each round is written to the shared folder; only a row count and a checksum
    come to the driver.
    """
    e = stored(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(),
               f"{name}-cc")  # u > v
    mark = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("x"))
        small = small.select("x.u", F.col("x.m").alias("v")).where("u <> v").distinct()
        e = stored(small, f"{name}-cc")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        mark = now
    raise RuntimeError(f"components of {name} did not settle in {max_rounds} rounds")
