"""Reconciling incoming rows with stored ones.

Joins use SQL equality (a null key never matches, trap T2); ``null_safe=True``
reproduces pandas, which matches NaN with NaN.  Spark picks the physical join
(AQE turns a small side into a broadcast at run time and splits skewed keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGE = "_merge"
HASH = "_hash"


def hashed(df: DataFrame, key: str) -> DataFrame:
    """Adds a hash of ``key``, to be a join key in front of it: long texts that begin alike sort slowly, numbers don't.

    Equal keys have equal hashes, so the key beside it decides; bucketed tables need none."""
    return df.withColumn(HASH, F.xxhash64(key))


def _cond(left: DataFrame, right: DataFrame, lk: Sequence[str], rk: Sequence[str], null_safe: bool) -> Column:
    out = None
    for a, b in zip(lk, rk):
        c = left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]
        out = c if out is None else out & c
    return out


def _suffixed(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes=("_x", "_y")):
    """Rename clashing non-key columns like pandas (``_x`` / ``_y``)."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    l2 = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    r2 = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return l2, r2


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], indicator: str = MERGE,
              suffixes=("_x", "_y"), null_safe: bool = False) -> DataFrame:
    """Full outer join on ``keys`` with a pandas-style indicator
    (``left_only`` / ``right_only`` / ``both``); key columns are coalesced.  With ``null_safe`` null keys match (trap T2)."""
    l2, r2 = _suffixed(left, right, keys, suffixes)
    l2 = l2.withColumnsRenamed({k: f"_lk_{k}" for k in keys}).withColumn("_in_l", F.lit(True))
    r2 = r2.withColumnsRenamed({k: f"_rk_{k}" for k in keys}).withColumn("_in_r", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(f"_lk_{k}").eqNullSafe(F.col(f"_rk_{k}")) if null_safe else F.col(f"_lk_{k}") == F.col(f"_rk_{k}")
        cond = c if cond is None else cond & c
    j = l2.join(r2, cond, "full")
    j = j.withColumns({k: F.coalesce(F.col(f"_lk_{k}"), F.col(f"_rk_{k}")) for k in keys})
    j = j.withColumn(indicator, F.when(F.col("_in_l") & F.col("_in_r"), "both")
                     .when(F.col("_in_l"), "left_only").otherwise("right_only"))
    rest = [c for c in j.columns if not c.startswith(("_lk_", "_rk_", "_in_")) and c not in keys]
    return j.select(*keys, *rest)


def join_flag(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
              flag: str = MERGE, null_safe: bool = False, suffixes=("_x", "_y")) -> DataFrame:
    """Left join with an indicator (``both`` / ``left_only``)."""
    l2, r2 = _suffixed(left, right, [k for k in left_on if k in right_on], suffixes)
    r2 = r2.withColumn("_in_r", F.lit(True))
    j = l2.join(r2, _cond(l2, r2, left_on, right_on, null_safe), "left")
    same = [k for k, rk in zip(left_on, right_on) if k == rk]
    for k in same:
        j = j.drop(r2[k])
    return j.withColumn(flag, F.when(F.col("_in_r"), "both").otherwise("left_only")).drop("_in_r")


def anti(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None,
         null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` without a match (``~isin``; left join + isnull)."""
    right_on = right_on or left_on
    return left.join(right, _cond(left, right, left_on, right_on, null_safe), "left_anti")


def semi(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None,
         null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` with at least one match (no fan-out)."""
    right_on = right_on or left_on
    return left.join(right, _cond(left, right, left_on, right_on, null_safe), "left_semi")


def audit_missing(ids: DataFrame, id_col: str, dim: DataFrame, dim_key: str, name_col: str) -> DataFrame:
    """Distinct ids whose dimension row is missing or has a null name."""
    d = ids.select(F.col(id_col).alias("_id")).distinct()
    j = d.join(dim.select(F.col(dim_key).alias("_dk"), F.col(name_col).alias("_nm")),
               F.col("_id") == F.col("_dk"), "left")
    return j.filter(F.col("_nm").isNull()).select(F.col("_id").alias(id_col))


def parent_lookup(df: DataFrame, parent_name: str, dim: DataFrame, dim_name: str, dim_id: str,
                  out: str) -> DataFrame:
    """parent's name -> parent's id through the same dimension (aliased left join;
    several dimension rows with that name fan out, as a merge does)."""
    d = dim.select(F.col(dim_name).alias("_pn"), F.col(dim_id).alias("_pid"))
    j = df.join(d, df[parent_name] == d["_pn"], "left")
    return j.withColumn(out, F.col("_pid")).drop("_pn", "_pid")


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes=("_x", "_y")) -> DataFrame:
    """Left join adding the right side's columns, clashing names suffixed."""
    l2, r2 = _suffixed(left, right, keys, suffixes)
    return l2.join(r2, on=list(keys), how="left")
