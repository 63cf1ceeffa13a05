"""Reshaping and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable",
            value: str = "value") -> DataFrame:
    """Wide -> long (``pd.melt``); nulls kept."""
    return df.unpivot(list(ids), list(values), variable, value)


def explode_non_null(df: DataFrame, ids: Sequence[str], array_col: Column | str, name: str) -> DataFrame:
    """R2: one row per non-null array element (``stack`` drops nulls)."""
    a = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*ids, F.explode(F.filter(a, lambda x: x.isNotNull())).alias(name))


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union all by column name (missing columns as null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (``left_only``)."""
    return left.join(right.select(*keys).distinct(), on=list(keys), how="left_anti")


def key_intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right`` (``both``)."""
    return left.join(right.select(*keys).distinct(), on=list(keys), how="left_semi")
