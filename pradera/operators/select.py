"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Select by position (names resolved from ``df.columns``)."""
    cols = df.columns
    return df.select(*[cols[i] for i in positions])


def rotate_last_first(df: DataFrame) -> DataFrame:
    """``cols[-1:] + cols[:-1]``."""
    cols = df.columns
    return df.select(*(cols[-1:] + cols[:-1]))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wholesale rename (``df.columns = [...]``)."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dict."""
    return df.withColumnsRenamed(mapping)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """P5: reindex to a target column list; missing columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Constant columns; ``(None, type)`` gives a typed null."""
    cols = {}
    for k, v in values.items():
        if isinstance(v, tuple):
            cols[k] = F.lit(v[0]).cast(v[1])
        else:
            cols[k] = F.lit(v)
    return df.withColumns(cols)


def not_equal_keep_null(df: DataFrame, col: str, value) -> DataFrame:
    """P8 (T1): ``col != value`` keeping null rows, as pandas does."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """``dropna(subset=...)``."""
    return df.na.drop(subset=list(subset))


def keep_min_non_null(df: DataFrame, thresh: int) -> DataFrame:
    """Keep rows with at least ``thresh`` non-null cells."""
    return df.na.drop(thresh=thresh)


def since_date(df: DataFrame, col: str, start: str | None) -> DataFrame:
    """``col >= start`` with ``start`` as ``yyyyMMdd``; ``'no'`` or None turns it off."""
    if start is None or start == "no":
        return df
    return df.filter(F.col(col) >= F.to_date(F.lit(start), "yyyyMMdd"))


def skip_first(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Drop the first data row of a landed file (its stored ``row_id`` is 0)."""
    return df.filter(F.col(row_id) > 0)


def above_mark(df: DataFrame, col: str, mark_from: DataFrame, mark_col: str | None = None) -> DataFrame:
    """Rows with ``col`` above the maximum of ``mark_from`` (scalar subquery, no driver trip)."""
    mark = mark_from.select(F.max(mark_col or col)).scalar()
    return df.filter(F.col(col) > mark)


def any_of(*conds: Column) -> Column:
    """P10: OR of predicates."""
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
