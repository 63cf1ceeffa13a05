"""Dictionary recodes and CASE recodes (F11 F12 F13 F17 F26 F27 F28, J1 helper).

Small fixed dictionaries become ``CASE``/``map`` literals inside the plan
(no join at all); recode *tables* (data) are joined, and the planner broadcasts
them where their size allows (``recode_join``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _lit_map(mapping: Mapping) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def recode(col: Column | str, mapping: Mapping, default=None, keep_unmatched: bool = True) -> Column:
    """value through a fixed dictionary; unmatched keep their value
    (``replace``) or take ``default``.  Null input stays null unless ``default``."""
    c = _c(col)
    m = F.try_element_at(_lit_map(mapping), c)
    if keep_unmatched:
        return F.coalesce(m, c) if default is None else F.coalesce(m, c, F.lit(default))
    return m if default is None else F.coalesce(m, F.lit(default))


def recode_with_fallback(df: DataFrame, col: str, mapping: Mapping, id_col: str, raw_col: str) -> DataFrame:
    """F12/F13 (H3): mapped id in ``id_col``; the original text in ``raw_col``
    only where no id was found (a mixed id-or-text column becomes two)."""
    mid = F.try_element_at(_lit_map(mapping), F.col(col))
    return df.withColumns({id_col: mid, raw_col: F.when(mid.isNull(), F.col(col))})


def case_map(col: Column | str, pairs: Mapping, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``."""
    c = _c(col)
    out = None
    for k, v in pairs.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def shift_code(col: Column | str) -> Column:
    """``x <= 0 -> x + 2``, ``x > 0 -> x + 1``; null stays null."""
    c = _c(col)
    return F.when(c <= 0, c + 2).when(c > 0, c + 1)


def recode_join(df: DataFrame, table: DataFrame, on: str, table_key: str, value: str, out: str,
                default=None) -> DataFrame:
    """Left lookup join to a recode table and replace ``on`` by the mapped
    value (``default`` when missing)."""
    # no dedupe: duplicate map rows fan out, as a pandas merge does
    t = table.select(F.col(table_key).alias("_rk"), F.col(value).alias("_rv"))
    j = df.join(t, df[on] == t["_rk"], "left")
    val = F.col("_rv") if default is None else F.coalesce(F.col("_rv"), F.lit(default))
    return j.withColumn(out, val).drop("_rk", "_rv")
