"""Aggregations and de-duplication.

Every aggregate has a map-side partial step, so a hot key is pre-aggregated
before the shuffle.  Order-dependent picks use ``max_by`` over an explicit
order (never file order); those that carry whole rows plan as sort
aggregates, the others as hash aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def herd_day_totals(df: DataFrame, keys: Sequence[str], *, animals: str, milk: str,
                    operator_id: int | None = None, either: Sequence[str] = ("id_hato", "hato_raw")) -> DataFrame:
    """A1 (T3): animals and milk summed per group; a row whose key is null is
    dropped (the two ``either`` columns form one id-or-text key, null only
    when both are); a group of only null values sums to 0."""
    ok = F.lit(True)
    pair = [k for k in keys if k in either]
    if pair:
        ok = ok & F.coalesce(*[F.col(k).cast("string") for k in pair]).isNotNull()
    for k in keys:
        if k not in pair:
            ok = ok & F.col(k).isNotNull()
    g = df.filter(ok).groupBy(*keys).agg(
        F.coalesce(F.sum(animals), F.lit(0)).alias("numero_animales"),
        F.coalesce(F.sum(milk), F.lit(0.0)).alias("leche_total"))
    if operator_id is not None:
        g = g.withColumn("id_operario", F.lit(operator_id))
    return g


def last_non_null_by_group(df: DataFrame, keys: Sequence[str], value: str, order: str | Column,
                           name: str | None = None) -> DataFrame:
    """A2: per group, the last non-null ``value`` in ``order`` (pandas ``groupby().last()``)."""
    o = _c(order)
    v = F.col(value)
    return (df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
              .groupBy(*keys)
              .agg(F.max_by(v, F.when(v.isNotNull(), o)).alias(name or value)))


def latest_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column | str],
              name: str | None = None) -> DataFrame:
    """A3: per group, ``value`` of the row that is last in ``order`` (ties broken
    by the later order columns)."""
    st = F.struct(*[_c(o) for o in order])
    return df.groupBy(*keys).agg(F.max_by(F.col(value), st).alias(name or value))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A5: one row per key, the last in ``order`` (``drop_duplicates(keep='last')``).

    Aggregate form: ``max_by(struct(all columns), order)`` is a partial
    aggregate, so a key with a third of the rows is reduced map-side before
    the shuffle (a ``row_number`` window would put it in one task).  Rows with
    a null key form their own group, as pandas does in ``drop_duplicates``.
    """
    others = [c for c in df.columns if c not in keys]
    st = F.struct(*[_c(o) for o in order])
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), st).alias("_last"))
    return g.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others]).select(*df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """A4: row-distinct."""
    return df.distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values (``sorted(set(x.dropna()))``)."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value (``value_counts``: null not counted)."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one row."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def bounds(df: DataFrame, col: str) -> DataFrame:
    """Global min and max."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A10: total cells, null cells and their ratio, one row."""
    cols = list(cols or df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    total = F.count(F.lit(1)) * F.lit(len(cols))
    return df.agg(total.cast("bigint").alias("total_cells"), nulls.cast("bigint").alias("na_cells")) \
             .withColumn("na_ratio", F.try_divide(F.col("na_cells"), F.col("total_cells")))


def change_dates(df: DataFrame, date_col: str, start: str | None = None) -> DataFrame:
    """Distinct change dates at or after ``start`` (``yyyyMMdd``)."""
    d = df.select(F.col(date_col)).distinct()
    if start and start != "no":
        d = d.filter(F.col(date_col) >= F.to_date(F.lit(start), "yyyyMMdd"))
    return d


def nested_series(df: DataFrame, keys: Sequence[str], month: str, series: str, order: Sequence[Column | str],
                  value: str, date_text: str) -> DataFrame:
    """Per key and month, ``{series -> [values in order], month -> [sorted distinct dates]}``
    as a map column ``doc`` (values kept with their nulls; every row's value is in its list).

    A document is one value, so it holds what one key has in one month: the lists are the feature."""
    st = F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(value).alias("_v"))
    per = (df.groupBy(*keys, month, series)
             .agg(F.array_sort(F.collect_list(st)).alias("_l"))
             .withColumn("_vals", F.transform("_l", lambda s: s["_v"].cast("string"))))
    dates = (df.groupBy(*keys, month)
               .agg(F.array_sort(F.collect_set(date_text)).alias("_dates")))
    entries = per.groupBy(*keys, month).agg(
        F.collect_list(F.struct(F.col(series).alias("key"), F.col("_vals").alias("value"))).alias("_e"))
    out = entries.join(dates, on=[*keys, month], how="inner")
    return out.select(*keys, month, F.map_from_entries(F.array_sort(F.concat(
        F.col("_e"), F.array(F.struct(F.col(month).alias("key"), F.col("_dates").alias("value")))))).alias("doc"))
