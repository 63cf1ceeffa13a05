"""Daily calendars and dense key x day grids.

The bounds are two scalar subqueries (one partial/final aggregate, no driver
round trip); the grid is generated next to each key row: first its months,
which are spread over the tasks, then their days, so it grows linearly with
keys x days, never goes through a join or a broadcast, and no task makes more
than its share of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_bounds(df: DataFrame, date_col: Column | str) -> tuple[Column, Column]:
    """``(min, max)`` of a date column as scalar-subquery Columns."""
    c = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    return df.select(F.min(c)).scalar(), df.select(F.max(c)).scalar()


def calendar(df: DataFrame, date_col: Column | str, name: str = "date", offset: int = 1) -> DataFrame:
    """One row per day between the data bounds.

    ``offset`` is accepted and ignored, like the original function, which
    always builds a daily range.
    """
    lo, hi = date_bounds(df, date_col)
    return df.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias(name))


def key_days(keys: DataFrame, key_cols: Sequence[str], lo: Column, hi: Column, name: str = "date") -> DataFrame:
    """Distinct keys x every day in ``[lo, hi]``, generated per key and month.

    The (key, month) rows are dealt to a fixed number of tasks: they are few and small, so left to itself Spark would
    join them into one partition, and one task would make the whole grid."""
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    months = keys.select(*key_cols).distinct().withColumn("_month", F.explode(F.sequence(
        F.trunc(lo, "month"), hi, F.expr("interval 1 month"))))
    days = F.sequence(F.greatest(F.col("_month"), lo), F.least(F.last_day("_month"), hi))
    return months.repartition(tasks, *key_cols, "_month").withColumn(name, F.explode(days)).drop("_month")


def dense_grid(keys: DataFrame, key_cols: Sequence[str], facts: DataFrame, fact_keys: Sequence[str],
               fact_date: Column | str, bounds_from: DataFrame | None = None, name: str = "date",
               start: str | None = None) -> DataFrame:
    """J10 + J11: keys x calendar, left joined with the facts on (key, day).

    Facts keep all their columns; several facts on one key-day all stay
    (fan-out kept).  ``start`` (``yyyyMMdd``) drops grid days before it (P13).
    """
    fd = F.to_date(F.col(fact_date) if isinstance(fact_date, str) else fact_date)
    src = bounds_from if bounds_from is not None else facts
    lo, hi = date_bounds(src, fact_date)
    grid = key_days(keys, key_cols, lo, hi, name)
    if start is not None and start != "no":
        grid = grid.filter(F.col(name) >= F.to_date(F.lit(start), "yyyyMMdd"))
    # fact keys under private names: no ambiguity when keys and facts share a source
    f = facts.withColumn("_fday", fd).withColumnsRenamed({fk: f"_fk{i}" for i, fk in enumerate(fact_keys)})
    cond = [F.col(k) == F.col(f"_fk{i}") for i, k in enumerate(key_cols)] + [F.col(name) == F.col("_fday")]
    out = grid.join(f, cond, "left").drop(*[f"_fk{i}" for i in range(len(fact_keys))])
    return out.drop("_fday")
