"""Single-window version of ``ordered_scan`` (one task per key): what the chunked scan has to equal."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def window_reference(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *,
                     sums=None, runs=None, ffill=None, lags=None, row_number=None, run_fills=None,
                     lag_fills=None, last_pos=None, change_ids=None, before=None, leads=None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[_c(o) for o in order])
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outs = {}
    for n, c in (sums or {}).items():
        outs[n] = F.sum(F.coalesce(_c(c), F.lit(0))).over(wr)
    for n, (c, k) in (lags or {}).items():
        outs[n] = F.lag(_c(c), k).over(w)
    for n, c in (ffill or {}).items():
        outs[n] = F.last(_c(c), ignorenulls=True).over(wr)
    for n, c in (before or {}).items():
        outs[n] = F.last(_c(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    for n, c in (leads or {}).items():
        outs[n] = F.lead(_c(c), 1).over(w)
    if row_number:
        outs[row_number] = F.row_number().over(w)
    d = df.withColumns(outs) if outs else df
    for n, c in (runs or {}).items():
        v = F.coalesce(_c(c), F.lit(0))
        d = d.withColumn("_g", F.sum(F.when(v == 0, 1).otherwise(0)).over(wr))
        w2 = Window.partitionBy(*keys, "_g").orderBy(*[_c(o) for o in order]).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn(n, F.sum(v).over(w2)).drop("_g")
    for n, c in (last_pos or {}).items():
        d = d.withColumn(n, F.last(F.when(F.coalesce(_c(c).cast("boolean"), F.lit(False)), F.row_number().over(w)),
                                   ignorenulls=True).over(wr))
    for n, c in (change_ids or {}).items():
        first = (F.row_number().over(w) == 1) | ~_c(c).eqNullSafe(F.lag(_c(c), 1).over(w))
        d = d.withColumn("_n", F.when(first, 1).otherwise(0)).withColumn(n, F.sum("_n").over(wr)).drop("_n")
    for n, (c, st) in (lag_fills or {}).items():
        d = d.withColumn("_lv", F.when(F.coalesce(_c(st).cast("boolean"), F.lit(False)), F.lag(_c(c), 1).over(w)))
        d = d.withColumn(n, F.last("_lv", ignorenulls=True).over(wr)).drop("_lv")
    for n, (c, reset) in (run_fills or {}).items():
        v = F.coalesce(_c(c), F.lit(0))
        if reset:
            v = F.when(F.row_number().over(w) == 1, F.lit(0)).otherwise(v)
        d = d.withColumn("_v", v).withColumn("_g", F.sum(F.when(F.col("_v") == 0, 1).otherwise(0)).over(wr))
        w2 = Window.partitionBy(*keys, "_g").orderBy(*[_c(o) for o in order]).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn("_r", F.nullif(F.sum("_v").over(w2), F.lit(0)))
        d = d.withColumn(n, F.last("_r", ignorenulls=True).over(wr)).drop("_g", "_v", "_r")
    return d
