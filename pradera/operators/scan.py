"""Ordered scans per key that stay parallel when one key holds most rows.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task, so a key with a third of all rows
becomes one straggler task.  ``ordered_scan`` gives the same answers as that single window but cuts the rows of such keys
into chunks along the order:

1. ``lay_out`` counts the keys' rows; if one has more than LEAST and a task's share, it draws a sample of (key, order) by hash, of
   SAMPLE rows a task.  Every CUT-th sampled row of a key is a bound, so keys with few rows have none, and there are about
   SAMPLE / CUT bounds a task, which become a literal; a row's chunk is the number of bounds at or below it, a
   deterministic Column,
2. windows run inside each (key, chunk): one shuffle of the rows, which aren't written,
3. keys with bounds have one summary row per chunk, aggregated from a narrow copy of their own rows only; the summaries
   (as many as bounds) are scanned per key, stored and joined back.  Keys in one chunk need none, and without any key of several
   chunks the scan is the plain window.

A second scan with the same keys and order can take the ``Layout`` of the first: its rows lie in the right tasks
already, and it adds only its own summary.  A caller that has a chunk Column which never decreases with the order (a bucket of
the date) may pass it instead.  ``order`` holds plain Columns: ascending, null values first, as in a window.

Supported outputs (all equal to the unbounded-preceding window on the key):

* ``sums``   running sum (nulls count as 0)
* ``runs``   sum since the last zero value at or before the row (a running
             count that resets at 0; a row with value 0 gives 0)
* ``ffill``  last non-null value at or before the row
* ``lags``   value ``k`` rows earlier (``k`` small)
* ``run_fills``  ``{name: (value, reset_at_start)}``: the run (as ``runs``)
             with zeros turned to null and then forward filled, i.e. the run
             length at the last non-zero row; ``reset_at_start`` counts the
             key's first row as a zero
* ``lag_fills``  ``{name: (value, start)}``: on a ``start`` row the value of
             the row before it, forward filled (last non-null) over the key
* ``change_ids``  running number of the key's runs of equal values (null equals null); the first run is 1
* ``last_pos``  ``{name: condition}``: position (as ``row_number``) of the
             last row at or before this one where the condition holds, else null
* ``before``  last non-null value before the row (``ffill`` without the row itself)
* ``leads``  value of the next row
* ``row_number``  1-based position of the row in its key

Rows with a null key get null outputs (a pandas ``groupby`` drops null keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..session import write_once

CHUNK = "_chunk"
SAMPLE = 64  # rows sampled for each task
CUT = 32     # sampled rows of a key from one bound to the next
LEAST = 1 << 18  # rows of a key that one task takes in any case


class Layout(NamedTuple):
    """Where rows lie: the name of their chunk column, and which keys have more than one chunk (None: none)."""

    chunk: str
    several: Column | None


def day_chunk(date_col: Column | str, days: int = 31) -> Column:
    """Chunk id = bucket of ``days`` calendar days (monotone in the date)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.floor(F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")) / F.lit(days))


def value_chunk(col: Column | str, width: int) -> Column:
    """Chunk id = bucket of an integral order column (ids, counters)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c / F.lit(width))


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], chunk: str = CHUNK,
            counted: tuple[DataFrame, Sequence[str]] | None = None) -> tuple[DataFrame, Layout]:
    """``df`` with its chunk column, and the layout to hand to every scan over ``keys`` in ``order``.

    Without a key of more than LEAST rows there are no bounds.  Rows that share all of key and order can't be parted.  Rows with
    a null key have no outputs; they are spread by hash.  ``counted``: a frame and keys of it whose counts stand for those
    of ``df``, where it is made from it at some cost."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    at = F.struct(*key, *[_c(o).alias(f"o{i}") for i, o in enumerate(order)])
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    spread = F.pmod(F.xxhash64(*[_c(o) for o in order]), F.lit(tasks)).cast("long")
    if keys:
        rows, by = counted or (df.where(whole), keys)
        n, most = rows.groupBy(*by).count().agg(F.sum("count"), F.max("count")).first()
    else:
        n = most = df.count()
    want, bounds = SAMPLE * tasks, []
    if n and n > want and most > max(LEAST, n // tasks):  # else no key has more rows than a task
        drawn = F.shiftrightunsigned(F.xxhash64("at"), 1) / float(1 << 63)
        sample = df.where(whole).select(at.alias("at")).where(drawn < want / n)
        place = F.row_number().over(Window.partitionBy(*[F.col(f"at.k{i}") for i in range(len(key))]).orderBy("at"))
        sample = sample.withColumn("_place", place).where(F.col("_place") % CUT == 0)
        bounds = sample.sort("at").collect()
    if not bounds:
        return df.withColumn(chunk, F.when(whole, F.lit(0).cast("long")).otherwise(spread)), Layout(chunk, None)
    # a row of the sorted bounds, and of the keys that have any
    kept = df.sparkSession.createDataFrame([([r["at"] for r in bounds],)], StructType([
        StructField("b", ArrayType(sample.schema["at"].dataType))]), verifySchema=False)
    # number of bounds at or below the row, by halving steps; behind the last bound there is none to compare with
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((SAMPLE // CUT * tasks).bit_length() + 1))])
    down = F.aggregate(steps, F.lit(0), lambda pos, step: F.when(
        F.get(F.col("_bounds"), pos + step - 1) <= at, pos + step).otherwise(pos))
    d = df.withColumn("_bounds", kept.select("b").scalar()).withColumn(
        chunk, F.when(whole, down.cast("long")).otherwise(spread)).drop("_bounds")
    hot = F.transform("b", lambda x: F.struct(*[x[f"k{i}"].alias(f"k{i}") for i in range(len(key))]))
    return d, Layout(chunk, F.array_contains(kept.select(hot).scalar(), F.struct(*key)) if keys else F.lit(True))


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    chunk: Column | str | Layout | None = None,
    *,
    sums: Mapping[str, Column | str] | None = None,
    runs: Mapping[str, Column | str] | None = None,
    ffill: Mapping[str, Column | str] | None = None,
    lags: Mapping[str, tuple[Column | str, int]] | None = None,
    run_fills: Mapping[str, tuple[Column | str, bool]] | None = None,
    lag_fills: Mapping[str, tuple[Column | str, Column | str]] | None = None,
    last_pos: Mapping[str, Column | str] | None = None,
    change_ids: Mapping[str, Column | str] | None = None,
    before: Mapping[str, Column | str] | None = None,
    leads: Mapping[str, Column | str] | None = None,
    row_number: str | None = None,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add scan outputs to ``df``; see the module doc. ``order`` must be total within a key."""
    sums, runs, ffill, lags = dict(sums or {}), dict(runs or {}), dict(ffill or {}), dict(lags or {})
    run_fills = dict(run_fills or {})
    lag_fills = dict(lag_fills or {})
    last_pos = dict(last_pos or {})
    change_ids = dict(change_ids or {})
    keys = list(keys)
    order = [_c(o) for o in order]
    before, leads = dict(before or {}), dict(leads or {})
    if chunk is None:
        d, layout = lay_out(df, keys, order)
    elif isinstance(chunk, Layout):
        d, layout = df, chunk
    else:  # rows without an order value come first
        d = df.withColumn(CHUNK, F.coalesce(_c(chunk).cast("long"), F.lit(-(1 << 62)).cast("long")))
        layout = Layout(CHUNK, F.lit(True))
    part = keys + [layout.chunk]

    # materialise inputs once, under private names
    inputs = {}
    for n, c in sums.items():
        inputs[f"_vs_{n}"] = F.coalesce(_c(c), F.lit(0))
    for n, c in runs.items():
        inputs[f"_vr_{n}"] = F.coalesce(_c(c), F.lit(0))
    for n, c in ffill.items():
        inputs[f"_vf_{n}"] = _c(c)
    for n, (c, _k) in lags.items():
        inputs[f"_vl_{n}"] = _c(c)
    for n, (c, _r) in run_fills.items():
        inputs[f"_vq_{n}"] = F.coalesce(_c(c), F.lit(0))
    for n, c in last_pos.items():
        inputs[f"_vp_{n}"] = F.coalesce(_c(c).cast("boolean"), F.lit(False))
    for n, (c, st) in lag_fills.items():
        inputs[f"_vg_{n}"] = _c(c)
        inputs[f"_sg_{n}"] = F.coalesce(_c(st).cast("boolean"), F.lit(False))
    for n, c in change_ids.items():
        inputs[f"_vc_{n}"] = _c(c)
    for n, c in before.items():
        inputs[f"_vb_{n}"] = _c(c)
    for n, c in leads.items():
        inputs[f"_vn_{n}"] = _c(c)
    if inputs:
        d = d.withColumns(inputs)

    wl = Window.partitionBy(*part).orderBy(*order)
    wlr = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def inside(d: DataFrame) -> DataFrame:
        """The windows inside each (key, chunk)."""
        local = {}
        for n in sums:
            local[f"_ls_{n}"] = F.sum(f"_vs_{n}").over(wlr)
        for n in runs:
            local[f"_lr_{n}"] = F.sum(f"_vr_{n}").over(wlr)
        for n in ffill:
            local[f"_lf_{n}"] = F.last(f"_vf_{n}", ignorenulls=True).over(wlr)
        for n, (_c0, k) in lags.items():
            local[f"_ll_{n}"] = F.lag(f"_vl_{n}", k).over(wl)
        for n in before:
            local[f"_lb_{n}"] = F.last(f"_vb_{n}", ignorenulls=True).over(wl.rowsBetween(Window.unboundedPreceding, -1))
            local[f"_li_{n}"] = F.last(f"_vb_{n}", ignorenulls=True).over(wlr)
        for n in leads:
            local[f"_ln_{n}"] = F.lead(f"_vn_{n}", 1).over(wl)
        if lags or leads:
            local["_cnt"] = F.count(F.lit(1)).over(Window.partitionBy(*part))
        d = d.withColumn("_rn", F.row_number().over(wl))
        if change_ids:  # whether a chunk's first row starts a run is only known with the chunk before it
            d = d.withColumns({f"_fc_{n}": F.when((F.col("_rn") > 1) & ~F.col(f"_vc_{n}").eqNullSafe(
                F.lag(f"_vc_{n}", 1).over(wl)), 1).otherwise(0) for n in change_ids})
        for n in change_ids:
            local[f"_lc_{n}"] = F.sum(f"_fc_{n}").over(wlr)
        for n in last_pos:
            local[f"_lp_{n}"] = F.last(F.when(F.col(f"_vp_{n}"), F.col("_rn")), ignorenulls=True).over(wlr)
        for n in lag_fills:
            local[f"_lg_{n}"] = F.lag(f"_vg_{n}", 1).over(wl)
            local[f"_fs_{n}"] = F.first(f"_sg_{n}").over(wlr)          # is the chunk's first row a start
        for n, (_c0, reset) in run_fills.items():
            local[f"_lq_{n}"] = F.sum(f"_vq_{n}").over(wlr)
            if reset:
                local[f"_v1_{n}"] = F.first(f"_vq_{n}").over(wlr)
        d = d.withColumns(local)
        if run_fills:
            # plain variant, and for reset_at_start a variant where the chunk's
            # first row counts as a zero (used only in the key's first chunk)
            rq = {}
            for n, (_c0, reset) in run_fills.items():
                v, lq = F.col(f"_vq_{n}"), F.col(f"_lq_{n}")
                rq[f"_lzq_{n}"] = F.last(F.when(v == 0, lq), ignorenulls=True).over(wlr)
                if reset:
                    lqf = lq - F.col(f"_v1_{n}")
                    rq[f"_lqf_{n}"] = lqf
                    rq[f"_lzqf_{n}"] = F.last(F.when((v == 0) | (F.col("_rn") == 1), lqf), ignorenulls=True).over(wlr)
            d = d.withColumns(rq)
            # at the last non-zero row so far: its local sum (a) and the local sum
            # at its last zero (b; -1 when the chunk had no zero before it)
            rs = {}
            for n, (_c0, reset) in run_fills.items():
                v = F.col(f"_vq_{n}")
                rs[f"_lsa_{n}"] = F.last(F.when(v != 0, F.col(f"_lq_{n}")), ignorenulls=True).over(wlr)
                rs[f"_lsb_{n}"] = F.last(F.when(v != 0, F.coalesce(F.col(f"_lzq_{n}"), F.lit(-1))),
                                         ignorenulls=True).over(wlr)
                if reset:
                    hit = (v != 0) & (F.col("_rn") != 1)
                    rs[f"_lsaf_{n}"] = F.last(F.when(hit, F.col(f"_lqf_{n}")), ignorenulls=True).over(wlr)
                    rs[f"_lsbf_{n}"] = F.last(F.when(hit, F.col(f"_lzqf_{n}")), ignorenulls=True).over(wlr)
            d = d.withColumns(rs)
        if lag_fills:
            # value before the latest start row inside the chunk (first row excluded), filled
            d = d.withColumns({f"_lgf_{n}": F.last(F.when(F.col(f"_sg_{n}") & (F.col("_rn") > 1), F.col(f"_lg_{n}")),
                                                   ignorenulls=True).over(wlr) for n in lag_fills})
        if runs:
            # local sum at the last zero at or before the row (within the chunk)
            d = d.withColumns({
                f"_lz_{n}": F.last(F.when(F.col(f"_vr_{n}") == 0, F.col(f"_lr_{n}")), ignorenulls=True).over(wlr)
                for n in runs})
        return d

    def summary(d: DataFrame) -> DataFrame:
        """One row per (key, chunk): what lies before it (and for ``leads`` behind it)."""
        aggs = [F.count(F.lit(1)).alias("_n")]
        for n in sums:
            aggs.append(F.sum(f"_vs_{n}").alias(f"_t_{n}"))
        for n in runs:
            aggs.append(F.sum(f"_vr_{n}").alias(f"_tr_{n}"))
            aggs.append(F.max_by(f"_lz_{n}", "_rn").alias(f"_ze_{n}"))
        for n in ffill:
            aggs.append(F.max_by(f"_lf_{n}", "_rn").alias(f"_fe_{n}"))
        for n, (_c0, k) in lags.items():
            tail = F.collect_list(F.when(F.col("_rn") > F.col("_cnt") - k,
                                         F.struct(F.col("_rn").alias("rn"), F.col(f"_vl_{n}").alias("v"))))
            aggs.append(F.transform(F.array_sort(tail), lambda s: s["v"]).alias(f"_te_{n}"))
        for n in change_ids:
            aggs.append(F.sum(f"_fc_{n}").alias(f"_tc_{n}"))
            aggs.append(F.max_by(F.struct(f"_vc_{n}"), "_rn").alias(f"_clast_{n}"))
            aggs.append(F.min_by(F.struct(f"_vc_{n}"), "_rn").alias(f"_cfirst_{n}"))
        for n in last_pos:
            aggs.append(F.max(F.when(F.col(f"_vp_{n}"), F.col("_rn"))).alias(f"_pm_{n}"))
        for n in lag_fills:
            aggs.append(F.max_by(f"_lgf_{n}", "_rn").alias(f"_gend_{n}"))
            aggs.append(F.max_by(f"_vg_{n}", "_rn").alias(f"_glast_{n}"))
            aggs.append(F.min_by(f"_sg_{n}", "_rn").alias(f"_gfs_{n}"))
        for n, (_c0, reset) in run_fills.items():
            aggs.append(F.sum(f"_vq_{n}").alias(f"_tq_{n}"))
            aggs.append(F.max_by(f"_lzq_{n}", "_rn").alias(f"_zeq_{n}"))
            aggs.append(F.max_by(f"_lsa_{n}", "_rn").alias(f"_sea_{n}"))
            aggs.append(F.max_by(f"_lsb_{n}", "_rn").alias(f"_seb_{n}"))
            if reset:
                aggs.append((F.sum(f"_vq_{n}") - F.min_by(f"_vq_{n}", "_rn")).alias(f"_tqf_{n}"))
                aggs.append(F.max_by(f"_lzqf_{n}", "_rn").alias(f"_zeqf_{n}"))
                aggs.append(F.max_by(f"_lsaf_{n}", "_rn").alias(f"_seaf_{n}"))
                aggs.append(F.max_by(f"_lsbf_{n}", "_rn").alias(f"_sebf_{n}"))
        for n in before:
            aggs.append(F.max_by(f"_li_{n}", "_rn").alias(f"_be_{n}"))
        for n in leads:
            aggs.append(F.min_by(F.struct(f"_vn_{n}"), "_rn").alias(f"_nf_{n}"))
        s = inside(d).groupBy(*part).agg(*aggs)

        wc = Window.partitionBy(*keys).orderBy(layout.chunk)
        wcp = wc.rowsBetween(Window.unboundedPreceding, -1)
        carry = {"_cn": F.coalesce(F.sum("_n").over(wcp), F.lit(0))}
        for n in sums:
            carry[f"_cs_{n}"] = F.coalesce(F.sum(f"_t_{n}").over(wcp), F.lit(0))
        for n in runs:
            carry[f"_crs_{n}"] = F.coalesce(F.sum(f"_tr_{n}").over(wcp), F.lit(0))
        for n in ffill:
            carry[f"_cf_{n}"] = F.last(f"_fe_{n}", ignorenulls=True).over(wcp)
        for n, (_c0, k) in lags.items():
            carry[f"_cl_{n}"] = F.flatten(F.collect_list(f"_te_{n}").over(wc.rowsBetween(-k, -1)))
        for n in last_pos:
            carry[f"_cp_{n}"] = F.last(F.col("_cn_self") + F.col(f"_pm_{n}"), ignorenulls=True).over(wcp)
        for n in before:
            carry[f"_cb_{n}"] = F.last(f"_be_{n}", ignorenulls=True).over(wcp)
        for n in leads:
            carry[f"_cx_{n}"] = F.lead(f"_nf_{n}", 1).over(wc)
        if last_pos:
            s = s.withColumn("_cn_self", F.coalesce(F.sum("_n").over(wcp), F.lit(0)))
        s = s.withColumns(carry)
        if runs:
            # global running sum at the chunk's last zero, then carried forward
            s = s.withColumns({f"_zg_{n}": F.col(f"_crs_{n}") + F.col(f"_ze_{n}") for n in runs})
            s = s.withColumns({f"_cz_{n}": F.coalesce(F.last(f"_zg_{n}", ignorenulls=True).over(wcp), F.lit(0))
                               for n in runs})
        if run_fills:
            first_chunk = F.col("_cn") == 0
            eff = {}
            for n, (_c0, reset) in run_fills.items():
                for k in ("tq", "zeq", "sea", "seb"):
                    eff[f"_e{k}_{n}"] = F.when(first_chunk, F.col(f"_{k}f_{n}")).otherwise(F.col(f"_{k}_{n}")) \
                        if reset else F.col(f"_{k}_{n}")
            s = s.withColumns(eff)
            s = s.withColumns({f"_cqs_{n}": F.coalesce(F.sum(f"_etq_{n}").over(wcp), F.lit(0)) for n in run_fills})
            s = s.withColumns({f"_zgq_{n}": F.col(f"_cqs_{n}") + F.col(f"_ezeq_{n}") for n in run_fills})
            s = s.withColumns({f"_cqz_{n}": F.coalesce(F.last(f"_zgq_{n}", ignorenulls=True).over(wcp), F.lit(0))
                               for n in run_fills})
            # run length at the chunk start, and the filled value at the chunk end
            s = s.withColumns({f"_cqr_{n}": F.col(f"_cqs_{n}") - F.col(f"_cqz_{n}") for n in run_fills})
            s = s.withColumns({f"_qend_{n}": F.when(F.col(f"_esea_{n}").isNotNull(), F.when(
                F.col(f"_eseb_{n}") < 0, F.col(f"_esea_{n}") + F.col(f"_cqr_{n}")).otherwise(
                F.col(f"_esea_{n}") - F.col(f"_eseb_{n}"))) for n in run_fills})
            s = s.withColumns({f"_cqf_{n}": F.last(f"_qend_{n}", ignorenulls=True).over(wcp) for n in run_fills})
        if change_ids:
            s = s.withColumns({f"_cf0_{n}": F.when((F.col("_cn") > 0) & F.col(f"_cfirst_{n}").eqNullSafe(
                F.lag(f"_clast_{n}", 1).over(wc)), 0).otherwise(1) for n in change_ids})
            s = s.withColumns({f"_cc_{n}": F.col(f"_cf0_{n}") + F.coalesce(
                F.sum(F.col(f"_cf0_{n}") + F.col(f"_tc_{n}")).over(wcp), F.lit(0)) for n in change_ids})
        if lag_fills:
            s = s.withColumns({f"_gpl_{n}": F.lag(f"_glast_{n}", 1).over(wc) for n in lag_fills})
            s = s.withColumns({f"_gown_{n}": F.coalesce(F.col(f"_gend_{n}"), F.when(F.col(f"_gfs_{n}"), F.col(f"_gpl_{n}")))
                               for n in lag_fills})
            s = s.withColumns({f"_cgf_{n}": F.last(f"_gown_{n}", ignorenulls=True).over(wcp) for n in lag_fills})
        keep = part + [c for c in s.columns if c.startswith(("_cn", "_cs_", "_crs_", "_cf_", "_cl_", "_cz_", "_cqr_", "_cqf_",
                                                              "_gpl_", "_cgf_", "_cp_", "_cc_", "_cb_", "_cx_"))]
        return s.select(*keep)

    j = inside(d)
    if layout.several is not None:
        # as many rows as bounds and hot keys; stored, so that a chain of scans doesn't repeat its plan for each summary
        j = j.join(write_once(summary(d.where(layout.several)), "scan-summary"), on=part, how="left")

    def carried(name: str, start=None) -> Column:
        """A summary's value; ``start`` for keys in one chunk, which have none."""
        if layout.several is None:
            return F.lit(start)
        return F.col(name) if start is None else F.coalesce(F.col(name), F.lit(start))

    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()
    outs = {}
    for n in sums:
        outs[n] = carried(f"_cs_{n}", 0) + F.col(f"_ls_{n}")
    for n in runs:
        total = carried(f"_crs_{n}", 0) + F.col(f"_lr_{n}")
        at_zero = F.coalesce(carried(f"_crs_{n}", 0) + F.col(f"_lz_{n}"), carried(f"_cz_{n}", 0))
        outs[n] = total - at_zero
    for n in ffill:
        outs[n] = F.coalesce(F.col(f"_lf_{n}"), carried(f"_cf_{n}"))
    for n, (_c0, k) in lags.items():
        outs[n] = F.col(f"_ll_{n}")
        if layout.several is not None:
            outs[n] = F.when(F.col("_rn") > k, outs[n]).otherwise(
                F.try_element_at(F.col(f"_cl_{n}"), -(F.lit(k) - F.col("_rn") + 1)))
    for n, (_c0, reset) in run_fills.items():
        if reset:
            la = F.when(carried("_cn", 0) == 0, F.col(f"_lsaf_{n}")).otherwise(F.col(f"_lsa_{n}"))
            lb = F.when(carried("_cn", 0) == 0, F.col(f"_lsbf_{n}")).otherwise(F.col(f"_lsb_{n}"))
        else:
            la, lb = F.col(f"_lsa_{n}"), F.col(f"_lsb_{n}")
        outs[n] = F.when(la.isNotNull(), F.when(lb < 0, la + carried(f"_cqr_{n}", 0)).otherwise(la - lb)).otherwise(
            carried(f"_cqf_{n}"))
    for n in lag_fills:
        outs[n] = F.coalesce(F.col(f"_lgf_{n}"), F.when(F.col(f"_fs_{n}"), carried(f"_gpl_{n}")),
                             carried(f"_cgf_{n}"))
    for n in last_pos:
        outs[n] = F.coalesce(carried("_cn", 0) + F.col(f"_lp_{n}"), carried(f"_cp_{n}"))
    for n in change_ids:
        outs[n] = carried(f"_cc_{n}", 1) + F.col(f"_lc_{n}")
    for n in before:
        outs[n] = F.coalesce(F.col(f"_lb_{n}"), carried(f"_cb_{n}"))
    for n in leads:
        outs[n] = F.col(f"_ln_{n}")
        if layout.several is not None:
            outs[n] = F.when(F.col("_rn") < F.col("_cnt"), outs[n]).otherwise(F.col(f"_cx_{n}")[f"_vn_{n}"])
    if row_number:
        outs[row_number] = carried("_cn", 0) + F.col("_rn")
    if keys:
        outs = {n: F.when(key_ok, c) for n, c in outs.items()}
    j = j.withColumns(outs)
    private = [c for c in j.columns if c.startswith("_") and c not in df.columns and c != CHUNK
               and c not in outs]
    j = j.drop(*private)
    if not keep_chunk and CHUNK not in df.columns:
        j = j.drop(CHUNK)
    return j
