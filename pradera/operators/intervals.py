"""Dense daily series computed on the facts (R3 J10 J11 with W1-W7, W11).

A key x day grid has a row for each fact of a key-day and one for each day without a fact.  Whatever the ordered
operators say about such an empty day follows from the fact before it and from the day's position: fills stay, counters
of rows grow by one a day.  So only the facts are scanned, each with the number of empty days behind it (a fact is the
interval up to the next one), and the days are made in the last projection.  The grid is never joined, shuffled,
sorted or written: what is moved grows with facts and keys.

A key's first row stands on the day before the calendar, without a fact, so that the days before its first fact, and all
days of a key without facts, lie behind a row as well.  A row's position in the grid is its number of days since the
calendar's start, and one more for every fact that isn't the first of its day.

Rows of a null key have null positions, fills and counters, as in ``ordered_scan``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import date_bounds
from .scan import Layout, lay_out, ordered_scan


class Facts(NamedTuple):
    """Facts in their layout: the rows, their key, the grid's key columns and the facts' own, the day's name, and the order.

    Private columns of the rows: ``_pos`` (in the grid, from 1), ``_gap`` (empty days behind), ``_real`` (no first row),
    ``_near`` (the row before is the grid's row before, too) and ``_prev`` (activity of that row)."""

    rows: DataFrame
    keys: list[str]
    about: list[str]
    cols: list[str]
    date: str
    order: list[Column]
    layout: Layout

    def scan(self, **outputs) -> Facts:
        """Adds outputs of ``ordered_scan``, on the layout that the rows have."""
        return self._replace(rows=ordered_scan(self.rows, self.keys, self.order, self.layout, **outputs))

    def with_columns(self, cols: Mapping[str, Column]) -> Facts:
        return self._replace(rows=self.rows.withColumns(dict(cols)))


def fact_days(keys: DataFrame, key_cols: Sequence[str], facts: DataFrame, fact_keys: Sequence[str], fact_date: Column | str,
              order: Sequence[str] = (), *, activity: str | None = None, bounds_from: DataFrame | None = None,
              start: str | None = None, name: str = "date", scan_keys: Sequence[str] = ()) -> Facts:
    """The facts of ``keys``, days numbered from the first to the last of the data (``start``, ``yyyyMMdd``, cuts them).

    ``fact_keys`` are the facts' names of the first ``key_cols``; ``scan_keys``: those that make up the key, if not all.
    ``order``: what orders the facts of one key-day (ascending, nulls first).  Facts of unknown keys and without a day
    aren't in the grid; several facts of a key-day all are."""
    day = F.to_date(F.col(fact_date) if isinstance(fact_date, str) else fact_date)
    lo, hi = date_bounds(bounds_from if bounds_from is not None else facts, fact_date)
    if start is not None and start != "no":
        lo = F.greatest(lo, F.to_date(F.lit(start), "yyyyMMdd"))
    keys, key_cols, log = keys.select(*key_cols).distinct(), list(key_cols), facts
    f = facts.withColumn("_day", day).withColumns({f"_fk{i}": F.col(k) for i, k in enumerate(fact_keys)})
    f = f.drop(*[k for k in fact_keys if k in key_cols])
    cols = [c for c in f.columns if c not in ("_day", name) and not c.startswith("_fk")]
    f = f.select("_day", *[f"_fk{i}" for i in range(len(fact_keys))], *cols).where(F.col("_day").between(lo, hi))
    real = keys.join(f, [F.col(k) == F.col(f"_fk{i}") for i, k in enumerate(key_cols[:len(fact_keys)])])
    real = real.select(*key_cols, F.col("_day").alias(name), *cols, F.lit(True).alias("_real"))
    first = keys.select(*key_cols, F.date_sub(lo, 1).alias(name), F.lit(False).alias("_real")).where(lo <= hi)
    by = [F.col(name), *[F.col(c) for c in order]]
    own = list(scan_keys) or key_cols
    rows, layout = lay_out(real.unionByName(first, allowMissingColumns=True), own, by, counted=(log, fact_keys))
    out = Facts(rows, own, key_cols, cols, name, by, layout)
    lags = {"_last": (name, 1)} | ({"_prev": (activity, 1)} if activity else {})
    out = out.scan(row_number="_rn", change_ids={"_dn": name}, leads={"_next": name}, lags=lags)
    near = F.datediff(F.col(name), F.col("_last")) <= 1
    out = out.with_columns({
        "_pos": F.datediff(F.col(name), lo) + 1 + F.col("_rn") - F.col("_dn"),
        "_gap": F.greatest(F.datediff(F.coalesce("_next", F.date_add(hi, 1)), F.col(name)) - 1, F.lit(0)),
        "_near": F.coalesce(near, F.lit(False))} | ({"_prev": F.when(near, F.col("_prev"))} if activity else {}))
    return out._replace(rows=out.rows.drop("_rn", "_dn", "_next", "_last"))


def days(facts: Facts, outputs: Mapping[str, Column]) -> DataFrame:
    """The grid: each fact and the empty days behind it, with ``outputs`` of ``_pos`` and the facts' columns.

    On an empty day the facts' own columns are null; columns that were added by scans are those of the fact before."""
    d = facts.rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_gap")))).where("_real OR _i > 0")
    d = d.withColumns({facts.date: F.date_add(F.col(facts.date), F.col("_i")), "_pos": F.col("_pos") + F.col("_i")}
                      | {c: F.when(F.col("_i") == 0, F.col(c)) for c in facts.cols} | {"_near": F.col("_near") & (F.col("_i") == 0)})
    return _finished(facts, d, outputs)


def fact_rows(facts: Facts, outputs: Mapping[str, Column], where: Column | None = None) -> tuple[DataFrame, Layout]:
    """The facts alone with the same ``outputs``, and the layout that they still have."""
    d = facts.rows.where("_real")
    if where is not None:
        d = d.where(where)
    keep = [facts.layout.chunk]
    return _finished(facts, d, outputs, keep), facts.layout


def _finished(facts: Facts, d: DataFrame, outputs: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in facts.cols if c not in outputs]
    return d.select(*facts.about, facts.date, *cols, *[c.alias(n) for n, c in outputs.items()], *keep)


def filled(facts: Facts, cols: Sequence[str]) -> DataFrame:
    """W6 over the grid: last non-null value of each column up to the day."""
    f = facts.scan(ffill={f"_ff_{c}": c for c in cols})
    return days(f, {c: F.col(f"_ff_{c}") for c in cols})


def _position(cond: Column) -> Column:
    return F.when(cond, F.col("_pos"))


def rows_since(facts: Facts, activity: str, names: Sequence[str], prefix: str = "dias_sin_", first: bool = True) -> DataFrame:
    """W5 over the grid: rows since the last one with each activity; ``first``: a key's first row counts as one, too.

    Without ``first`` it is W3: the run of rows since the last such row, or from the key's first one."""
    f = facts.scan(ffill={f"_p_{n}": _position(F.col(activity).eqNullSafe(F.lit(n))) for n in names})
    return days(f, {f"{prefix}{n.lower()}": F.col("_pos") - F.coalesce(F.col(f"_p_{n}"), F.lit(int(first))) for n in names})


def grazing(facts: Facts, *, activity: str, animals: str, grazing: str = "PASTOREO", fill: Sequence[str] = (),
            paddock_output: bool = True, since: Sequence[str] = (), since_prefix: str = "dias_sin_"
            ) -> tuple[Facts, dict[str, Column]]:
    """W2 W4 W6 W11 and trap T9 over the grid: the facts with their state, and the outputs to hand to ``days`` or
    ``fact_rows``.  The same columns as ``runs.grazing_state`` gives on a dense frame; ``facts`` were made with
    ``activity``."""
    g = F.col(activity).eqNullSafe(F.lit(grazing))
    begins = g & ~F.coalesce(F.col("_prev") == grazing, F.lit(False))
    f = facts.scan(
        ffill={"_grazed": _position(g), "_begun": _position(begins),
               "ultimo_pastoreo": F.when(g, F.col(facts.date)), "ultimo_animales": F.when(g, F.nullif(F.col(animals), F.lit(0)))}
        | {f"_ff_{c}": c for c in fill} | {f"_p_{n}": _position(F.col(activity).eqNullSafe(F.lit(n))) for n in since},
        before={"_grazed_before": _position(g)})
    f = f.scan(ffill={"_ended": F.when(begins, F.col("_grazed_before"))})  # the run before the present or last one
    # rests are counted from the key's first row, which is no rest, or from the last grazing row
    rest = F.when(g, F.col("_begun") - 1 - F.coalesce("_ended", F.lit(1))).otherwise(
        F.col("_pos") - F.coalesce("_grazed", F.lit(1)))
    rest = F.when(rest > 0, rest)
    out = {c: F.col(f"_ff_{c}") for c in fill}
    out |= {"ultimo_pastoreo": F.col("ultimo_pastoreo"), "ultimo_animales": F.col("ultimo_animales"),
            "dias_de_pastoreo": F.col("_grazed") - F.col("_begun") + 1,
            "dias_sin_pastoreo": F.when(g, F.lit(0)).otherwise(rest) if paddock_output else rest}
    out |= {f"{since_prefix}{n.lower()}": F.col("_pos") - F.coalesce(F.col(f"_p_{n}"), F.lit(1)) for n in since}
    out |= {"lote_change": F.col("_pos") == 1,
            "actividad_change": F.col("_near") & F.coalesce(F.col(activity) == F.col("_prev"), F.lit(False))}
    return f, out
