"""Paddock tracking: change flags, grazing state, reset counters, forward
fill, previous-run values and movement paths (W1-W11).

Every ordered step goes through ``ordered_scan`` so a busy paddock or herd is
split along its rows instead of landing in one task.  Counters count rows, not
days (two activities on one day add two), as the original does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import Layout, ordered_scan


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def change_flags(df: DataFrame, key: Sequence[str], order, activity: str,
                 first_name: str = "lote_change", same_name: str = "actividad_change", legacy: bool = False) -> DataFrame:
    """W1 first row of the key; W2 ``activity == previous activity`` (null never equal).

    ``legacy`` (trap T7): the row before a key's first one is the last one of the key before."""
    if legacy:
        d = ordered_scan(df, [], [*key, *order], lags={"_prev_act": (activity, 1), **{f"_k{i}": (k, 1) for i, k in enumerate(key)}},
                         row_number="_pos")
        same = F.lit(True)
        for i, k in enumerate(key):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        return (d.withColumn(first_name, (F.col("_pos") == 1) | ~same)
                 .withColumn(same_name, F.coalesce(F.col(activity) == F.col("_prev_act"), F.lit(False)))
                 .drop("_prev_act", "_pos", *[f"_k{i}" for i in range(len(key))]))
    d = ordered_scan(df, key, order, lags={"_prev_act": (activity, 1)}, row_number="_pos")
    return (d.withColumn(first_name, F.col("_pos") == 1)
             .withColumn(same_name, F.coalesce(F.col(activity) == F.col("_prev_act"), F.lit(False)))
             .drop("_prev_act", "_pos"))


def since_last(df: DataFrame, key: Sequence[str], order, activity: str,
               names: Sequence[str], prefix: str = "dias_sin_") -> DataFrame:
    """Rows since the last row with each activity name; 0 on that row and on the key's first row.

    Equal to the run of ``flag = 0 if first row or activity == name else 1``
    (zeros kept, ``defa=1``), computed as the row's position minus the
    position of the last match (the first row counting as one); one scan
    serves all names.
    """
    d = ordered_scan(df, key, order, last_pos=_since_specs(activity, names), row_number="_pos")
    return d.withColumns(_since_outputs(names, prefix)).drop("_pos", *[f"_p_{n}" for n in names])


def _since_specs(activity: str, names: Sequence[str]):
    """``last_pos`` inputs: the position of the last row with each activity."""
    return {f"_p_{n}": F.col(activity).eqNullSafe(F.lit(n)) for n in names}


def _since_outputs(names: Sequence[str], prefix: str, pos: str = "_pos"):
    """Rows since the last match; the key's first row counts as a match (position 1)."""
    return {f"{prefix}{n.lower()}": F.col(pos) - F.coalesce(F.col(f"_p_{n}"), F.lit(1)) for n in names}


def grazing_state(df: DataFrame, key: Sequence[str], order, *, activity: str, date: str,
                  animals: str, grazing: str = "PASTOREO", fill: Sequence[str] = (),
                  paddock_output: bool = True, since: Sequence[str] = (), since_prefix: str = "dias_sin_") -> DataFrame:
    """W2 W3 W4 W6 W11 and trap T9, the full row-state chain.

    Adds lote_change, actividad_change, ultimo_pastoreo, ultimo_animales,
    dias_de_pastoreo, dias_sin_pastoreo.  Zeros of both counters become null
    and are forward filled with the columns in ``fill`` and the two
    ``ultimo_*`` columns, so a resting day shows the last grazing run length
    and a grazing day the last rest length; ``paddock_output`` then sets
    dias_sin_pastoreo to 0 on grazing rows (the herd output keeps it).
    ``since`` adds the W5 rows-since counters of those activities in the same scan.
    """
    g = F.col(activity).eqNullSafe(F.lit(grazing))
    d = df.withColumns({
        "_g": g,
        "_up": F.when(g, F.col(date)),
        "_ua": F.when(g, F.nullif(_c(animals), F.lit(0))),
    })
    ff = {f"_ff_{c}": c for c in fill}
    ff.update({"ultimo_pastoreo": "_up", "ultimo_animales": "_ua"})
    # One scan: both counters come out already zero->null and forward filled
    # (``run_fills``); the rest counter counts the key's first row as a reset.
    d = ordered_scan(
        d, key, order,
        run_fills={"dias_de_pastoreo": (F.when(F.col("_g"), 1).otherwise(0), False),
                   "dias_sin_pastoreo": (F.when(F.col("_g"), 0).otherwise(1), True)},
        ffill=ff, lags={"_prev_act": (activity, 1)}, row_number="_pos", last_pos=_since_specs(activity, since))
    d = d.withColumns(_since_outputs(since, since_prefix)).drop(*[f"_p_{n}" for n in since])
    d = d.withColumns({
        "lote_change": F.col("_pos") == 1,
        "actividad_change": F.coalesce(F.col(activity) == F.col("_prev_act"), F.lit(False)),
    })
    for c in fill:
        d = d.withColumn(c, F.col(f"_ff_{c}"))
    d = d.drop("_prev_act", "_pos", "_up", "_ua", *[f"_ff_{c}" for c in fill])
    if paddock_output:
        d = d.withColumn("dias_sin_pastoreo", F.when(F.col("_g"), F.lit(0)).otherwise(F.col("dias_sin_pastoreo")))
    return d.drop("_g")


def previous_run_values(df: DataFrame, key: Sequence[str], order, *, activity: str,
                        grazing: str = "PASTOREO", same: str = "actividad_change",
                        cols: Sequence[str] = ("ultimo_animales", "dias_de_pastoreo"),
                        prefix: str = "lag_", layout: Layout | None = None) -> DataFrame:
    """Grazing rows only; on the first row of each grazing run take the
    previous grazing row's values, then forward fill within the key.  With the ``layout`` of an earlier scan over the
    key the rows stay where they are."""
    gz = df.filter(F.col(activity).eqNullSafe(F.lit(grazing)))
    start = ~F.col(same)
    d = ordered_scan(gz, key, order, layout, lag_fills={f"{prefix}{c}": (c, start) for c in cols})
    return d.drop(layout.chunk) if layout else d


def movement_path(df: DataFrame, herd: Sequence[str], order, *, place: str, depth: int = 3,
                  prefix: str = "lag_", legacy: bool = False) -> DataFrame:
    """W8 + W9: per herd, keep change points (place differs from the previous
    row, first row included), take the 1..depth previous places over the
    change points and spread them forward to every herd row.

    One scan numbers the herd's stays (runs of one place) and fills the place forward; the place of k stays before
    comes from the small table of stays, joined on (herd, stay).  Rows without a herd get null places.

    ``legacy`` (trap T8): a herd's first row is a change point only if its place differs from the last one of the herd
    before; rows ahead of a herd's first change point have no previous places."""
    if legacy:
        d = ordered_scan(df, [], [*herd, *order], lags={"_last": (place, 1)}, row_number="_pos")
        moved = (F.col("_pos") == 1) | ~F.col(place).eqNullSafe(F.col("_last"))
        d = d.withColumn("_moved", moved.cast("int")).drop("_last", "_pos")
        d = ordered_scan(d, herd, order, sums={"_stay": "_moved"}, ffill={"_pf": F.when(F.col("_moved") == 1, F.col(place))})
        d = d.drop("_moved")
    else:
        d = ordered_scan(df, herd, order, change_ids={"_stay": place}, ffill={"_pf": place})
    stays = d.where(F.col("_stay") > 0).groupBy(*herd, "_stay").agg(F.max("_pf").alias("_v"))
    later = F.explode(F.array(*[F.struct((F.col("_stay") + k).alias("s"), F.lit(k).alias("k")) for k in range(1, depth + 1)]))
    back = stays.withColumn("_l", later).groupBy(*herd, F.col("_l.s").alias("_stay")).agg(
        *[F.max(F.when(F.col("_l.k") == k, F.col("_v"))).alias(f"{prefix}{k}") for k in range(1, depth + 1)])
    return d.join(back, [*herd, "_stay"], "left").drop("_stay", "_pf")


def run_sum_reset(df: DataFrame, key: Sequence[str], order, value: Column | str, name: str,
                  keep_zeros: bool = False, legacy: bool = False) -> DataFrame:
    """Sum of ``value`` since the last 0 (0 at a reset); zeros become null unless ``keep_zeros``.

    ``legacy`` (trap T7): a run goes on from a key's last row to the first row of the next key."""
    key, order = ([], [*key, *order]) if legacy else (key, order)
    d = ordered_scan(df, key, order, runs={name: value})
    return d if keep_zeros else d.withColumn(name, F.nullif(F.col(name), F.lit(0)))


def forward_fill(df: DataFrame, key: Sequence[str], order, cols: Sequence[str]) -> DataFrame:
    """Last non-null value per key in order, for the named columns only."""
    d = ordered_scan(df, key, order, ffill={f"_ff_{c}": c for c in cols})
    return d.withColumns({c: F.col(f"_ff_{c}") for c in cols}).drop(*[f"_ff_{c}" for c in cols])


def group_size(df: DataFrame, key: Sequence[str], name: str = "duplicados") -> DataFrame:
    """Rows per key on every row (``transform('size')``); null key -> null.

    Aggregated with a partial/final count and joined back (AQE splits a hot key)."""
    keyed = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
    counts = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, on=list(key), how="left")


def zero_on(df: DataFrame, col: str, activity: str, value: str = "PASTOREO") -> DataFrame:
    """Set ``col`` to 0 on rows with the given activity."""
    return df.withColumn(col, F.when(F.col(activity).eqNullSafe(F.lit(value)), F.lit(0)).otherwise(F.col(col)))
