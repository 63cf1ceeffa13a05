"""Satellite bands (B20) and soil chemistry (B21) on landed inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import farm_prefix, prefixed_code
from ..functions.text import format_date, parse_date, parse_numbers, split_sector
from ..operators.aggregate import change_dates, completeness, nested_series
from ..operators.calendar import date_bounds, dense_grid
from ..operators.intervals import fact_days, filled
from ..operators.reshape import explode_non_null
from ..operators.select import keep_min_non_null
from ..sources.sinks import nested_documents


def band_series(data: DataFrame, bands: Sequence[str], start: str | None = "no"):
    """Returns (band-filtered rows, full grid, nested documents per paddock and month).

    ``data``: ``lote_id, name_c, band, date, mean_value``.  The grid is every
    (paddock, name, band) x day between the data bounds, left joined with the
    values; ``start`` (``yyyyMMdd`` or ``'no'``) drops earlier days."""
    keys = ["lote_id", "name_c", "band"]
    full = dense_grid(data, keys, data.withColumnRenamed("date", "_d"), keys, "_d", bounds_from=data.select(
        F.col("date").alias("_d")), name="date", start=start)
    full = full.drop("_d")
    filtered = full.filter(F.col("band").isin(*bands))
    g = full.withColumns({"ym": format_date("date", "yyyy-MM"), "day": format_date("date", "yyyy-MM-dd")})
    docs = nested_series(g, ["lote_id"], "ym", "band", ["date", "mean_value"], "mean_value", "day")
    return filtered, full, nested_documents(docs.withColumn("key", F.concat_ws("/", F.col("lote_id").cast("string"), "ym")), "key")


def soil_paddocks(props: DataFrame) -> DataFrame:
    """B21 front: one row per (property row, paddock code) from the SECTOR text."""
    sp = props.withColumn("_sp", split_sector("SECTOR"))
    nums = F.zip_with(parse_numbers("_sp.after"), parse_numbers("_sp.numbers"), lambda a, b: F.coalesce(a, b))
    sp = sp.withColumns({"_prefix": farm_prefix("FINCA", "_sp.head"), "_nums": nums})
    codes = F.transform("_nums", lambda n: prefixed_code(F.col("_prefix"), n))
    names = explode_non_null(sp, ["row_id"], codes, "name_c")
    return names.join(props, "row_id", "left")


def soil_chemistry(props: DataFrame, elements: Sequence[str], start: str, thresh: int = 10,
                   carry_in: bool = False):
    """Returns (filled per paddock-day, change dates, element names, calendar, per-paddock rows, completeness).

    ``carry_in=False`` cuts the calendar at ``start`` before the join, so a
    value dated earlier is not carried in (trap T13, the original's result)."""
    p = soil_paddocks(props).withColumn("date", F.to_date(parse_date("FECHA", "MM/dd/yyyy", strict=True)))
    lo, hi = date_bounds(p, "date")
    cal = p.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("date")).filter(
        F.col("date") >= F.to_date(F.lit(start), "yyyyMMdd"))
    names = p.select("name_c")
    facts = fact_days(names, ["name_c"], p.withColumnRenamed("date", "_d"), ["name_c"], "_d", ["row_id"],
                      start=None if carry_in else start)
    cols = [c for c in p.columns if c not in ("name_c", "date", "row_id")]
    done = filled(facts, cols).drop("_d")
    if carry_in:
        done = done.filter(F.col("date") >= F.to_date(F.lit(start), "yyyyMMdd"))
    done = done.drop("row_id", "FECHA")  # the date has taken FECHA's place: neither counts as a cell
    stats = completeness(done)
    kept = keep_min_non_null(done, thresh)
    changes = change_dates(props.select(F.to_date(parse_date("FECHA", "MM/dd/yyyy")).alias("FECHA")), "FECHA", start)
    return kept, changes, list(elements), cal, p, stats
