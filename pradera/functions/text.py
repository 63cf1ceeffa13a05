"""Text, number and date helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(x):
    return F.col(x) if isinstance(x, str) else x


# ---- dates ------------------------------------------------------------------
def parse_date(col: Column | str, fmt: str, strict: bool = False) -> Column:
    """text -> timestamp with a format; null on failure, or raise when ``strict``."""
    c = _c(col).cast("string")
    return F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))


def format_date(col: Column | str, fmt: str) -> Column:
    """date/timestamp -> text (``MM/dd/yyyy``, ``yyyy-MM``, ``yyyy-MM-dd``)."""
    return F.date_format(_c(col), fmt)


def day_diff(end: Column | str, start: Column | str) -> Column:
    """whole days between two dates."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


# ---- strings ------------------------------------------------------------------
def percent_to_fraction(col: Column | str) -> Column:
    """``"85%"`` -> 0.85 (strip ``%`` at both ends, strict double cast)."""
    return F.btrim(_c(col).cast("string"), F.lit("%")).cast("double") / F.lit(100.0)


def strip(col: Column | str) -> Column:
    """F8: remove leading/trailing whitespace (any kind, as ``str.strip``)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def blank_to_null(col: Column | str) -> Column:
    """empty or all-blank text -> null."""
    c = _c(col)
    return F.when(c.rlike(r"^\s*$"), F.lit(None).cast("string")).otherwise(c)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """F9 on every string column."""
    return df.withColumns({f.name: blank_to_null(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, StringType)})


def null_if(col: Column | str, value) -> Column:
    """Sentinel -> null (0 -> null, '' -> null)."""
    return F.nullif(_c(col), F.lit(value))


def replace_value(col: Column | str, old, new) -> Column:
    """sentinel substitution (0 -> 1, -101 -> 0)."""
    c = _c(col)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def strict_int(col: Column | str) -> Column:
    """int cast that raises on bad text (ANSI)."""
    return _c(col).cast("int")


def composite_key(*cols: Column | str, sep: str = "_", null_propagates: bool = True) -> Column:
    """``a_b_c`` text key; null in any part gives null unless ``null_propagates=False``."""
    parts = [_c(c).cast("string") for c in cols]
    if null_propagates:
        out = parts[0]
        for p in parts[1:]:
            out = F.concat(out, F.lit(sep), p)
        return out
    return F.concat_ws(sep, *parts)


def split_sector(col: Column | str) -> Column:
    """``"LOTE 1,2:3,4"`` -> struct(head, after_colon, numbers_a, numbers_b):
    split once on ``:``, the head once on a space, then both parts on ``,``."""
    c = _c(col)
    first = F.split(c, ":", 2)
    head = F.element_at(first, 1)
    tail = F.try_element_at(first, F.lit(2))
    hsplit = F.split(head, " ", 2)
    empty = F.array().cast("array<string>")
    return F.struct(
        head.alias("head"),
        F.element_at(hsplit, 1).alias("word"),
        F.coalesce(F.split(tail, ","), empty).alias("after"),
        F.coalesce(F.split(F.try_element_at(hsplit, F.lit(2)), ","), empty).alias("numbers"),
    )


def parse_numbers(arr: Column | str) -> Column:
    """array of text -> array of ints, null where a token is not a number."""
    return F.transform(_c(arr), lambda x: strip(x).try_cast("int"))


def upper(col: Column | str) -> Column:
    """F30."""
    return F.upper(_c(col))


def col_diff(a: Column | str, b: Column | str) -> Column:
    """check column ``a - b``."""
    return _c(a) - _c(b)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """F24 (T14): ``num / den``; null for a zero or null denominator (pandas gives inf)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def fill_from(col: Column | str, other: Column | str) -> Column:
    """fill one column from another (or a literal Column)."""
    return F.coalesce(_c(col), _c(other))


def fill_all(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    """fill nulls with a literal."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})
