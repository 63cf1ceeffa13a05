"""Paddock and herd name codes (F1 F2 F3 F4 F22 F23), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


# fixed values: farm name -> paddock-name prefix
FARM_PREFIX = {
    "JUNCAL": "Juncalito-Lote_",
    "PARAISO": "Paraiso-Lote_",
    "LA ISLA": "La_Isla-Lote_",
    "MANGA LARGA": "La_Isla-Lote_ML_",
}


def _pad2(num: Column, text: Column, prefix: str) -> Column:
    return F.when(num < 10, F.concat(F.lit(prefix + "0"), text)).otherwise(F.concat(F.lit(prefix), text))


def paddock_code(farm: Column | str, paddock: Column | str) -> Column:
    """paddock code from (farm, paddock text).

    EL RECODO: ``RC`` + paddock, zero-padded when it is an integer below 10
    (``'07'`` gives ``RC007``); a non-number containing ``T`` swaps to
    last char + first char (``1T`` -> ``T1``); other text -> null.  JUNCAL,
    PARAISO, LA ISLA, MANGA LARGA: fixed prefixes.  RANCHO: ``RANCHO`` +
    zero-padded number (bad text raises, as a strict int cast).  Unknown farm -> null.
    """
    f, p = _c(farm), _c(paddock).cast("string")
    n = p.try_cast("int")
    rc = F.when(n.isNotNull(), _pad2(n, p, "RC")).when(
        p.contains("T"), F.concat(F.substring(p, -1, 1), F.substring(p, 1, 1)))
    out = F.when(f == "EL RECODO", rc)
    for name, prefix in FARM_PREFIX.items():
        out = out.when(f == name, F.concat(F.lit(prefix), p))
    strict = p.cast("int")
    return out.when(f == "RANCHO", _pad2(strict, p, "RANCHO"))


def pad_suffix(name: Column | str) -> Column:
    """``a_b`` / ``a_b_c`` with a one-character last part get it zero-padded;
    otherwise any name containing ``T9`` becomes ``T9``; else unchanged.  Null stays null."""
    x = _c(name)
    parts = F.split(x, "_")
    n = F.size(parts)
    last = F.element_at(parts, -1)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
             .when((n == 2) & (F.length(last) == 1),
                   F.concat(F.element_at(parts, 1), F.lit("_0"), last))
             .when((n == 3) & (F.length(last) == 1),
                   F.concat(F.element_at(parts, 1), F.lit("_"), F.element_at(parts, 2), F.lit("_0"), last))
             .when(x.contains("T9"), F.lit("T9"))
             .otherwise(x))


def herd_label(herd: Column | str, variable: Column | str) -> Column:
    """``herd_1/_2/_3`` for the lag variables, the herd itself otherwise."""
    h, v = _c(herd), _c(variable)
    return (F.when(v == "lag_1", F.concat(h, F.lit("_1")))
             .when(v == "lag_2", F.concat(h, F.lit("_2")))
             .when(v == "lag_3", F.concat(h, F.lit("_3")))
             .otherwise(h))


def prefer_base(base: Column | str, alt: Column | str) -> Column:
    """the base number, else the alternative parsed as an integer."""
    return F.coalesce(_c(base), _c(alt).cast("string").try_cast("int"))


def farm_prefix(farm: Column | str, sector_head: Column | str) -> Column:
    """RECODO -> ``RC``; ISLA -> by the sector's farm word (JUNCAL, PARAISO,
    MANGA LARGA) else ``La_Isla-Lote_``; other farms -> null."""
    f, s = _c(farm), _c(sector_head)
    isla = (F.when(s.contains("JUNCAL"), F.lit("Juncalito-Lote_"))
             .when(s.contains("PARAISO"), F.lit("Paraiso-Lote_"))
             .when(s.contains("MANGA LARGA"), F.lit("La_Isla-Lote_ML_"))
             .otherwise(F.lit("La_Isla-Lote_")))
    return F.when(f == "RECODO", F.lit("RC")).when(f == "ISLA", isla)


def prefixed_code(prefix: Column | str, number: Column | str) -> Column:
    """prefix + number, zero-padded below 10 unless the prefix holds ``ML_``."""
    p, n = _c(prefix), _c(number)
    txt = n.cast("long").cast("string")
    return F.when(n.isNull(), F.lit(None).cast("string")).when(
        (n < 10) & ~p.contains("ML_"), F.concat(p, F.lit("0"), txt)).otherwise(F.concat(p, txt))
