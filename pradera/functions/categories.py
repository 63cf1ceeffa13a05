"""Comment -> category rules (F14 F15 F16) and operator names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: calving comment tests, first match wins.
# (kind, pattern, category): "lit" = plain substring, "re" = regular expression (find anywhere)
CALVING_RULES = (
    ("lit", "M.MUERT", 4),
    ("re", "(?i)macho muer", 4),
    ("lit", "H.MUERT", 5),
    ("lit", "InterHerd", 1),
    ("re", "(?i)abor", 8),
    ("re", "(?i)pret", 6),
    ("re", "(?i)disto", 7),
    ("re", "(?i)geme", 10),
    ("re", "(?i)rete", 9),
    ("re", "(?i)lacto", 11),
    ("lit", "H", 2),
    ("re", "(?i)hembr", 2),
    ("re", "(?i)macho", 3),
    ("lit", "M", 3),
)
CALVING_DEFAULT = 1

# fixed values: service comment tests (insemination 12, bull 13, default 12)
SERVICE_RULES = (("re", "(?i)insemi", 12), ("re", "(?i)toro", 13))
SERVICE_DEFAULT = 12

# fixed values: older calving vocabulary (exact upper-case match) and its recode
CALVING_VOCAB = ("H", "M", "H.MUERT", "M.MUERT", "ABORTO", "PRETÉRMINO", "PRETERMINO", "DISTOCIA",
                 "GEMELOS", "RETENCIÓN", "RETENCION", "LACTOINDUCCIÓN", "LACTOINDUCCION")
CALVING_VOCAB_IDS = {"No definido": 1, "M": 3, "H": 2, "M.MUERT": 4, "H.MUERT": 5, "ABORTO": 8,
                     "PRETÉRMINO": 6, "LACTOINDUCCION": 11, "GEMELOS": 10, "PRETERMINO": 6}


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def first_match(text: Column | str, rules: Sequence[tuple[str, str, int]], default: int,
                null_value: int | None = None) -> Column:
    """Category of the first rule whose pattern occurs in ``text``; ``default`` when none.

    ``null_value`` is the category of a null text (None: the default).
    """
    t = _c(text)
    out = F.when(t.isNull(), F.lit(default if null_value is None else null_value))
    for kind, pat, cat in rules:
        hit = t.contains(pat) if kind == "lit" else t.rlike(pat)
        out = out.when(hit, F.lit(cat))
    return out.otherwise(F.lit(default))


def calving_category(text: Column | str, legacy: bool = False) -> Column:
    """F14 (T4): calving comment -> category.  A null comment gives 1 (no
    rule matched); ``legacy=True`` gives 4, as the original where a null
    test counts as true."""
    return first_match(text, CALVING_RULES, CALVING_DEFAULT, null_value=4 if legacy else None)


def service_category(text: Column | str) -> Column:
    """service comment -> 12 (insemination) / 13 (bull), default 12."""
    return first_match(text, SERVICE_RULES, SERVICE_DEFAULT)


def vocabulary_category(text: Column | str, legacy: bool = False) -> Column:
    """F16: upper-case comment if in the vocabulary else "No definido", then to an id.

    Words listed in the vocabulary without an id (DISTOCIA, RETENCIÓN, ...)
    make the original fail its int cast; here they give null unless
    ``legacy`` (then the strict cast raises)."""
    u = F.upper(_c(text))
    word = F.when(u.isin(*CALVING_VOCAB), u).otherwise(F.lit("No definido"))
    items = []
    for k, v in CALVING_VOCAB_IDS.items():
        items += [F.lit(k), F.lit(v)]
    m = F.try_element_at(F.create_map(*items), word)
    return word.cast("int") if legacy else m


def refine_category(current: Column | str, computed: Column) -> Column:
    """Apply a computed category only where the current one is the generic 1."""
    c = _c(current)
    return F.when(c == 1, computed).otherwise(c)


def name_to_id(name: Column | str, mapping: Mapping[str, int], default: int) -> Column:
    """person name -> id, ``default`` when not listed (or null)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*items), _c(name)), F.lit(default))
