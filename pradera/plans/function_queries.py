"""Scalar functions, filters and small aggregates on the shared tables.

Stand-in columns are built from whole tables (segment -> farm, nation key
-> paddock text, account balance -> percent text, ...); the function under
test is then applied to every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.categories import (CALVING_RULES, CALVING_VOCAB, CALVING_VOCAB_IDS, calving_category, service_category,
                                    vocabulary_category)
from ..functions.codes import farm_prefix, pad_suffix, paddock_code, prefer_base, prefixed_code
from ..functions.text import (blank_to_null, col_diff, day_diff, fill_all, fill_from, format_date, null_if, parse_date,
                              parse_numbers, percent_to_fraction, replace_value, safe_ratio, split_sector, upper, strict_int)
from ..operators.aggregate import bounds, distinct_values, null_counts, value_counts
from ..operators.calendar import calendar
from ..operators.reshape import explode_non_null
from ..operators.select import any_of, conform, drop_null, since_date, skip_first
from ..sources.sinks import patch_payload
from ..sources.tables import table

SQL = {}


def _t(spark, sf, name):
    return table(spark, sf, name)


# --------------------------------------------------------------------------- F1 F2
# fixed values of the stand-in: market segment -> farm name
SEGMENT_FARM = {"BUILDING": "EL RECODO", "AUTOMOBILE": "JUNCAL", "FURNITURE": "PARAISO",
                "HOUSEHOLD": "LA ISLA", "MACHINERY": "MANGA LARGA"}


def _farm_paddock(spark, sf):
    c = _t(spark, sf, "customer")
    farm = None
    for k, v in SEGMENT_FARM.items():
        farm = F.when(F.col("c_mktsegment") == k, v) if farm is None else farm.when(F.col("c_mktsegment") == k, v)
    nk = F.col("c_nationkey").cast("string")
    paddock = (F.when(F.col("c_nationkey") % 7 == 0, F.concat(nk, F.lit("T")))
                .when(F.col("c_nationkey") % 11 == 3, F.concat(F.lit("0"), nk)).otherwise(nk))
    return c.select("c_custkey", farm.alias("farm"), paddock.alias("paddock"))


SQL_FARM = """fp AS (SELECT c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'EL RECODO' WHEN 'AUTOMOBILE' THEN 'JUNCAL' WHEN 'FURNITURE' THEN 'PARAISO'
      WHEN 'HOUSEHOLD' THEN 'LA ISLA' WHEN 'MACHINERY' THEN 'MANGA LARGA' END AS farm,
    CASE WHEN c_nationkey % 7 = 0 THEN CAST(c_nationkey AS VARCHAR) || 'T'
         WHEN c_nationkey % 11 = 3 THEN '0' || CAST(c_nationkey AS VARCHAR)
         ELSE CAST(c_nationkey AS VARCHAR) END AS paddock FROM customer),
cb AS (SELECT c_custkey, farm, paddock,
    CASE farm
      WHEN 'EL RECODO' THEN CASE
        WHEN TRY_CAST(paddock AS INTEGER) IS NOT NULL THEN
          CASE WHEN TRY_CAST(paddock AS INTEGER) < 10 THEN 'RC0' || paddock ELSE 'RC' || paddock END
        WHEN contains(paddock, 'T') THEN right(paddock, 1) || left(paddock, 1) END
      WHEN 'JUNCAL' THEN 'Juncalito-Lote_' || paddock
      WHEN 'PARAISO' THEN 'Paraiso-Lote_' || paddock
      WHEN 'LA ISLA' THEN 'La_Isla-Lote_' || paddock
      WHEN 'MANGA LARGA' THEN 'La_Isla-Lote_ML_' || paddock END AS code
  FROM fp)"""


def q_code_build(spark, sf):
    d = _farm_paddock(spark, sf)
    return d.select("c_custkey", "farm", "paddock", paddock_code("farm", "paddock").alias("code"))


SQL["code_build"] = f"""WITH {SQL_FARM}
SELECT c_custkey, farm, paddock, code FROM cb"""


def q_code_pad(spark, sf):
    d = _farm_paddock(spark, sf).withColumn("code", paddock_code("farm", "paddock"))
    return d.select("c_custkey", "code", pad_suffix("code").alias("padded"))


SQL["code_pad"] = f"""WITH {SQL_FARM},
sp AS (SELECT c_custkey, code, string_split(code, '_') AS parts FROM cb)
SELECT c_custkey, code,
  CASE WHEN code IS NULL THEN NULL
       WHEN len(parts) = 2 AND length(parts[2]) = 1 THEN parts[1] || '_0' || parts[2]
       WHEN len(parts) = 3 AND length(parts[3]) = 1 THEN parts[1] || '_' || parts[2] || '_0' || parts[3]
       WHEN contains(code, 'T9') THEN 'T9' ELSE code END AS padded
FROM sp"""


# --------------------------------------------------------------------------- F7 F9 F10 F5 F24
def q_percent_parse(spark, sf):
    c = _t(spark, sf, "customer")
    txt = F.concat(F.round(F.col("c_acctbal") / 100, 0).cast("int").cast("string"), F.lit("%"))
    return c.select("c_custkey", txt.alias("gap_text"), F.round(percent_to_fraction(txt), 6).alias("gap"))


SQL["percent_parse"] = """SELECT c_custkey, CAST(CAST(round(c_acctbal / 100, 0) AS INTEGER) AS VARCHAR) || '%' AS gap_text,
  round(CAST(trim(CAST(CAST(round(c_acctbal / 100, 0) AS INTEGER) AS VARCHAR) || '%', '%') AS DOUBLE) / 100, 6) AS gap
FROM customer"""


def q_blank_to_null(spark, sf):
    c = _t(spark, sf, "customer")
    seg = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("   "))
            .when(F.col("c_mktsegment") == "FURNITURE", F.lit("")).otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", blank_to_null(seg).alias("segment"))


SQL["blank_to_null"] = """SELECT c_custkey,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN NULL ELSE c_mktsegment END AS segment FROM customer"""


def q_date_coerce(spark, sf):
    o = _t(spark, sf, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.lit("no date")).otherwise(format_date("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", format_date(parse_date(txt, "dd/MM/yyyy"), "yyyy-MM-dd").alias("fecha"))


SQL["date_coerce"] = """SELECT o_orderkey,
  strftime(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'no date' ELSE strftime(o_orderdate, '%d/%m/%Y') END,
    '%d/%m/%Y'), '%Y-%m-%d') AS fecha
FROM orders"""


def q_sentinel(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey",
                    null_if(F.col("p_size") % 10, 0).cast("int").alias("size_nz"),
                    replace_value(F.col("p_size") % 10, 0, 1).cast("int").alias("size_one"),
                    replace_value(F.col("p_size") - 101, -100, 0).cast("int").alias("breed"),
                    null_if(F.col("p_brand"), "Brand#1").alias("brand"))


SQL["sentinel"] = """SELECT p_partkey, CAST(nullif(p_size % 10, 0) AS INTEGER) AS size_nz,
  CAST(CASE WHEN p_size % 10 = 0 THEN 1 ELSE p_size % 10 END AS INTEGER) AS size_one,
  CAST(CASE WHEN p_size - 101 = -100 THEN 0 ELSE p_size - 101 END AS INTEGER) AS breed,
  nullif(p_brand, 'Brand#1') AS brand
FROM part"""


def q_safe_ratio(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    n = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = o.join(n, o["o_orderkey"] == n["l_orderkey"], "left")
    return j.select("o_orderkey", safe_ratio("o_totalprice", F.coalesce(F.col("n"), F.lit(0))).alias("ratio"))


SQL["safe_ratio"] = """SELECT o_orderkey, o_totalprice / nullif(coalesce(n, 0), 0) AS ratio
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""


# --------------------------------------------------------------------------- F14 F15 F16 T4
# fixed values of the stand-in: words put before a text, so that each rule and its place in the order is hit
COMMENT_WORDS = ("M.MUERT ", "Macho muerto ", "H.MUERT ", "InterHerd ", "aborto ", "PRETERMINO ", "distocia ", "Gemelos ",
                 "retencion ", "LactoInduccion ", "H ", "hembra ", "macho ", "M ", "H.MUERT M.MUERT ", "gemelos aborto ",
                 "", "insemino el toro ", "Toro ", "h ")


def _comments(spark, sf):
    """Every text is a comment, some with a word in front; one in 29 is null."""
    d = _t(spark, sf, "documents")
    word = F.element_at(F.array(*[F.lit(w) for w in COMMENT_WORDS]), (F.col("doc_id") % len(COMMENT_WORDS) + 1).cast("int"))
    # lower case, so that the one-letter rules are decided by the word in front
    comment = F.concat(word, F.lower("text"))
    return d.select("doc_id", F.when(F.col("doc_id") % 29 != 0, comment).alias("comment"))


SQL_COMMENT = f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 29 <> 0 THEN {list(COMMENT_WORDS)}[doc_id % {len(COMMENT_WORDS)} + 1]
  || lower(text) END AS comment FROM documents)"""


def _sql_calving(null_value):
    whens = " ".join(
        f"WHEN {'contains(comment, ' if k == 'lit' else 'regexp_matches(comment, '}'{p}') THEN {c}" for k, p, c in CALVING_RULES)
    return f"CASE WHEN comment IS NULL THEN {null_value} {whens} ELSE 1 END"


def q_comment_category(spark, sf):
    return _comments(spark, sf).select("doc_id", calving_category("comment").cast("int").alias("category"))


SQL["comment_category"] = f"""{SQL_COMMENT}
SELECT doc_id, CAST({_sql_calving(1)} AS INTEGER) AS category FROM d"""


def q_comment_category_legacy(spark, sf):
    return _comments(spark, sf).select("doc_id", calving_category("comment", legacy=True).cast("int").alias("category"))


SQL["comment_category_legacy"] = f"""{SQL_COMMENT}
SELECT doc_id, CAST({_sql_calving(4)} AS INTEGER) AS category FROM d"""


def q_service_category(spark, sf):
    return _comments(spark, sf).select("doc_id", service_category("comment").cast("int").alias("category"))


SQL["service_category"] = f"""{SQL_COMMENT}
SELECT doc_id, CAST(CASE WHEN regexp_matches(comment, '(?i)insemi') THEN 12 WHEN regexp_matches(comment, '(?i)toro') THEN 13
  ELSE 12 END AS INTEGER) AS category FROM d"""


# fixed values of the stand-in: order comments, the vocabulary in any case, words outside it and no comment
VOCAB_COMMENTS = ("h", "M", "H.Muert", "m.muert", "Aborto", "pretérmino", "PRETERMINO", "Distocia", "gemelos", "Retención",
                  "RETENCION", "lactoinducción", "LactoInduccion", "parto", "", None)


def q_vocab_match(spark, sf):
    o = _t(spark, sf, "orders")
    word = F.element_at(F.array(*[F.lit(w) for w in VOCAB_COMMENTS]), (F.col("o_orderkey") % len(VOCAB_COMMENTS) + 1).cast("int"))
    return o.select("o_orderkey", word.alias("comment"), vocabulary_category(word).cast("int").alias("category"))


_VOCAB = "[" + ", ".join("NULL" if w is None else f"'{w}'" for w in VOCAB_COMMENTS) + "]"
_VOCAB_IDS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CALVING_VOCAB_IDS.items())
_VOCAB_LIST = ", ".join(f"'{w}'" for w in CALVING_VOCAB)
SQL["vocab_match"] = f"""WITH o AS (SELECT o_orderkey, {_VOCAB}[o_orderkey % {len(VOCAB_COMMENTS)} + 1] AS comment FROM orders)
SELECT o_orderkey, comment, CAST(CASE CASE WHEN upper(comment) IN ({_VOCAB_LIST}) THEN upper(comment) ELSE 'No definido' END
  {_VOCAB_IDS} END AS INTEGER) AS category FROM o"""


# --------------------------------------------------------------------------- F20 F21 F4 F22 F23 R2
# fixed values of the stand-in: sector head words
SECTOR_WORDS = ("LOTE", "JUNCAL", "PARAISO", "MANGA LARGA")


def _sectors(spark, sf):
    p = _t(spark, sf, "part")
    word = F.element_at(F.array(*[F.lit(w) for w in SECTOR_WORDS]), (F.col("p_size") % 4 + 1).cast("int"))
    sector = F.concat(word, F.lit(" "), (F.col("p_size") % 9 + 1).cast("string"), F.lit(","),
                      (F.col("p_size") % 13 + 2).cast("string"), F.lit(":"),
                      (F.col("p_partkey") % 7).cast("string"), F.lit(",x,"), (F.col("p_size") % 5 + 8).cast("string"))
    farm = F.when(F.col("p_size") % 2 == 0, F.lit("RECODO")).otherwise(F.lit("ISLA"))
    return p.select("p_partkey", farm.alias("farm"), sector.alias("sector"))


def q_split_explode(spark, sf):
    s = _sectors(spark, sf).withColumn("_sp", split_sector("sector"))
    nums = F.zip_with(parse_numbers("_sp.after"), parse_numbers("_sp.numbers"), lambda a, b: F.coalesce(a, b))
    s = s.withColumns({"_prefix": farm_prefix("farm", "_sp.head"), "_nums": nums})
    codes = F.transform("_nums", lambda n: prefixed_code(F.col("_prefix"), n))
    return explode_non_null(s, ["p_partkey"], codes, "name_c")


SQL["split_explode"] = """WITH s AS (SELECT p_partkey,
    CASE WHEN p_size % 2 = 0 THEN 'RECODO' ELSE 'ISLA' END AS farm,
    ['LOTE', 'JUNCAL', 'PARAISO', 'MANGA LARGA'][p_size % 4 + 1] || ' ' || CAST(p_size % 9 + 1 AS VARCHAR) || ','
      || CAST(p_size % 13 + 2 AS VARCHAR) || ':' || CAST(p_partkey % 7 AS VARCHAR) || ',x,' || CAST(p_size % 5 + 8 AS VARCHAR) AS sector
  FROM part),
h AS (SELECT *, split_part(sector, ':', 1) AS head,
    CASE WHEN instr(sector, ':') > 0 THEN substr(sector, instr(sector, ':') + 1) END AS tail FROM s),
n AS (SELECT *, string_split(tail, ',') AS a,
    CASE WHEN instr(head, ' ') > 0 THEN string_split(substr(head, instr(head, ' ') + 1), ',') END AS b,
    CASE WHEN farm = 'RECODO' THEN 'RC' WHEN farm = 'ISLA' THEN
      CASE WHEN contains(head, 'JUNCAL') THEN 'Juncalito-Lote_' WHEN contains(head, 'PARAISO') THEN 'Paraiso-Lote_'
           WHEN contains(head, 'MANGA LARGA') THEN 'La_Isla-Lote_ML_' ELSE 'La_Isla-Lote_' END END AS prefix
  FROM h),
u AS (SELECT p_partkey, prefix, a, b, unnest(range(1, greatest(coalesce(len(a), 0), coalesce(len(b), 0)) + 1)) AS i FROM n),
v AS (SELECT p_partkey, prefix,
    coalesce(TRY_CAST(trim(a[i]) AS INTEGER), TRY_CAST(trim(b[i]) AS INTEGER)) AS num FROM u)
SELECT p_partkey, CASE WHEN num < 10 AND NOT contains(prefix, 'ML_') THEN prefix || '0' || CAST(num AS VARCHAR)
  ELSE prefix || CAST(num AS VARCHAR) END AS name_c
FROM v WHERE num IS NOT NULL AND prefix IS NOT NULL"""


# --------------------------------------------------------------------------- K5
def q_patch_payload(spark, sf):
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID_LOTE"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("ID_variedad"))
    return patch_payload(c, ["ID_LOTE", "ID_variedad"]).select("ID_LOTE", "payload")


SQL["patch_payload"] = """SELECT c_custkey AS ID_LOTE,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '{"ID_LOTE":' || CAST(c_custkey AS VARCHAR) || '}'
       ELSE '{"ID_LOTE":' || CAST(c_custkey AS VARCHAR) || ',"ID_variedad":"' || c_mktsegment || '"}' END AS payload
FROM customer"""


# --------------------------------------------------------------------------- P1-P5 P10 P11 P14 A6 A7 A8 O1 O2
TARGET = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_phone", T.StringType()), T.StructField("c_acctbal", T.DoubleType()),
])


def q_conform_schema(spark, sf):
    return conform(_t(spark, sf, "customer"), TARGET)


SQL["conform_schema"] = "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer"


def q_profile_counts(spark, sf):
    return value_counts(_t(spark, sf, "customer"), "c_mktsegment")


SQL["profile_counts"] = "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1"


def q_null_profile(spark, sf):
    o = _t(spark, sf, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
                                       F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return null_counts(o).select(F.col("prio").cast("bigint").alias("prio"), F.col("status").cast("bigint").alias("status"))


SQL["null_profile"] = """SELECT CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS prio,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS status FROM orders"""


def q_skip_first(spark, sf):
    """The landed order of ``orders`` is its key, so ``row_id = o_orderkey``."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("row_id"))
    return skip_first(o, "row_id").select("o_orderkey")


SQL["skip_first"] = "SELECT o_orderkey FROM orders WHERE o_orderkey > 0"


def q_top_clients(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey").orderBy("c_custkey").limit(1)


SQL["top_clients"] = "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 1"


def q_or_filter(spark, sf):
    s = _t(spark, sf, "supplier")
    return s.filter(any_of(F.col("s_nationkey") == 1, F.col("s_acctbal") < 0)).select("s_suppkey")


SQL["or_filter"] = "SELECT s_suppkey FROM supplier WHERE s_nationkey = 1 OR s_acctbal < 0"


def q_null_filter(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"))
    return drop_null(o, ["prio"])


SQL["null_filter"] = "SELECT o_orderkey, o_orderpriority AS prio FROM orders WHERE o_orderpriority <> '5-LOW'"


def q_distinct_values(spark, sf):
    return distinct_values(_t(spark, sf, "part"), "p_type")


SQL["distinct_values"] = "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL ORDER BY 1"


def q_bounds(spark, sf):
    b = bounds(_t(spark, sf, "orders"), "o_orderdate")
    return b.select(format_date("min_value", "yyyy-MM-dd").alias("min_value"),
                    format_date("max_value", "yyyy-MM-dd").alias("max_value"))


SQL["bounds"] = """SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS min_value, strftime(max(o_orderdate), '%Y-%m-%d') AS max_value
FROM orders"""


def q_select_reorder(spark, sf):
    """Select, rotate, rename, drop, constants."""
    from ..operators.select import rename, rename_all, rotate_last_first, select_positions, with_constants
    c = _t(spark, sf, "customer")
    d = select_positions(c, [0, 1, 4])
    d = rotate_last_first(d)
    d = rename_all(d, ["segment", "id", "name"])
    d = rename(d, {"name": "nombre"})
    d = with_constants(d, {"ID_OPERARIO": 35, "FechaSalida": (None, "date")}).drop("FechaSalida")
    return d


SQL["select_reorder"] = "SELECT c_mktsegment AS segment, c_custkey AS id, c_name AS nombre, 35 AS ID_OPERARIO FROM customer"


# --------------------------------------------------------------------------- F29 F30 F31
def q_day_diff(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber", day_diff("l_shipdate", "o_orderdate").alias("days"))


SQL["day_diff"] = """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def q_upper_text(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", upper("p_name").alias("name_upper"))


SQL["upper_text"] = "SELECT p_partkey, upper(p_name) AS name_upper FROM part"


def q_col_diff(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (col_diff("l_partkey", "l_suppkey")).alias("diff"))


SQL["col_diff"] = "SELECT l_orderkey, l_linenumber, l_partkey - l_suppkey AS diff FROM lineitem"


# --------------------------------------------------------------------------- F4 F18 F25 P13 R3
def q_prefer_base(spark, sf):
    """a paddock number, else the one in a text; some texts are no number, some numbers missing."""
    p = _t(spark, sf, "part")
    base = F.when(F.col("p_size") % 3 != 0, F.col("p_size"))
    alt = F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("p_partkey").cast("string"))
    return p.select("p_partkey", prefer_base(base, alt).alias("number"))


SQL["prefer_base"] = """SELECT p_partkey, coalesce(CASE WHEN p_size % 3 <> 0 THEN p_size END,
  TRY_CAST(CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE CAST(p_partkey AS VARCHAR) END AS INTEGER)) AS number FROM part"""


def q_strict_int(spark, sf):
    """the priority's leading digit as a number (another text would stop the query)."""
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", strict_int(F.substring("o_orderpriority", 1, 1)).alias("priority"))


SQL["strict_int"] = "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders"


def q_fill_values(spark, sf):
    """a missing segment from the name, missing balances by a constant."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
                                         F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    c = c.withColumn("segment", fill_from("segment", "c_name"))
    return fill_all(c, ["balance"], 0.0)


SQL["fill_values"] = """SELECT c_custkey, c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS segment,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS balance FROM customer"""


def q_since_date(spark, sf):
    """A start date, and none."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    late = since_date(o, "day", "19970101").withColumn("part", F.lit("since"))
    every = since_date(o, "day", "no").withColumn("part", F.lit("all"))
    return late.unionByName(every).select("part", "o_orderkey")


SQL["since_date"] = """SELECT 'since' AS part, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01'
UNION ALL SELECT 'all', o_orderkey FROM orders"""


def q_calendar_days(spark, sf):
    """Every day between the first and the last order."""
    return calendar(_t(spark, sf, "orders"), "o_orderdate", "day").select(format_date("day", "yyyy-MM-dd").alias("day"))


SQL["calendar_days"] = """SELECT strftime(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
  (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)), '%Y-%m-%d') AS day"""


QUERIES = {
    "prefer_base": q_prefer_base,
    "strict_int": q_strict_int,
    "fill_values": q_fill_values,
    "since_date": q_since_date,
    "calendar_days": q_calendar_days,
    "code_build": q_code_build,
    "code_pad": q_code_pad,
    "percent_parse": q_percent_parse,
    "blank_to_null": q_blank_to_null,
    "date_coerce": q_date_coerce,
    "sentinel": q_sentinel,
    "safe_ratio": q_safe_ratio,
    "comment_category": q_comment_category,
    "comment_category_legacy": q_comment_category_legacy,
    "service_category": q_service_category,
    "vocab_match": q_vocab_match,
    "split_explode": q_split_explode,
    "patch_payload": q_patch_payload,
    "conform_schema": q_conform_schema,
    "profile_counts": q_profile_counts,
    "null_profile": q_null_profile,
    "skip_first": q_skip_first,
    "top_clients": q_top_clients,
    "or_filter": q_or_filter,
    "null_filter": q_null_filter,
    "distinct_values": q_distinct_values,
    "bounds": q_bounds,
    "select_reorder": q_select_reorder,
    "day_diff": q_day_diff,
    "upper_text": q_upper_text,
    "col_diff": q_col_diff,
}
