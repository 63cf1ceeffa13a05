"""Column functions with the traps of SURVEY 2.12."""

import pytest
from pyspark.sql import functions as F

from pradera.functions.categories import calving_category, service_category, vocabulary_category, name_to_id
from pradera.functions.codes import herd_label, pad_suffix, paddock_code, prefer_base, prefixed_code, farm_prefix
from pradera.functions.recode import recode, recode_with_fallback, shift_code
from pradera.functions.text import (blank_to_null, composite_key, parse_date, percent_to_fraction, safe_ratio,
                                    split_sector, strip)


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_paddock_code(spark):
    rows = [("EL RECODO", "9"), ("EL RECODO", "10"), ("EL RECODO", "07"), ("EL RECODO", "1T"), ("EL RECODO", "X"),
            ("JUNCAL", "3"), ("MANGA LARGA", "4"), ("RANCHO", "5"), ("OTRA", "1"), ("PARAISO", "T9")]
    got = one(spark, paddock_code("f", "p"), rows, "f string, p string")
    assert got == ["RC09", "RC10", "RC007", "T1", None, "Juncalito-Lote_3", "La_Isla-Lote_ML_4", "RANCHO05", None,
                   "Paraiso-Lote_T9"]


def test_rancho_bad_text_raises(spark):
    with pytest.raises(Exception):
        one(spark, paddock_code("f", "p"), [("RANCHO", "X")], "f string, p string")


def test_pad_suffix(spark):
    rows = [("Juncalito-Lote_3",), ("La_Isla-Lote_ML_4",), ("La_Isla-Lote_5",), ("a_b_12",), ("XT9Y",), ("RC09",), (None,)]
    got = one(spark, pad_suffix("x"), rows, "x string")
    assert got == ["Juncalito-Lote_03", "La_Isla-Lote_ML_4", "La_Isla-Lote_05", "a_b_12", "T9", "RC09", None]


def test_herd_label_and_prefer_base(spark):
    rows = [("R1", "lag_1", None, "7"), ("R1", "lote_c", 3, "x")]
    df = spark.createDataFrame(rows, "h string, v string, b int, a string")
    got = df.select(herd_label("h", "v").alias("l"), prefer_base("b", "a").alias("n")).collect()
    assert [(r.l, r.n) for r in got] == [("R1_1", 7), ("R1", 3)]


def test_prefix_codes(spark):
    rows = [("RECODO", "LOTE", 3), ("ISLA", "MANGA LARGA", 4), ("ISLA", "PARAISO", 12), ("ISLA", "X", 1)]
    df = spark.createDataFrame(rows, "f string, h string, n int")
    got = [r[0] for r in df.select(prefixed_code(farm_prefix("f", "h"), "n")).collect()]
    assert got == ["RC03", "La_Isla-Lote_ML_4", "Paraiso-Lote_12", "La_Isla-Lote_01"]


def test_calving_categories_and_null_trap(spark):
    rows = [("M.MUERTO",), ("un MACHO muerto",), ("H.MUERT",), ("aborto",), ("Hembra",), ("hembra",), ("x M",),
            ("nada",), (None,), ("InterHerd H",)]
    got = one(spark, calving_category("c"), rows, "c string")
    assert got == [4, 4, 5, 8, 2, 2, 3, 1, 1, 1]
    legacy = one(spark, calving_category("c", legacy=True), rows, "c string")
    assert legacy[8] == 4


def test_service_and_vocab(spark):
    got = one(spark, service_category("c"), [("Inseminada",), ("TORO",), ("otro",), (None,)], "c string")
    assert got == [12, 13, 12, 12]
    got = one(spark, vocabulary_category("c"), [("h",), ("m.muert",), ("Distocia",), ("zzz",)], "c string")
    assert got == [2, 4, None, 1]


def test_operator_names(spark):
    got = one(spark, name_to_id("n", {"ANA": 19, "LUIS": 28}, 35), [("ANA",), ("PEDRO",), (None,)], "n string")
    assert got == [19, 35, 35]


def test_text_helpers(spark):
    rows = [("85%", "  a \t", "", "12/31/2021", 10.0, 0.0)]
    df = spark.createDataFrame(rows, "p string, s string, b string, d string, n double, z double")
    r = df.select(percent_to_fraction("p").alias("p"), strip("s").alias("s"), blank_to_null("b").alias("b"),
                  parse_date("d", "MM/dd/yyyy").alias("d"), parse_date(F.lit("bad"), "MM/dd/yyyy").alias("bad"),
                  safe_ratio("n", "z").alias("r"), composite_key("d", "p", "s").alias("k")).first()
    assert r.p == pytest.approx(0.85) and r.s == "a" and r.b is None and r.bad is None and r.r is None
    assert str(r.d).startswith("2021-12-31") and r.k == "12/31/2021_85%_  a \t"


def test_strict_int_raises(spark):
    with pytest.raises(Exception):
        one(spark, F.col("x").cast("int"), [("P",)], "x string")


def test_split_sector(spark):
    df = spark.createDataFrame([("LOTE 1,2:3,4",), ("JUNCAL 5",)], "s string")
    r = df.select(split_sector("s").alias("x")).collect()
    assert r[0].x.head == "LOTE 1,2" and r[0].x.after == ["3", "4"] and r[0].x.numbers == ["1", "2"]
    assert r[1].x.after == [] and r[1].x.numbers == ["5"]


def test_recodes(spark):
    df = spark.createDataFrame([("P",), ("p",), ("3",), (None,)], "x string")
    got = [r[0] for r in df.select(recode("x", {"P": "5", "p": "5"})).collect()]
    assert got == ["5", "5", "3", None]
    r = recode_with_fallback(spark.createDataFrame([("ISLA",), ("OTRO",)], "h string"), "h", {"ISLA": 5}, "id", "raw")
    assert [(x.id, x.raw) for x in r.collect()] == [(5, None), (None, "OTRO")]
    got = one(spark, shift_code("x"), [(-1,), (0,), (3,), (None,)], "x int")
    assert got == [1, 2, 4, None]


def test_recode_join_leaves_the_strategy_to_the_planner(spark):
    from pradera.functions import recode as R
    facts = spark.range(0, 100).select(F.col("id").alias("k"))
    table = spark.createDataFrame([(i, i * 10) for i in range(50)], "key long, val long")
    out = R.recode_join(facts, table, "k", "key", "val", "out", default=34)
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plan and "limit" not in plan
    assert sorted(r.out for r in out.collect())[-1] == 490 and out.filter("out = 34").count() == 50


def test_every_category_occurs_in_the_registered_queries(spark):
    """The stand-in comments reach each rule, its place in the order, and the default."""
    from pradera.functions.categories import CALVING_RULES
    from pradera.plans import catalog
    sf = "/root/testdata/sf0.01"
    got = lambda q: {r.category for r in catalog.queries()[q](spark, sf).select("category").distinct().collect()}
    assert got("comment_category") == {c for _, _, c in CALVING_RULES} | {1}
    assert got("service_category") == {12, 13}
    assert got("vocab_match") == {1, 2, 3, 4, 5, 6, 8, 10, 11, None}
