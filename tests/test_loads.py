"""Landed line positions, loads that are repeated or cut short, stored marks and touched ranges."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pradera.operators.keys import key_update
from pradera.sources import landing, loads

LINE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("v", T.StringType())])


def test_lines_of_many_splits_have_their_numbers(spark, tmp_path):
    files = {"a.csv": range(0, 4000), "b.csv": range(4000, 4001), "c.csv": range(4001, 9000)}
    os.mkdir(tmp_path / "in")
    for name, lines in files.items():
        (tmp_path / "in" / name).write_text("n,v\n" + "".join(f"{i * 7 % 9000},{'x' * (i % 40)}\n" for i in lines))
    want = [(i, i * 7 % 9000) for i in range(9000)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("4096", "50000", "134217728"):  # many splits, several in a task, one a file
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            out = str(tmp_path / "out")
            df = landing.land_csv(spark, str(tmp_path / "in"), LINE, out)
            assert df.columns == ["row_id", "n", "v"]
            if size == "4096":
                assert spark.read.parquet(f"{out}/splits").count() > 20
            spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")  # what later reads do doesn't matter
            assert sorted((r.row_id, r.n) for r in landing.landed(spark, out).collect()) == want
            assert sorted((r.row_id, r.n) for r in landing.landed(spark, out, "row_id", 1).collect())[0] == (1, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_positions_survive_a_lost_attempt(spark, tmp_path):
    """What a failed job leaves doesn't count: landing again gives the numbers of the lines."""
    (tmp_path / "a.csv").write_text("n,v\n" + "".join(f"{i},x\n" for i in range(100)) + "bad,x\n")
    with pytest.raises(Exception):  # noqa: B017
        landing.land_csv(spark, str(tmp_path / "a.csv"), LINE, str(tmp_path / "out"))
    df = landing.land_csv(spark, str(tmp_path / "a.csv"), LINE, str(tmp_path / "out"), corrupt="_bad")
    rows = sorted(tuple(r) for r in df.collect())
    assert [r[0] for r in rows] == list(range(101)) and rows[100][3] == "bad,x"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_loads_that_run_twice_or_are_cut_short(spark, tmp_path):
    a, b, log = (str(tmp_path / x) for x in ("a", "b", "log"))
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    more = spark.createDataFrame([(3, "z")], "k long, v string")
    schema = df.schema
    assert _rows(loads.loaded(spark, a, log, schema)) == []
    loads.stage(df, a, "01")  # ended between two tables
    assert _rows(loads.loaded(spark, a, log)) == [] and _rows(loads.loaded(spark, b, log, schema)) == []
    for _ in range(2):
        loads.load({a: df, b: df}, log, "01")
    loads.load({a: more, b: more.limit(0)}, log, "1")  # another id than 01
    assert _rows(loads.loaded(spark, a, log)) == [(1, "x"), (2, "y"), (3, "z")]
    assert _rows(loads.loaded(spark, b, log)) == [(1, "x"), (2, "y")]
    loads.load({a: df.limit(0), b: df}, log, "01")  # its rows are gone from the source
    assert _rows(loads.loaded(spark, a, log)) == [(3, "z")]
    with pytest.raises(ValueError, match="id"):
        loads.stage(df, a, "x/y")


def test_runs_over_a_growing_file_equal_one_run(spark, tmp_path):
    data = [(k, d, f"{k}{d}") for d in range(1, 9) for k in (d, d + 1, d % 3, None)] + [(5, None, "no date"), (99, None, "n")]
    df = spark.createDataFrame(data, "k long, d int, v string")
    one = str(tmp_path / "one"), str(tmp_path / "log1")
    loads.load_new(df, *one, "all", mark="d", keys=["k"])
    want = _rows(loads.loaded(spark, *one).select("k", "d"))
    many = str(tmp_path / "many"), str(tmp_path / "log2")
    for run, until in (("a", 3), ("b", 5), ("b", 5), ("c", 8), ("a", 8)):
        loads.load_new(df.where(F.coalesce("d", F.lit(8)) <= until), *many, run, mark="d", keys=["k"])
    assert _rows(loads.loaded(spark, *many).select("k", "d")) == want
    marks = {r["_load"]: (r["start"], r["mark"]) for r in loads.published(spark, many[1]).collect()}
    assert marks["id-a"][0] is None and marks["id-b"][0] == "3" and marks["id-c"][0] == marks["id-b"][1]
    again = df.where("d >= 8")
    loads.load_new(again, *many, "d", mark="d", keys=["k"])  # nothing is new
    assert _rows(loads.loaded(spark, *many).select("k", "d")) == want


def test_only_touched_ranges_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000).select(F.when(F.col("id") != 500, F.col("id")).alias("k"), F.col("id").alias("v"))
    loads.store_ranges(df, path, "k", 100)

    def files():
        return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}
    before = files()
    upd = spark.createDataFrame([(5, 50), (7, None), (7, 70), (950, 1), (5000, 2), (None, 9)], "k long, v long")
    loads.update_touched(spark, path, upd, "k", "v", 100, order=["v"])
    after = files()
    kept = {f for f in before if before[f] == after.get(f)}
    assert {f.split("/")[0] for f in before if f not in kept} == {"_range=0", "_range=9"}
    assert {f.split("/")[0] for f in after if f not in kept} == {"_range=0", "_range=9"}
    want = key_update(df, upd, "k", "v", unmatched_to_null=False, order=["v"])
    got = loads.stored_ranges(spark, path)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    loads.update_touched(spark, path, upd.limit(0), "k", "v", 100)
    assert files() == after


def test_a_large_array_file_is_cut_by_many_tasks(spark, tmp_path):
    from pradera.sources.json_arrays import json_elements, read_json_array
    import json
    rows = [{"a": i, "s": ["}", '{"', "\\", 'x\\"}', "[,]", "\n\t", "é}"][i % 7] * (i % 4), "in": {"b": {"c": i}, "d": ["{", "}"]},
             **({"more": [{"e": "}"}]} if i % 5 == 0 else {})} for i in range(1500)]
    os.mkdir(tmp_path / "in")
    (tmp_path / "in" / "a.json").write_text(json.dumps(rows[:900], indent=1))
    (tmp_path / "in" / "b.json").write_text(json.dumps(rows[900:]) + "\n[ ]\n")
    (tmp_path / "in" / "c.json").write_text("[]")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("none", T.StringType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = json_elements(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
        assert spark.read.parquet(str(tmp_path / "out" / "splits")).count() > 10
        assert [json.loads(r.element) for r in sorted(got)] == rows and sorted(r.row_id for r in got) == list(range(1500))
        d = read_json_array(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), rest="whole")
        back = d.select("a", "s", "none", F.to_json("whole").alias("whole")).collect()
        assert sorted((r.a, r.s) for r in back) == [(r["a"], r["s"]) for r in rows] and not any(r.none for r in back)
        assert sorted((json.loads(r.whole) for r in back), key=lambda x: x["a"]) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "bad.json").write_text('[{"a": 1}, {"a": 2')
    with pytest.raises(Exception):  # noqa: B017
        read_json_array(spark, str(tmp_path / "bad.json"), schema, str(tmp_path / "out2")).collect()
    rows = read_json_array(spark, str(tmp_path / "bad.json"), schema, str(tmp_path / "out2"), corrupt="_bad").collect()
    assert sorted((r.a, r._bad) for r in rows if r.a)[0] == (1, None) and any(r._bad == '{"a": 2' for r in rows)


def test_the_stored_side_of_a_bucketed_join_stays(spark, tmp_path):
    from pradera.operators.reconcile import reconcile
    from pradera.sources.sinks import store_bucketed
    stored = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = store_bucketed(stored, "bucketed_test", ["k"], 16, str(tmp_path / "b"))
        new = spark.range(0, 900, 3).select(F.col("id").alias("k"), F.col("id").alias("w"))
        j = reconcile(new, t, ["k"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("FileScan"):]
        above = plan[:plan.index("FileScan")].split("\n")[-4:]
        assert plan.count("Exchange hashpartitioning") == 1 and not any("Exchange" in x for x in above), side[:200]
        want = reconcile(new, stored, ["k"])
        assert sorted(map(str, j.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_test")
