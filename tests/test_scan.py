"""The chunked ordered scan equals single windows, for any chunk width (H6)."""

import random

import pytest
from pyspark.sql import functions as F

from pradera.operators import scan
from pradera.operators.scan import day_chunk, ordered_scan, value_chunk

from .window_reference import window_reference


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Keys are cut into chunks however few rows they have."""
    monkeypatch.setattr(scan, "LEAST", 0)


def _rows(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice([1, 1, 1, 1, 2, 3, None]) if seed % 2 else rnd.choice([1, 2])  # hot key 1
        out.append((i, key, rnd.choice([None, *range(60)]), rnd.choice([0, 1, 1, 2, None]),
                    rnd.choice([None, None, rnd.random()])))
    return out


def _cmp(a, b, cols):
    x = sorted(tuple(r) for r in a.select(cols).collect())
    y = sorted(tuple(r) for r in b.select(cols).collect())
    assert x == y


@pytest.mark.parametrize("seed,width", [(0, 1), (1, 3), (2, 7), (3, 100), (4, 2), (5, 5), (6, None), (7, None)])
def test_scan_matches_window(spark, seed, width):
    df = spark.createDataFrame(_rows(seed), "rid long, k long, t int, f int, x double")
    spec = dict(sums={"s": "f"}, runs={"r": "f"}, ffill={"ff": "x"}, lags={"l1": ("x", 1), "l3": ("rid", 3)},
                run_fills={"q": ("f", False), "qr": ("f", True)}, row_number="rn",
                lag_fills={"g": ("x", F.col("f") == 0), "g2": ("rid", F.col("f") != 1)},
                last_pos={"p": F.col("f") == 0, "p2": F.col("x").isNotNull()}, change_ids={"c": "f", "c2": "x"}, before={"b": "x", "b2": "f"}, leads={"n": "x", "n2": "rid"})
    order = ["t", "rid"]
    a = ordered_scan(df, ["k"], order, value_chunk("t", width) if width else None, **spec)
    b = window_reference(df, ["k"], order, **spec)
    # rows with a null key get null outputs from the chunked scan
    outs = ["s", "r", "ff", "l1", "l3", "q", "qr", "rn", "g", "g2", "p", "p2", "c", "c2", "b", "b2", "n", "n2"]
    b = b.withColumns({c: F.when(F.col("k").isNotNull(), F.col(c)) for c in outs})
    _cmp(a, b, ["rid", *outs])


def test_global_numbering_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumn("old", (F.col("id") * 7919) % 100003)
    from pradera.operators.keys import assign_ids
    out = assign_ids(df, "old", F.lit(100), "new")
    rows = sorted((r.old, r.new) for r in out.collect())
    assert [n for _, n in rows] == list(range(101, 5101))


def test_reset_counter_invariants(spark):
    # counter is 0 exactly on reset rows and never crosses a key
    rows = [(i, k, i % 5, 0 if i % 4 == 0 else 1) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "t long, k long, d int, f int").withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t").cast("int")))
    out = ordered_scan(df, ["k"], ["t"], day_chunk("date", 3), runs={"r": "f"}).collect()
    for r in out:
        assert (r.r == 0) == (r.f == 0)
        if r.f:
            assert r.r == (r.t % 4)


def test_no_unpartitioned_window_on_rows(spark):
    df = spark.range(0, 1000).withColumn("k", F.col("id") % 3).withColumn("v", F.lit(1))
    out = ordered_scan(df, ["k"], ["id"], value_chunk("id", 100), sums={"s": "v"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_hot_key_is_split_across_tasks(spark):
    """One key holds a third of all rows: its rows spread over many (key, chunk) groups."""
    n = 3000
    df = spark.range(0, n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"),
        (F.col("id") % 4 == 0).cast("int").alias("f"))
    out = ordered_scan(df, ["k"], ["d", "rid"], day_chunk("d", 7), runs={"r": "f"}, keep_chunk=True)
    groups = out.filter("k = 0").select("_chunk").distinct().count()
    assert groups >= 12                                   # 90 days / 7-day chunks
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_chunk" in plan
    # no exchange partitions the rows by the key alone
    import re
    assert not re.search(r"hashpartitioning\(k#\d+L?, \d+\), REPARTITION", plan)


def test_change_flags_and_reset_sum(spark):
    from pradera.operators.runs import change_flags, run_sum_reset
    rows = [(1, 1, "A"), (1, 2, "A"), (1, 3, None), (1, 4, None), (1, 5, "B"), (2, 1, "B"), (2, 2, "B")]
    df = spark.createDataFrame(rows, "k long, t int, act string").withColumn(
        "d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t")))
    out = change_flags(df, ["k"], ["t"], "act").orderBy("k", "t").collect()
    assert [r.lote_change for r in out] == [True, False, False, False, False, True, False]
    assert [r.actividad_change for r in out] == [False, True, False, False, False, False, True]   # null != null
    f = df.withColumn("f", F.when(F.col("act").isNull(), 0).otherwise(1))
    r = run_sum_reset(f, ["k"], ["t"], "f", "run").orderBy("k", "t").collect()
    assert [x.run for x in r] == [1, 2, None, None, 1, 1, 2]


def test_null_order_values_come_first(spark):
    """The rows (null, 5), (01-01, 6), (01-02, 0), (03-02, 2) of one key, by date buckets and by rows."""
    df = spark.createDataFrame([(None, 5), ("2024-01-01", 6), ("2024-01-02", 0), ("2024-03-02", 2)], "d string, v int")
    df = df.select(F.lit(1).alias("k"), F.to_date("d").alias("d"), "v")
    for chunk in (day_chunk("d", 31), None):
        out = ordered_scan(df, ["k"], ["d"], chunk, sums={"s": "v"}, row_number="n").orderBy("n").collect()
        assert [(r.s, r.n) for r in out] == [(5, 1), (11, 2), (11, 3), (13, 4)]


def test_ids_by_rows(spark):
    """Few distinct ids with many rows, random 64-bit ids, and null ids: numbered as row_number does, by many tasks."""
    from pyspark.sql import Window

    from pradera.operators.keys import assign_ids, row_numbers
    few = spark.range(0, 20000).select((F.xxhash64("id") % 11 + 11).alias("old"), "id")
    wide = spark.range(0, 20000).select(F.when(F.col("id") % 50 != 0, F.xxhash64("id")).alias("old"), "id")
    for df in (few, wide):
        out = assign_ids(df, "old", F.lit(100), "new", tie=["id"])
        want = df.withColumn("new", F.lit(100) + F.row_number().over(Window.orderBy("old", "id")))
        assert out.select("old", "id", "new").exceptAll(want.select("old", "id", "new")).count() == 0
        assert out.count() == 20000
    chunks = ordered_scan(few, [], ["old", "id"], row_number="n", keep_chunk=True).groupBy("_chunk").count().collect()
    assert len(chunks) >= 4 and max(r["count"] for r in chunks) < 10000
    assert row_numbers(spark.createDataFrame([(None,), (5,), (7,)], "i int"), ["i"]).orderBy("row_no").collect()[0].i is None


def test_a_hot_day_is_split(spark):
    """A third of all rows on one paddock-day: its rows spread over several chunks, the answers stay the same."""
    n = 6000
    df = spark.range(0, n).select(
        F.col("id").alias("rid"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-05-01")).otherwise(
            F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")), "yyyy-MM-dd"))
        .cast("date").alias("d"), (F.col("id") % 7 != 0).cast("int").alias("f"))
    spec = dict(runs={"r": "f"}, lags={"l": ("rid", 1)}, row_number="rn")
    out = ordered_scan(df, ["k"], ["d", "rid"], keep_chunk=True, **spec)
    assert out.where("k = 1").select("_chunk").distinct().count() > 1
    _cmp(out, window_reference(df, ["k"], ["d", "rid"], **spec), ["rid", "r", "l", "rn"])


def test_the_grid_is_made_by_many_tasks(spark):
    from pradera.operators.calendar import key_days
    keys = spark.range(0, 50000).select((F.col("id") % 50000).alias("k"))
    g = key_days(keys, ["k"], F.lit("2024-01-15").cast("date"), F.lit("2025-01-13").cast("date"))
    per = g.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per) == 50000 * 365
    assert len(per) >= 4 and max(r["count"] for r in per) < 50000 * 365 / 2


def _exchanges(df):
    """Shuffles of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x], plan


def test_rows_are_shuffled_once_and_not_written(spark):
    few = spark.range(0, 200).select("id", (F.col("id") % 3).alias("k"))
    shuffles, plan = _exchanges(ordered_scan(few, ["k"], ["id"], sums={"s": "id"}, lags={"l": ("id", 1)}))
    assert len(shuffles) == 1 and "FileScan" not in plan and "Join" not in plan  # the plain window
    many = spark.range(0, 4000).select("id", (F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("wide"))
    shuffles, plan = _exchanges(ordered_scan(many, ["k"], ["id"], sums={"s": "id"}, lags={"l": ("id", 1)}))
    assert not any("wide" in x for x in plan.split("\n") if "FileScan" in x)  # summaries are stored, rows aren't
    assert len([x for x in shuffles if "_chunk" in x]) <= 2  # the rows, and the summaries where they aren't broadcast


def test_bounds_only_for_keys_with_many_rows(spark):
    df = spark.range(0, 4000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    out = ordered_scan(df, ["k"], ["id"], row_number="n", keep_chunk=True)
    per = {r["k"]: r["c"] for r in out.groupBy("k").agg(F.countDistinct("_chunk").alias("c")).collect()}
    assert per[0] > 1 and all(c == 1 for k, c in per.items() if k)
    small = ordered_scan(df.where("id < 100"), ["k"], ["id"], row_number="n", keep_chunk=True)
    assert small.select("_chunk").distinct().count() == 1


def test_chained_scans_share_a_layout(spark):
    """The second scan, on some of the rows, has no exchange of its own, and the same answers."""
    from pradera.operators.scan import lay_out
    df = spark.createDataFrame(_rows(1, 700), "rid long, k long, t int, f int, x double")
    order = ["t", "rid"]
    d, layout = lay_out(df, ["k"], order)
    one = ordered_scan(d, ["k"], order, layout, ffill={"ff": "x"}, row_number="n")
    two = ordered_scan(one.where("f = 1"), ["k"], order, layout, lags={"l": ("ff", 1)}, sums={"s": "n"})
    assert d.where("k = 1").select("_chunk").distinct().count() > 1
    want = window_reference(df, ["k"], order, ffill={"ff": "x"}, row_number="n")
    want = window_reference(want.where("f = 1"), ["k"], order, lags={"l": ("ff", 1)}, sums={"s": "n"})
    want = want.withColumns({c: F.when(F.col("k").isNotNull(), F.col(c)) for c in ("ff", "n", "l", "s")})
    _cmp(two, want, ["rid", "ff", "n", "l", "s"])
    assert len([x for x in _exchanges(two)[0] if "_chunk" in x]) <= 3  # the rows once, and each scan's summaries
    little, flat = lay_out(df.where("rid < 150"), ["k"], order)
    one = ordered_scan(little, ["k"], order, flat, ffill={"ff": "x"}, row_number="n")
    two = ordered_scan(one.where("f = 1"), ["k"], order, flat, lags={"l": ("ff", 1)}, sums={"s": "n"})
    assert flat.several is None and len(_exchanges(two)[0]) == 1


def test_numbering_makes_its_rows_once(spark, tmp_path):
    from pradera.operators.keys import assign_ids

    seen = str(tmp_path)

    def passed(batches):
        import os
        import uuid
        for b in batches:
            if b.num_rows:
                open(os.path.join(seen, uuid.uuid4().hex), "w").close()
            yield b
    df = spark.range(400_000, numPartitions=1).select((400_000 - F.col("id")).alias("old")).mapInArrow(passed, "old long")
    out = assign_ids(df, "old", F.lit(7), "new")
    once = len(list(tmp_path.iterdir()))
    assert out.where("new = old + 7").count() == 400_000
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert once == len(list(tmp_path.iterdir())) == -(-400_000 // rows)  # was once for the count, the sample, the summary and the rows
    assert assign_ids(df.where("old < 0"), "old", F.lit(7), "new").count() == 0
