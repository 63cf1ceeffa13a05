"""The interval form gives the rows that the ordered operators give on the dense grid."""

import random

import pytest
from pyspark.sql import functions as F

from pradera.operators import intervals, scan
from pradera.operators.calendar import dense_grid
from pradera.operators.runs import forward_fill, grazing_state, previous_run_values, run_sum_reset, since_last

ACTS = ["PASTOREO", "PASTOREO", "PASTOREO", "FUMIGADA", "ABONADA", None]


@pytest.fixture(params=[None, 0])
def chunks(request, monkeypatch):
    """Keys whole, and cut into chunks."""
    if request.param is not None:
        monkeypatch.setattr(scan, "LEAST", request.param)
        monkeypatch.setattr(scan, "SAMPLE", 16)
        monkeypatch.setattr(scan, "CUT", 2)
    return request.param


def _facts(spark, seed, n=260):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1, 1, 1, 1, 2, 3, 9, None]), f"2024-01-{rnd.choice([1, 3, 4, 4, 5, 9, 9, 10, 17, 25, 30]):02d}",
             rnd.choice(ACTS), rnd.choice([0, 10, 20, None]), rnd.choice(["RAYGRAS", "KYKUYO", None])) for i in range(n)]
    rows += [(n + 1, 4, "2024-01-28", "PASTOREO", 5, None), (n + 2, 2, None, "PASTOREO", 5, None)]
    return spark.createDataFrame(rows, "row_id long, k long, d string, act string, animals int, forage string").withColumn(
        "d", F.to_date("d"))


def _keys(spark):  # 5 and the null key have no fact, 9 isn't known
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (None, "f")], "k long, name string")


def _sorted(df):
    cols = sorted(df.columns)
    return sorted((str(tuple(r)) for r in df.select(cols).collect()))


def _grid(spark, f):
    return dense_grid(_keys(spark).select("k"), ["k"], f, ["k"], "d").drop("d").join(_keys(spark), "k")


ORDER = ["date", "row_id"]


def _interval(spark, f, **how):
    return intervals.fact_days(_keys(spark).where("k is not null"), ["k", "name"], f, ["k"], "d", ["row_id"], scan_keys=["k"], **how)


@pytest.mark.parametrize("seed", [1, 2])
def test_grazing_state(spark, chunks, seed):
    f = _facts(spark, seed)
    dense = grazing_state(_grid(spark, f), ["k"], ORDER, activity="act", date="date", animals="animals", fill=["forage"],
                          paddock_output=bool(seed % 2), since=["FUMIGADA", "ABONADA"])
    facts = intervals.grazing(_interval(spark, f, activity="act"), activity="act", animals="animals", fill=["forage"],
                              paddock_output=bool(seed % 2), since=["FUMIGADA", "ABONADA"])
    got = intervals.days(*facts).drop("d")
    assert _sorted(got) == _sorted(dense)
    # previous run values on the facts alone, in the same layout
    want = previous_run_values(dense, ["k"], ORDER, activity="act")
    rows, layout = intervals.fact_rows(*facts, where=F.col("act") == "PASTOREO")
    got = previous_run_values(rows, ["k"], ORDER, activity="act", layout=layout).drop("d")
    assert _sorted(got) == _sorted(want)


def test_fills_and_counters(spark, chunks):
    f, g = _facts(spark, 3), _grid(spark, _facts(spark, 3))
    want = forward_fill(g, ["k"], ORDER, ["animals", "forage"])
    assert _sorted(intervals.filled(_interval(spark, f), ["animals", "forage"]).drop("d")) == _sorted(want)
    want = since_last(g, ["k"], ORDER, "act", ["PASTOREO", "ABONADA"])
    assert _sorted(intervals.rows_since(_interval(spark, f), "act", ["PASTOREO", "ABONADA"]).drop("d")) == _sorted(want)
    flag = F.when(F.col("act").eqNullSafe(F.lit("PASTOREO")), 0).otherwise(1)
    want = run_sum_reset(g, ["k"], ORDER, flag, "n_pastoreo", keep_zeros=True)
    got = intervals.rows_since(_interval(spark, f), "act", ["PASTOREO"], prefix="n_", first=False).drop("d")
    assert _sorted(got) == _sorted(want)


def test_start_and_no_facts(spark):
    f = _facts(spark, 4)
    g = dense_grid(_keys(spark).select("k").where("k is not null"), ["k"], f, ["k"], "d", start="20240110").drop("d").join(_keys(spark), "k")
    got = intervals.filled(_interval(spark, f, start="20240110"), ["forage"]).drop("d")
    assert _sorted(got) == _sorted(forward_fill(g, ["k"], ORDER, ["forage"]))
    assert intervals.filled(_interval(spark, f.limit(0)), ["forage"]).count() == 0


def test_null_keys_have_null_outputs(spark):
    f = _facts(spark, 5)
    facts = intervals.fact_days(_keys(spark), ["k", "name"], f, ["k"], "d", ["row_id"], scan_keys=["k"], activity="act")
    rows = intervals.days(*intervals.grazing(facts, activity="act", animals="animals")).where("k is null").collect()
    assert len(rows) == 30 and all(r.dias_de_pastoreo is None and r.lote_change is None for r in rows)
