"""Property test: for any small input, the chunked scan equals plain windows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pradera.operators import scan
from pradera.operators.scan import ordered_scan, value_chunk

from .window_reference import window_reference

ROW = st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.one_of(st.none(), st.integers(0, 40)), st.sampled_from([0, 1, 2, None]),
                st.one_of(st.none(), st.floats(0, 10, allow_nan=False)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=80), width=st.one_of(st.none(), st.integers(1, 12)),
       few=st.sampled_from([1, 4, 64]))
def test_chunked_scan_equals_windows(spark, rows, width, few):
    """``few``: sampled rows of a task, so that keys are cut into many chunks."""
    old = scan.SAMPLE, scan.CUT, scan.LEAST
    scan.SAMPLE, scan.CUT, scan.LEAST = few, min(few, 2), 0
    try:
        _compare(spark, rows, width)
    finally:
        scan.SAMPLE, scan.CUT, scan.LEAST = old


def _compare(spark, rows, width):
    data = [(i, k, t, f, x) for i, (k, t, f, x) in enumerate(rows)]
    df = spark.createDataFrame(data, "rid long, k long, t int, f int, x double")
    spec = dict(sums={"s": "f"}, runs={"r": "f"}, ffill={"ff": "x"}, lags={"l2": ("x", 2)}, row_number="rn",
                run_fills={"q": ("f", True)}, lag_fills={"g": ("x", F.col("f") == 0)},
                last_pos={"p": F.col("f") == 2}, change_ids={"c": "f"}, before={"b": "x"}, leads={"n": "x"})
    a = ordered_scan(df, ["k"], ["t", "rid"], value_chunk("t", width) if width else None, **spec)
    b = window_reference(df, ["k"], ["t", "rid"], **spec)
    cols = ["rid", "s", "r", "ff", "l2", "rn", "q", "g", "p", "c", "b", "n"]
    assert sorted(tuple(r) for r in a.select(cols).collect()) == sorted(tuple(r) for r in b.select(cols).collect())
