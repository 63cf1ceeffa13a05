"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs fully (``noop`` sink: every row computed, nothing collected),
once to warm up and then ``$BENCH_RUNS`` times; the median is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pradera.plans import catalog  # noqa: E402
from pradera.session import get_spark  # noqa: E402

HEADLINE = [
    "calendar_grid", "since_all_types", "grazing_state", "prev_run_values", "path_lags", "path_unpivot",
    "herd_daily_sum", "forage_current", "band_series", "fill_and_thresh",
    "reconcile_counts", "new_activity_ids", "keep_last", "group_size_filter", "fk_remap", "zip_rows",
    "dup_report", "comment_category", "split_explode", "code_pad", "job_daily_tracking", "job_herd_milk",
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2)

    qs = catalog.queries()
    times = {}
    for name in only:
        fn = qs[name]
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        t = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            t.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(t), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum of median query seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_name}))


if __name__ == "__main__":
    main()
