"""Benchmark: run the headline jobs and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Each query is built and then fully executed into
Spark's no-op sink, so the time covers planning and every row, without
collecting to the driver.  Every query runs BENCH_REPEAT times in one session;
``queries`` holds the median, ``cold`` the first run (which also pays JIT
warm-up and the one-time build of the stand-in dimensions).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.registry import QUERIES, load_all  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    # the composed jobs
    "l05_enrollment_dashboard", "l15_presentation", "l17_running_share", "l18_lot_pnl",
    "l19_item_pnl", "l20_sell_through", "l21_clean_properties", "l24_dropout_labels", "l25_dropout_rate",
    # heavy single operators
    "c01_star_join", "c07_interval_join", "d05_cond_count_distinct", "d10_partial_rollup",
    "e02_duplicate_rows", "e03_sequence", "j03_fill_from_group", "r01_pivot_lot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in sys.argv[1:]]
    load_all()
    spark = build_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=max(8, cpus * 2))
    # warm-up: JIT and parquet metadata, not timed
    QUERIES["a01_scan_project"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs: dict[str, list[float]] = {k: [] for k in (only or HEADLINE)}
    for _ in range(repeat):
        for key in runs:
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[key].append(time.perf_counter() - t0)
    times = {k: round(statistics.median(v), 3) for k, v in runs.items()}
    cold = {k: round(v[0], 3) for k, v in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_jobs_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
