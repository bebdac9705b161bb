"""Time every registered key at one scale factor (built and fully executed
into the no-op sink).  Usage: python tools/time_all.py [sf_dir]"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.registry import QUERIES, load_all  # noqa: E402
from strata.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    load_all()
    spark = build_session("local[8]", shuffle_partitions=16)
    QUERIES["a01_scan_project"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    out = {}
    for k in sorted(QUERIES):
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        out[k] = round(time.perf_counter() - t0, 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
