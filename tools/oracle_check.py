"""Run every registered key in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key-prefix ...]
Compares column names, row counts and an order-insensitive multiset of rows
(floats to 9 decimals, decimals as floats, dates as ISO text).
"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strata.registry import ORACLES, QUERIES, load_all  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources.tables import TABLES, table_path  # noqa: E402


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare floats bit for bit


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if STRICT:
            return v
        r = round(v, 9)
        # keep the sign of zero: -0.0 and 0.0 print (and may hash) differently
        return r
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    plain = "--plain" in args
    prefixes = [a for a in args if not os.path.isdir(a) and not a.startswith("--")]
    load_all()
    if plain:
        # A bare session, as a caller might build it: no checkpoint folder, no
        # strata defaults.
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.driver.memory", "8g").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    ok = bad = skipped = 0
    for key in sorted(QUERIES):
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = QUERIES[key](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key}: spark error {type(e).__name__}: {str(e)[:600]}")
            continue
        ts = time.time() - t0
        if key not in ORACLES:
            skipped += 1
            print(f"ROWS {key}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(ORACLES[key])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key}: duckdb error {str(e)[:600]}")
            continue
        if sorted(scols) != sorted(dcols):
            bad += 1
            print(f"FAIL {key}: columns spark={scols} duck={dcols}")
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if len(a) != len(b):
            bad += 1
            print(f"FAIL {key}: rows spark={len(a)} duck={len(b)}")
            continue
        if a != b:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {key}: values differ, sorted cols={sorted(scols)} e.g. {diff}")
            continue
        ok += 1
        print(f"OK   {key}: {len(a)} rows {ts:.1f}s")
    print(f"ok={ok} bad={bad} rows-only={skipped}")
    spark.stop()


if __name__ == "__main__":
    try:
        main()
    except Exception:
        traceback.print_exc()
        sys.exit(1)
