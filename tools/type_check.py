"""Compare each key's Spark result types with its oracle's DuckDB types."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from strata.registry import ORACLES, QUERIES, load_all  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources.tables import TABLES, table_path  # noqa: E402


def spark_to_duck(dt):
    if isinstance(dt, T.IntegerType): return "INTEGER"
    if isinstance(dt, T.LongType): return "BIGINT"
    if isinstance(dt, T.DoubleType): return "DOUBLE"
    if isinstance(dt, T.FloatType): return "FLOAT"
    if isinstance(dt, T.StringType): return "VARCHAR"
    if isinstance(dt, T.DateType): return "DATE"
    if isinstance(dt, T.TimestampNTZType): return "TIMESTAMP"
    if isinstance(dt, T.TimestampType): return "TIMESTAMP WITH TIME ZONE"
    if isinstance(dt, T.BooleanType): return "BOOLEAN"
    if isinstance(dt, T.DecimalType): return f"DECIMAL({dt.precision},{dt.scale})"
    return str(dt)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    load_all()
    spark = build_session("local[4]", shuffle_partitions=4)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    bad = 0
    for k in sorted(ORACLES):
        sch = QUERIES[k](spark, sf).schema
        rel = con.sql(ORACLES[k])
        duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diffs = [(f.name, spark_to_duck(f.dataType), duck.get(f.name)) for f in sch.fields
                 if spark_to_duck(f.dataType) != duck.get(f.name)]
        if diffs:
            bad += 1
            print(k, diffs)
    print("keys with type differences:", bad)


if __name__ == "__main__":
    main()
