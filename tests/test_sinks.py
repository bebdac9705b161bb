"""Written tables: whole or not at all, and gone with their application."""
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.session import application_folder
from strata.sources.sinks import export_mart, materialise


def test_replacement_leaves_the_old_table_or_the_new_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    one, two = spark.range(3).withColumn("v", F.lit("a")), spark.range(5).withColumn("v", F.lit("b"))
    assert rows(materialise(one, "t", path)) == rows(one)
    bad = two.withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        materialise(bad, "t", path)
    assert rows(spark.read.parquet(path)) == rows(one)  # a failed write changes nothing
    assert rows(materialise(two, "t", path)) == rows(two)
    left = [p.name for p in Path(tmp_path).iterdir() if p.name.startswith("t.old")]
    assert left == []  # the old table is removed, once the new one is there
    again = materialise(spark.read.parquet(path).where("id > 1"), "t", path)  # made from the table it replaces
    assert rows(again, "id") == [(2,), (3,), (4,)]


def test_partitioned_tables_keep_types_and_order_of_columns(spark):
    df = spark.createDataFrame([("x", 20, 1), (None, 30, 2), ("z", None, 3)], "a string, term int, n int")
    got = materialise(df.select("term", "a", "n"), "parts", partition_by=["term"])
    assert got.dtypes == [("term", "int"), ("a", "string"), ("n", "int")] and rows(got) == rows(df, "term", "a", "n")
    plan = got.where("term = 20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term" in plan


SCRIPT = """
import sys
from strata import session
from strata.sources.sinks import export_mart, materialise
spark = session.build_session("local[1]", extra={"spark.checkpoint.dir": sys.argv[1]})
materialise(spark.range(3), "a"), export_mart(spark.range(3), "b"), materialise(spark.range(3), "c", sys.argv[1] + "/kept")
assert len(session.clean(spark)) == 2 and session.clean(spark) == []
materialise(spark.range(3), "d")
session.stop(spark)
"""


def test_nothing_is_left_after_the_stop(spark, tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=300,
                          env=os.environ | {"PYTHONPATH": root})
    assert done.returncode == 0, done.stderr[-2000:]
    parquet = {str(p.relative_to(tmp_path)).split("/")[0] for p in Path(tmp_path).rglob("*.parquet")}
    assert parquet == {"kept"}  # a table with a path of its own stays
    assert application_folder(spark, "tables") in export_path_of(spark).replace("/exports/", "/tables/")


def export_path_of(spark):
    return export_mart(spark.range(1), "where")
