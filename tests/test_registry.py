"""Every registered key against its DuckDB oracle on the sf0.001 tables, the
driver contract, and plan-shape assertions at sf0.01."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import rows_of  # noqa: E402
from strata.registry import ORACLES, QUERIES, load_all  # noqa: E402
from strata.sources.tables import TABLES, table_path  # noqa: E402

load_all()
SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        assert df.columns                      # rows-only keys still have a stable schema
        return
    cur = duck.execute(ORACLES[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, cur.fetchall())


def test_contract(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 150
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "LotName"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["c08_theta_join", "c10_cross_join", "c16_anti_flag", "c14_semi_flag",
                                 "l08_spine", "l11_transfers", "l24_dropout_labels"])
def test_no_nested_loop_or_cartesian(spark, key):
    plan = _plan(QUERIES[key](spark, MID))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_filters_and_projection_reach_the_scan(spark):
    plan = _plan(QUERIES["b05_filter_and"](spark, MID))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in plan
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(schema.split(",")) == ["o_orderkey:bigint", "o_orderpriority:string", "o_orderstatus:string",
                                         "o_totalprice:double"]            # 4 of 6 columns read
    plan = _plan(QUERIES["c18_scalar_subquery"](spark, MID))
    assert "GreaterThanOrEqual(o_custkey,ScalarSubquery" in plan     # the bound is pushed into the scan


def test_global_rank_has_no_single_partition_window_over_rows(spark):
    df = QUERIES["e05_global_dense_rank"](spark, MID)
    # the only single-partition step ranks the distinct years, never the order rows
    plan = _plan(df)
    assert "Window" in plan or "BroadcastHashJoin" in plan
    assert df.select("recency").distinct().count() == df.select("y").distinct().count()


@pytest.mark.parametrize("key, copies", [("d11_rollup_label", 1), ("d10_partial_rollup", 0), ("l03_enrollment_snapshot", 0)])
def test_rollups_copy_rows_once_or_not_at_all(spark, key, copies):
    plan = _plan(QUERIES[key](spark, MID))
    assert (plan.count("Expand") > 0) == copies and "NestedLoop" not in plan


def test_fixed_pivot_is_one_exchange(spark):
    plan = _plan(QUERIES["l18_lot_pnl"](spark, MID))
    # one map-side-combined aggregate: partial sums, one exchange, final sums
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
