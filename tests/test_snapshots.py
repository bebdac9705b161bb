"""The table kept by day: reads only new and changed days, replaces only their terms."""
import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from strata.sources import institutional
from strata.sources.snapshots import DailyTable
from strata.sources.tables import Tables

SF = "/root/testdata/sf0.001"
D = dt.date


def test_refresh_reads_new_changed_and_removed_days_only(spark, tmp_path):
    table = DailyTable(spark, f"{tmp_path}/t", StructType.fromDDL("term string, v int"), "term")
    asked = []

    def refresh(source):
        df = spark.createDataFrame(source, "day date, term string, v int")
        marks = df.groupBy("day").agg(F.concat_ws(",", F.sort_array(F.collect_list(F.concat_ws(":", F.coalesce("term", F.lit("-")), "v")))).alias("mark"))
        del asked[:]
        built = table.refresh(marks, lambda days: asked.extend(days) or df.filter(F.col("day").isin(days) if days else F.lit(False)))
        assert rows(table.read(), "term", "v") == sorted([(t, v) for _, t, v in source], key=repr)
        assert built == asked or not built
        return built

    days = [(D(2020, 1, i), "a" if i < 4 else "b" if i < 6 else None, i) for i in range(1, 8)]
    assert refresh([]) == []
    assert refresh(days) == [d for d, _, _ in days]
    assert refresh(days) == []
    assert refresh([*days, (D(2020, 2, 1), "c", 9)]) == [D(2020, 2, 1)]
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("term=b/*.parquet")}
    changed = [*days[1:], (D(2020, 1, 2), "a", 50), (D(2020, 2, 1), "c", 9)]  # the first day is gone, the second has a row more
    assert refresh(changed) == [D(2020, 1, 2)]
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("term=b/*.parquet")} == untouched
    moved = [(d, "z" if t == "b" else t, v) for d, t, v in changed]  # a term loses all its days
    assert refresh(moved) == [D(2020, 1, 4), D(2020, 1, 5)]
    assert refresh([]) == [] and table.read().count() == 0


@pytest.fixture()
def copied(tmp_path):
    """The tables that the snapshot needs, the last day of orders held back."""
    orders, lines = pq.read_table(f"{SF}/orders.parquet"), pq.read_table(f"{SF}/lineitem.parquet")
    days = orders.column("o_orderdate").to_pandas().dt.date
    pq.write_table(orders.filter((days < days.max()).to_numpy()), tmp_path / "orders.parquet")
    pq.write_table(lines, tmp_path / "lineitem.parquet")
    return tmp_path, orders, days.max()


def test_section_days_follow_the_orders(spark, copied, monkeypatch):
    folder, orders, last = copied
    built = []
    plain = DailyTable.refresh
    monkeypatch.setattr(DailyTable, "refresh", lambda self, *a: built.append(plain(self, *a)))
    as_of = D(2001, 6, 1)

    def days():
        t = Tables(spark, str(folder))
        got = institutional.section_days(t, as_of, f"{folder}/kept")
        o = institutional.fact_daily_enrollments(t, as_of)
        want = o.groupBy("term_code", "days_since_reg_start").agg(F.count_distinct("crn").alias("sections"), F.count(F.lit(1)).alias("enrollments"))
        assert rows(got) == rows(want)
        return got

    days()
    assert last not in built[-1] and len(built[-1]) > 100
    days()
    assert built[-1] == []
    pq.write_table(orders, folder / "orders.parquet")
    days()
    assert built[-1] == [last]


def test_periods_do_not_read_the_line_items(spark):
    from strata.registry import QUERIES, load_all
    load_all()
    plan = QUERIES["l02_periods"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan
