"""Window and interval operators on a key with a third of all rows, against the plain forms."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.joins import binned_interval_join, interval_join, join_grouped
from strata.operators.windows import running_sum, shift_by
from conftest import rows


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, 1, 2, 3]) if i % 3 else 7, rng.randint(0, 40), i, rng.choice([None, *range(-5, 20)])) for i in range(900)]
    data += [(8, 1, 1000, None), (8, 2, 1001, None), (9, 5, 1002, 4)]
    return spark.createDataFrame(data, "k long, t long, id long, v long").repartition(6).cache()


@pytest.mark.parametrize("hot_rows", [None, 10_000, 200, 5, 0])
@pytest.mark.parametrize("parts", [3, 40])
def test_shift_by_equals_the_window(series, hot_rows, parts):
    w = Window.partitionBy("k").orderBy("t", "id")
    shifts = {"a1": ("id", 1), "b1": ("id", -1), "a3": ("v", 3), "b2": ("v", -2), "same": ("t", 0)}
    want = series.withColumns({n: F.lead(c, k).over(w) if k >= 0 else F.lag(c, -k).over(w) for n, (c, k) in shifts.items()})
    got = shift_by(series, ["k"], ["t", "id"], shifts, hot_rows=hot_rows, num_partitions=parts)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_shift_by_without_keys_and_of_nothing(series):
    w = Window.orderBy("t", F.desc("id"))
    got = shift_by(series, [], ["t", F.desc("id")], {"n": ("id", 2), "p": ("id", -2)}, hot_rows=10, num_partitions=300)
    assert rows(got) == rows(series.withColumns({"n": F.lead("id", 2).over(w), "p": F.lag("id", 2).over(w)}))
    assert shift_by(series.limit(0), ["k"], ["t"], {"n": ("id", 1)}, hot_rows=0).collect() == []


@pytest.mark.parametrize("hot_rows, parts", [(None, 4), (200, 3), (200, 60), (0, 25)])
def test_running_sum_equals_the_range_frame(series, hot_rows, parts):
    w = Window.partitionBy("k").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    got = running_sum(series, ["k"], ["t"], F.col("v"), "s", hot_rows=hot_rows, num_partitions=parts)
    assert rows(got) == rows(series.withColumn("s", F.sum("v").over(w)))


def test_running_sum_ordered_by_its_own_key_as_well(series):
    w = Window.partitionBy("k").orderBy("k", "t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    got = running_sum(series, ["k"], ["k", "t"], F.col("v") * 2, "s", hot_rows=50, num_partitions=20)
    assert rows(got) == rows(series.withColumn("s", F.sum(F.col("v") * 2).over(w)))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_grouped_equals_the_join(spark, how):
    left = spark.createDataFrame([(i % 5 if i % 7 else None, i % 3, i) for i in range(60)], "k int, y int, v int")
    side = spark.createDataFrame([(1, 0, "a"), (2, 1, "b"), (None, 2, "c"), (4, None, "d")], "k long, y int, w string").groupBy("k", "y").agg(F.max("w").alias("w"))
    want = left.join(side, ["k", "y"], how).select(left.columns + ([] if how in ("left_semi", "left_anti") else ["w"]))
    got = join_grouped(left, side, ["k", "y"], how)
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


@pytest.mark.parametrize("width", [1, 86_400, 10 * 86_400, 10**9])
def test_binned_interval_join_equals_the_plain_join(spark, width):
    rng = random.Random(width)
    key = lambda i: 7 if i % 3 == 0 else rng.choice([None, 1, 2])
    points = spark.createDataFrame([(key(i), i, rng.choice([None, 5 * rng.randint(-50, 300)])) for i in range(200)], "k int, p int, d int")
    spans = [(key(i), i, a := rng.randint(-250, 1500), a + rng.randint(-3, 90)) for i in range(120)] + [(7, 500, None, 5), (7, 501, 5, None), (9, 502, 0, 1)]
    spans = spark.createDataFrame(spans, "j int, s int, a int, b int")
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), c).alias(c)
    if width >= 86_400:
        points, spans = points.select("k", "p", day("d")), spans.select("j", "s", day("a"), day("b"))
    want = interval_join(points, spans, ["k"], F.col("d"), F.col("a"), F.col("b"), "inner", right_keys=["j"])
    for keep, how in (("inner", "inner"), ("points", "left"), ("intervals", "right")):
        got = binned_interval_join(points, spans, ["k"], "d", "a", "b", width, keep, interval_keys=["j"], interval_id="s")
        whole = interval_join(points, spans, ["k"], F.col("d"), F.col("a"), F.col("b"), how, right_keys=["j"])
        assert rows(got, "k", "p", "d", "s", "a", "b", "j") == rows(whole, "k", "p", "d", "s", "a", "b", "j")
    assert want.count() > 20
    with pytest.raises(ValueError):
        binned_interval_join(points, spans, ["k"], "d", "a", "b", width, "intervals", interval_keys=["j"])
