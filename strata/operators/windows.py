"""Window-shaped operators written so that no single key lands in one task.

A plain ``Window.partitionBy(k)`` sends every row of a key to one task; if one
key holds a third of the rows that task holds a third of the data.  The
operators below keep the window semantics but split hot keys:

* partition aggregates (min/max/sum/count distinct over a partition) are a
  ``groupBy`` (map-side combined, skew-safe) joined back to the rows;
* ``row_number`` uses a plain window for ordinary keys; rows of hot keys are
  range-partitioned, numbered inside each (key, range partition) and shifted by
  the row count of the key in earlier range partitions;
* ``lag``/``lead`` work inside ranges, and the rows at the borders of the ranges
  find their neighbours in a small relation of border rows (``shift_by``);
* running sums add the totals of earlier ranges to a sum inside the range
  (``running_sum`` with ``hot_rows``);
* ``dense_rank`` ranks the *distinct* (key, value) pairs, then joins back.

Where a group is bounded by construction (a series of one row per entity and
day, a student's years) the callers say so and a plain window is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import few_rows, null_safe_on
from strata.session import reliable_checkpoint


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def partition_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], few_groups: bool = False) -> DataFrame:
    """Attach per-partition aggregates to every row (``agg(...) OVER (PARTITION BY keys)``).

    NULL keys form their own partition, as in SQL windows (null-safe join back).
    ``few_groups``: the keys are expected to have few values (say three seasons);
    the groups are then written first and, if they are few, broadcast, so the rows
    are not sent to a handful of tasks by their key.
    """
    keys = list(keys)
    a = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    a = a.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *aggs.keys())
    if few_groups:
        a = few_rows(a, "groups")
    on = null_safe_on(df, a, keys, [f"__k{i}" for i in range(len(keys))])
    return df.join(a, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def partition_aggs(df: DataFrame, specs: Sequence[tuple[Sequence[str], dict[str, Column]]]) -> DataFrame:
    """Several partition aggregates at once: every aggregate is computed from the
    same ``df`` and joined back, so k aggregates read ``df`` k + 1 times (nested
    ``partition_agg`` calls would read it 2^k times).  Checkpoint ``df`` first
    when it is an expensive pipeline."""
    out = df
    for i, (keys, aggs) in enumerate(specs):
        keys = list(keys)
        ks = [f"__p{i}_{j}" for j in range(len(keys))]
        a = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
        a = a.select(*[F.col(k).alias(x) for k, x in zip(keys, ks)], *aggs.keys())
        out = out.join(a, null_safe_on(out, a, keys, ks), "left").drop(*ks)
    return out


# A key with more rows than this is "hot": its rows are numbered on range-split
# partitions instead of in one window partition (one task).
HOT_GROUP_ROWS = 2_000_000


def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  name: str = "row_number", hot_rows: int | None = HOT_GROUP_ROWS,
                  num_partitions: int | None = None, sizes_from: DataFrame | None = None,
                  size_keys: Sequence[str] | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``, skew-safe.

    Keys are counted first (a map-side combined aggregate).  Keys up to
    ``hot_rows`` rows are numbered by a plain window (each group fits a task).
    Rows of hotter keys are range-partitioned on (keys, order), written once to
    the checkpoint folder so every later read sees the same partition
    assignment, numbered inside each (key, range partition) and shifted by the
    key's row count in earlier range partitions.

    ``hot_rows=None`` states that groups are bounded by construction (e.g.
    distinct (student, year, term) rows: at most the terms of a year); then a
    plain window is used and no key count is taken.  ``sizes_from`` is a
    cheaper relation whose groups contain ``df``'s groups (say the raw fact
    under a filtered join), used for the key count instead of ``df``;
    ``size_keys`` a cheaper subset of the keys (say a hash of a long text) to
    count by: a hot subset group sends all its rows down the range path, which
    is exact for any group.

    ``order`` must make a total order inside each key (add a unique
    tie-breaker); otherwise the numbering among ties is arbitrary, as in SQL.
    """
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if hot_rows is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long"))
    skeys = list(size_keys or keys)
    ks = [f"__k{i}" for i in range(len(skeys))]
    hot = ((sizes_from if sizes_from is not None else df).groupBy(*skeys).agg(F.count(F.lit(1)).alias("__n"))
             .filter(F.col("__n") > hot_rows)
             .select(*[F.col(k).alias(a) for k, a in zip(skeys, ks)], F.lit(True).alias("__hot")))
    if hot.isEmpty():
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    # At most rows / hot_rows keys are hot; Spark sizes this join itself.
    tagged = df.join(hot, null_safe_on(df, hot, skeys, ks), "left").drop(*ks)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    normal = (tagged.filter(F.col("__hot").isNull()).drop("__hot")
                    .withColumn(name, F.row_number().over(w).cast("long")))
    hot_part = _ranged_row_number(tagged.filter(F.col("__hot")).drop("__hot"), keys, order_cols, name,
                                  num_partitions or _shuffle_partitions(df))
    return normal.unionByName(hot_part)


def _ranged_row_number(df: DataFrame, keys: list[str], order_cols: list[Column], name: str,
                       n: int) -> DataFrame:
    ranged = _ranged(df, keys, order_cols, n)
    local = Window.partitionBy(*keys, "__pid").orderBy(*order_cols)
    ranged = ranged.withColumn("__rn", F.row_number().over(local))
    counts = ranged.groupBy(*keys, "__pid").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                            F.col("__pid").alias("__opid"),
                            F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"))
    on = null_safe_on(ranged, offsets, keys, [f"__k{i}" for i in range(len(keys))]) & \
        (ranged["__pid"] == offsets["__opid"])
    out = ranged.join(offsets, on, "inner")
    out = out.withColumn(name, F.col("__rn") + F.col("__off"))
    return out.drop("__pid", "__rn", "__opid", "__off", *[f"__k{i}" for i in range(len(keys))])


def shift_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], shifts: Mapping[str, tuple[str, int]],
             hot_rows: int | None = HOT_GROUP_ROWS, num_partitions: int | None = None) -> DataFrame:
    """``lag`` and ``lead`` without one task per key: for each ``name: (column, n)`` the
    value of ``column`` n rows later (earlier for n < 0) in the key's order, else NULL.

    Keys up to ``hot_rows`` rows take a plain window (with no keys the whole relation
    is one group).  Rows of hotter keys are range-partitioned on (keys, order) and
    written once with their partition; inside a range the plain window is right for
    all rows but those within reach of its two ends.  These border rows -- at most
    2 * reach of each range of a key -- form a small relation of their own, in which
    each one's neighbours stand next to it, so their values come from a window over
    the border rows of a key, whose number depends on the ranges and not on the rows.

    ``order`` must make a total order inside a key.
    """
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    plain = Window.partitionBy(*keys).orderBy(*order_cols)

    def shifted(frame: DataFrame, window) -> DataFrame:
        return frame.withColumns({n: F.lead(c, k).over(window) if k >= 0 else F.lag(c, -k).over(window) for n, (c, k) in shifts.items()})

    if hot_rows is None:
        return shifted(df, plain)
    ks = [f"__k{i}" for i in range(len(keys))]
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
             .select(*[F.col(k).alias(a) for k, a in zip(keys, ks)], F.lit(True).alias("__hot")))
    if hot.isEmpty():
        return shifted(df, plain)
    # Without keys the whole relation is hot, and there is nothing to look up.
    tagged = df.join(hot, null_safe_on(df, hot, keys, ks), "left").drop(*ks) if keys else df.withColumn("__hot", F.lit(True))
    few = shifted(tagged.filter(F.col("__hot").isNull()).drop("__hot"), plain)
    ranged = _ranged(tagged.filter(F.col("__hot")).drop("__hot"), keys, order_cols, num_partitions or _shuffle_partitions(df))
    reach = max(abs(k) for _, k in shifts.values())
    local = Window.partitionBy(*keys, "__pid")
    ranged = shifted(ranged.withColumns({"__at": F.row_number().over(local.orderBy(*order_cols)), "__of": F.count(F.lit(1)).over(local)}),
                     local.orderBy(*order_cols))
    border = (F.col("__at") <= reach) | (F.col("__at") > F.col("__of") - reach)
    inner = ranged.filter(~border)
    edge = ranged.filter(border).withColumnsRenamed({n: f"__local_{n}" for n in shifts})
    edge = shifted(edge, Window.partitionBy(*keys).orderBy("__pid", *order_cols))
    # Where the row n places on lies in the same range, the local value is the right one.
    here = lambda k: (F.col("__at") + k <= F.col("__of")) if k >= 0 else (F.col("__at") + k >= 1)
    edge = edge.withColumns({n: F.when(here(k), F.col(f"__local_{n}")).otherwise(F.col(n)) for n, (_, k) in shifts.items()})
    return few.unionByName(inner.unionByName(edge.drop(*[f"__local_{n}" for n in shifts])).drop("__pid", "__at", "__of"))


def _ranged(df: DataFrame, keys: list[str], order_cols: list[Column], n: int) -> DataFrame:
    """Rows in ranges of (keys, order) with ``__pid``, the number of their range.

    The range bounds are sampled from the data; reading the partition ids back
    from one written copy keeps everything computed from them consistent (and
    survives lost executors)."""
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *order_cols)
    return reliable_checkpoint(ranged.withColumn("__pid", F.spark_partition_id()))


def dense_rank_table(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False,
                     name: str = "dense_rank", hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """The (keys, value) -> rank table behind ``dense_rank_by``, to be joined by
    the caller (so the ranks can come from a different, cheaper relation)."""
    keys = list(keys)
    pairs = df.select(*keys, value).distinct()
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    if keys:
        return row_number_by(pairs, keys, [order], name=name, hot_rows=hot_rows)
    return _global_row_number(pairs, order, name, hot_rows)


def dense_rank_by(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False,
                  name: str = "dense_rank", hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY keys ORDER BY value)``: rank the distinct
    (keys, value) pairs, then join back.  A key's work is bounded by its number
    of distinct values, not its rows; with no keys it is the global dense rank,
    which beyond ``hot_rows`` distinct values avoids a single-partition window.
    ``hot_rows=None``: the distinct values are bounded by construction."""
    keys = list(keys)
    pairs = df.select(*keys, value).distinct()
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    ranked = row_number_by(pairs, keys, [order], name="__dr", hot_rows=hot_rows) if keys else \
        _global_row_number(pairs, order, "__dr", hot_rows)
    ranked = ranked.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                           F.col(value).alias("__v"), F.col("__dr").alias(name))
    on = null_safe_on(df, ranked, keys + [value],
                      [f"__k{i}" for i in range(len(keys))] + ["__v"])
    return df.join(ranked, on, "left").drop("__v", *[f"__k{i}" for i in range(len(keys))])


def _global_row_number(df: DataFrame, order: Column, name: str, hot_rows: int | None) -> DataFrame:
    """Row number over the whole relation: one group, so beyond ``hot_rows``
    rows it takes the range-split path instead of a single-partition window."""
    df = df.withColumn("__g", F.lit(0))
    return row_number_by(df, ["__g"], [order], name=name, hot_rows=hot_rows).drop("__g")


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Exactly one row of each group: ``row_number() OVER (PARTITION BY keys ORDER
    BY order_col) = 1`` with NULL first and, among equal values, the row that is
    smallest in all its columns.

    One ``groupBy`` (map-side combined) carries the whole row in the minimum of a
    struct; no window and no self-join.  NULL keys form a group.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.col(order_col).alias("__order"), *[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.min(row).alias("__row"))
    return out.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: Column,
                name: str, hot_rows: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """SQL default frame: RANGE UNBOUNDED PRECEDING, so tied order values share
    a total (never ROWS).

    ``hot_rows=None``: groups are bounded by construction (a plain window).  Otherwise
    the rows of a hotter group are first summed by (group, order) -- peers share
    their total, so a tie never lies across a border -- and range-partitioned on
    those; a running sum inside each range is shifted by the totals of the group's
    earlier ranges, and joined back to the rows.
    """
    partition, order = list(partition), list(order)
    w = (Window.partitionBy(*partition).orderBy(*order)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    if hot_rows is None:
        return df.withColumn(name, F.sum(value).over(w))
    ks = [f"__k{i}" for i in range(len(partition))]
    hot = (df.groupBy(*partition).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
             .select(*[F.col(k).alias(a) for k, a in zip(partition, ks)], F.lit(True).alias("__hot")))
    if hot.isEmpty():
        return df.withColumn(name, F.sum(value).over(w))
    tagged = df.withColumn("__value", value)
    tagged = tagged.join(hot, null_safe_on(tagged, hot, partition, ks), "left").drop(*ks) if partition else tagged.withColumn("__hot", F.lit(True))
    few = tagged.filter(F.col("__hot").isNull()).withColumn(name, F.sum("__value").over(w))
    rows = tagged.filter(F.col("__hot"))
    # Peers as one row; a group of NULLs only has no sum, as in the window.
    peers = rows.groupBy(*dict.fromkeys([*partition, *order])).agg(F.sum("__value").alias("__sum"))
    ranged = _ranged(peers, partition, [F.col(o) for o in order], num_partitions or _shuffle_partitions(df))
    local = Window.partitionBy(*partition, "__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = ranged.withColumn("__in", F.sum("__sum").over(local))
    # A row a (group, range): as many as there are ranges, and one more a group.
    totals = ranged.groupBy(*partition, "__pid").agg(F.sum("__sum").alias("__total"))
    before = Window.partitionBy(*partition).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(a) for k, a in zip(partition, ks)], F.col("__pid").alias("__opid"),
                           F.sum("__total").over(before).alias("__before"))
    on = reduce(Column.__and__, [ranged["__pid"] == totals["__opid"], *([null_safe_on(ranged, totals, partition, ks)] if ks else [])])
    ranged = ranged.join(totals, on)
    total = F.coalesce(F.col("__before") + F.col("__in"), "__before", "__in")
    found = dict.fromkeys([*partition, *order])
    names = [f"__f{i}" for i in range(len(found))]
    sums = ranged.select(*[F.col(c).alias(n) for c, n in zip(found, names)], total.alias(name))
    back = rows.join(sums, null_safe_on(rows, sums, list(found), names), "left").drop(*names)
    return few.unionByName(back).drop("__hot", "__value")
