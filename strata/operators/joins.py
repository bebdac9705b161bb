"""Join operators: size-checked broadcast, membership flags, interval join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound for the explicit row-count check (narrow rows, < 200 bytes each, so a
# broadcast stays well under 100 MB per executor).
BROADCAST_MAX_ROWS = 500_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.  Meant for relations that
    are cached or cheap to recompute (each task still reads up to
    ``max_rows + 1`` rows, so never call it on a large table)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner",
               max_rows: int | None = None) -> DataFrame:
    """Join a side that is usually small (a dimension).

    Without ``max_rows`` no hint is given: Spark checks the size itself, first
    on plan statistics (``spark.sql.autoBroadcastJoinThreshold``) and again at
    run time on the actual map output (AQE), and keeps a sort-merge join (with
    skew splitting) when the side is large.  With ``max_rows`` -- for a cached
    or already computed relation, where counting is cheap -- the side is
    counted and broadcast only under the bound.
    """
    if max_rows is not None and is_small(right, max_rows):
        right = F.broadcast(right)
    return left.join(right, on, how)


def few_rows(df: DataFrame, name: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """A relation that has few rows whatever it is computed from (an aggregate on a
    low-cardinality key): written first, counted, and broadcast only under the
    bound, so the large side of the join is never exchanged.  Beyond the bound the
    written table is joined by shuffle, where AQE splits skewed keys."""
    from strata.sources.sinks import materialise

    table = materialise(df, name)
    return F.broadcast(table) if is_small(table, max_rows) else table


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 right_keys: Sequence[str] | None = None) -> Column:
    right_keys = list(right_keys or keys)
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[r]) for k, r in zip(keys, right_keys)])


def strict_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
              right_keys: Sequence[str] | None = None) -> Column:
    right_keys = list(right_keys or keys)
    return reduce(lambda a, b: a & b,
                  [left[k] == right[r] for k, r in zip(keys, right_keys)])


def join_grouped(left: DataFrame, grouped: DataFrame, keys: Sequence[str], how: str = "inner",
                 grouped_keys: Sequence[str] | None = None) -> DataFrame:
    """Join rows back to a relation grouped on its own keys, so that a hot key is split.

    The output of a ``groupBy`` or ``distinct`` is already laid out by its keys; joined
    on just those keys it gets no exchange of its own, and AQE splits a skewed
    partition only where *both* sides are shuffle stages.  The join therefore also
    asks for equality of a hash of the keys: that layout is a different one, the
    grouped side (one row a key, the small one) is exchanged for the join, and a
    key with a third of the rows is split over tasks, each reading the one row of
    the other side.  Below the broadcast threshold AQE still turns it into a
    broadcast join.

    ``how``: inner, left, left_semi or left_anti.  Keys are compared by equality (a row
    with a NULL key meets nothing).  The grouped side's keys are dropped; its other
    columns are kept, except in semi and anti joins.
    """
    keys, grouped_keys = list(keys), list(grouped_keys or keys)
    names = [f"__g{i}" for i in range(len(keys))]
    side = grouped.select(*[F.col(g).alias(n) for g, n in zip(grouped_keys, names)],
                          *[c for c in grouped.columns if c not in grouped_keys])
    # Hashes agree only between equal types, so both sides are hashed in the type they are compared in.
    kinds = [common_type(left, k, side, n) for k, n in zip(keys, names)]
    hashed = lambda df, cols: F.xxhash64(*[df[c].cast(t) for c, t in zip(cols, kinds)])
    on = strict_on(left, side, keys, names) & (hashed(left, keys) == hashed(side, names))
    out = left.join(side, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names)


def common_type(left: DataFrame, left_key: str, right: DataFrame, right_key: str):
    """The type in which Spark compares the two columns."""
    a, b = left.schema[left_key].dataType, right.schema[right_key].dataType
    if a == b:
        return a
    spark = left.sparkSession
    cast = lambda t: F.lit(None).cast(t)
    return spark.range(0).select(F.coalesce(cast(a), cast(b)).alias("c")).schema["c"].dataType


def membership_flag(df: DataFrame, keys: Sequence[str], members: DataFrame,
                    flag: str, yes: str | None = "Y", no: str | None = "N",
                    member_keys: Sequence[str] | None = None) -> DataFrame:
    """``flag`` = ``yes`` when the row's keys occur in ``members``, else ``no``.

    Expressed as a left join on the *distinct, non-NULL* member keys, so it is a
    hash join (never a nested loop) and cannot fan out.  With yes/no swapped it
    is the NOT IN flag with NULL members ignored.
    """
    keys = list(keys)
    member_keys = list(member_keys or keys)
    m = members.select(*[F.col(mk).alias(f"__m{i}") for i, mk in enumerate(member_keys)])
    m = m.dropna().distinct().withColumn("__hit", F.lit(True))
    out = join_grouped(df, m, keys, "left", [f"__m{i}" for i in range(len(keys))])
    yes_c = F.lit(yes).cast("string")
    no_c = F.lit(no).cast("string")
    out = out.withColumn(flag, F.when(F.col("__hit"), yes_c).otherwise(no_c))
    return out.drop("__hit")


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], point: Column,
                  start: Column, end: Column, how: str = "left",
                  right_keys: Sequence[str] | None = None) -> DataFrame:
    """Equi-join on ``keys`` with ``start <= point <= end`` as a residual.

    The equality keys make it a hash / sort-merge join; the range is checked per
    matched pair, so the cost grows with matches per key, not with a cross
    product.
    """
    cond = strict_on(left, right, keys, right_keys) & point.between(start, end)
    return left.join(right, cond, how)


def binned_interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, start: str, end: str,
                         width: int, keep: str = "inner", interval_keys: Sequence[str] | None = None,
                         interval_id: str | None = None) -> DataFrame:
    """``start <= point <= end`` among equal ``keys``, for keys that may hold a third of all rows.

    ``interval_join`` compares every point of a key with every interval of it.  Here
    time (seconds of a date or timestamp, or a plain number) is cut into bins of
    ``width``: an interval is copied into each bin it touches, a point lies in one, and
    the join is on (key, bin), so a hot key is spread over its bins and only pairs of
    one bin are compared.  The cost is linear in points, bins touched and matches
    if ``width`` is about the usual length of an interval.  A pair meets once, in the
    point's bin.

    ``keep``: ``inner``; ``points`` (also points without an interval); ``intervals`` (also
    intervals without a point, which needs ``interval_id``, a column that is unique
    and not NULL in ``intervals``).  Intervals with a NULL end or that end before they begin,
    and NULL points, match nothing.  Column names of the two sides must differ.
    """
    if keep not in ("inner", "points", "intervals") or keep == "intervals" and not interval_id:
        raise ValueError("keep is inner, points or intervals (with interval_id)")
    keys, interval_keys = list(keys), list(interval_keys or keys)
    bin_of = lambda df, c: F.floor(_axis(df, c) / F.lit(width)).cast("long")
    names = [f"__i{i}" for i in range(len(keys))]
    p = points.withColumn("__bin", bin_of(points, point))
    touched = F.when(F.col(start) <= F.col(end), F.sequence(bin_of(intervals, start), bin_of(intervals, end)))
    cut = intervals.withColumn("__ibin", F.explode(touched)).withColumnsRenamed(dict(zip(interval_keys, names)))
    on = strict_on(p, cut, keys, names) & (p["__bin"] == cut["__ibin"]) & p[point].between(cut[start], cut[end])
    out = p.join(cut, on, "left" if keep == "points" else "inner")
    # The intervals' keys stay where their names are their own.
    own = [(n, k) for n, k in zip(names, interval_keys) if k not in points.columns]
    out = out.withColumnsRenamed(dict(own)).drop("__bin", "__ibin", *names)
    if keep == "intervals":
        met = out.select(F.col(interval_id).alias("__met")).distinct()
        alone = join_grouped(intervals, met, [interval_id], "left_anti", ["__met"])
        out = out.unionByName(alone, allowMissingColumns=True)
    return out


def _axis(df: DataFrame, column: str) -> Column:
    """A date or timestamp in seconds (of the session's time zone, as the comparison), or the number itself."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "date" or kind.startswith("timestamp"):
        return F.unix_seconds(F.col(column).cast("timestamp"))
    return F.col(column)
