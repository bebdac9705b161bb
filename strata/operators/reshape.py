"""Pivot with a fixed value list, rollups with a labelled total, template grains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_fixed(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
                value: Column, names: Sequence[str] | None = None,
                agg=F.sum) -> DataFrame:
    """``PIVOT (agg(value) FOR pivot_col IN (values))``.

    With the value list given, each output column is ``agg(value)`` over the
    rows of its value: one hash aggregate, map-side combined, one exchange of
    one row per key per task.  (``DataFrame.pivot`` plans a (key, value)
    aggregate and a second exchange.)  ``agg`` must ignore NULLs, so a value
    with no rows gives NULL as in SQL; values outside the list are dropped.
    """
    names = list(names or values)
    pc = F.col(pivot_col)
    return df.groupBy(*keys).agg(*[agg(F.when(pc == v, value)).alias(n) for v, n in zip(values, names)])


def partial_rollup(df: DataFrame, fixed: Sequence[str], rolled: str, aggs: dict[str, Column],
                   total_label: str = "All", null_label: str | None = "Unknown") -> DataFrame:
    """``GROUP BY fixed..., ROLLUP(rolled)``: one row per (fixed, rolled) plus a
    total row per ``fixed`` with ``rolled`` labelled ``total_label``.

    The total is told apart with ``grouping()``, so a real NULL value of
    ``rolled`` is not mislabelled (it becomes ``null_label``).
    """
    fixed = list(fixed)
    g = df.groupingSets([fixed + [rolled], fixed], *fixed, rolled).agg(
        F.grouping(rolled).alias("__g"), *[c.alias(n) for n, c in aggs.items()])
    label = F.when(F.col("__g") == 1, F.lit(total_label))
    label = label.when(F.col(rolled).isNull(), F.lit(null_label)) if null_label is not None else label
    label = label.otherwise(F.col(rolled))
    return g.select(*fixed, label.alias(rolled), *aggs.keys())


def rollup_counts(df: DataFrame, fixed: Sequence[str], rolled: str, counts: Mapping[str, Mapping[str, Column | None]],
                  sums: Mapping[str, Column], total_label: str = "All", null_label: str = "Unknown") -> DataFrame:
    """``GROUP BY fixed..., ROLLUP(rolled)`` with conditional distinct counts and sums, on
    states that merge.

    ``counts``: {entity column: {name: condition or None}}, the number of distinct
    non-NULL entities with a row that meets the condition.  The rows of an entity are
    reduced to one row of flags per (fixed, rolled, entity); a group's counts are the
    sums of its flags, and the total's flags are those of the entity's rows merged
    over ``rolled``.  So however many counts there are, no row is copied for them
    or for the total (``grouping sets`` with k distinct counts copies each row 2 (k + 1)
    times), and a hot group is spread over its entities.  ``sums`` travel with the
    first entity and are summed again.  ``df`` is read once an entity column.
    """
    fixed, named = list(fixed), list(sums)
    parts = []
    for i, (entity, flags) in enumerate(counts.items()):
        there = F.col(entity).isNotNull()
        flag = {n: F.max((there if c is None else there & F.coalesce(c, F.lit(False))).cast("int")) for n, c in flags.items()}
        add = {n: F.sum(c) for n, c in sums.items()} if not i else {}
        one = df.groupBy(*fixed, rolled, entity).agg(*[c.alias(n) for n, c in {**flag, **add}.items()])
        again = [*[F.max(n).alias(n) for n in flags], *[F.sum(n).alias(n) for n in add]]
        whole = one.groupBy(*fixed, entity).agg(*again)
        count = [*[F.sum(n).cast("long").alias(n) for n in flags], *[F.sum(n).alias(n) for n in add]]
        label = F.coalesce(F.col(rolled), F.lit(null_label))
        parts.append(one.groupBy(*fixed, rolled).agg(*count).withColumns({"__total": F.when(F.col(rolled).isNull(), 2).otherwise(0), rolled: label}))
        parts.append(whole.groupBy(*fixed).agg(*count).withColumns({rolled: F.lit(total_label), "__total": F.lit(1)}))
    # A row or two a group and entity column: laid on top of each other and grouped once more.
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [*[n for flags in counts.values() for n in flags], *named]
    out = both.groupBy(*fixed, rolled, "__total").agg(*[F.max(n).alias(n) for n in values])
    return out.drop("__total")


def template_grain(parts: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Union of distinct dimension combinations taken from differently named
    columns (``UNION`` of several ``SELECT DISTINCT``)."""
    out = None
    for p in parts:
        p = p.toDF(*names)
        out = p if out is None else out.unionByName(p)
    return out.distinct()
