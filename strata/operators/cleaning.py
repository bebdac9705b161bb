"""Cleaning steps: the reference's in-place UPDATE/DELETE/ALTER statements
re-expressed as pure DataFrame -> DataFrame transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import join_grouped


def sentinel_to_null(df: DataFrame, col: str, sentinel: str = "NULL") -> DataFrame:
    """``UPDATE t SET c = NULL WHERE c = 'NULL'`` under a collation that ignores case."""
    return df.withColumn(col, F.when(F.lower(F.col(col)) != F.lit(sentinel.lower()), F.col(col)))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``UPDATE t SET c = 0 WHERE c IS NULL`` for several columns at once."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols})


def fill_from_group(df: DataFrame, group: Sequence[str], col: str) -> DataFrame:
    """Fill NULLs of ``col`` from another row of the same group.

    The reference's UPDATE ... FROM self-join takes an arbitrary donor; here the
    donor is the group's minimum (deterministic).  A ``groupBy`` with map-side
    combine finds donors, a join brings them back: no all-pairs self-join and no
    group gathered in one task.  The groups are compared by equality, as there: a
    row without a group stays as it is.
    """
    group = list(group)
    donors = (df.filter(F.col(col).isNotNull())
                .groupBy(*group).agg(F.min(col).alias("__donor")))
    out = join_grouped(df, donors, group, "left")
    return out.withColumn(col, F.coalesce(F.col(col), F.col("__donor"))).drop("__donor")


def conflicting_donors(df: DataFrame, group: Sequence[str], col: str) -> DataFrame:
    """Groups whose non-NULL values of ``col`` disagree (where the reference's
    choice of donor was arbitrary)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(*group)
              .agg(F.count_distinct(col).alias("n_values"))
              .filter(F.col("n_values") > 1))


def recode(col: Column | str, mapping: Mapping[str, str], default: Column | str | None = None,
           any_case: bool = False) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``; ``default=None`` keeps NULL,
    pass the column itself to keep unlisted values.  ``any_case``: compare as a
    collation that ignores case does."""
    c = F.col(col) if isinstance(col, str) else col
    if any_case:
        c, mapping = F.lower(c), {k.lower(): v for k, v in mapping.items()}
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    if default is None:
        return out
    d = F.col(default) if isinstance(default, str) else default
    return out.otherwise(d)


def repeated_values(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` held by more than one row (a map-side-combined count).

    With ``col`` a hash of a long text, only rows under a repeated hash can be
    duplicates, so whole texts need comparing (and shuffling) only there.
    """
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
              .filter(F.col("__n") > 1).select(col))
