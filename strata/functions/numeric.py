"""Numeric expressions: safe ratios, bins with sort keys, money."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(num: Column | str, den: Column | str) -> Column:
    """``num / den * 100`` in double arithmetic; NULL when ``den`` is 0 (ANSI
    mode would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(100.0)


def money(c: Column | str) -> Column:
    """Round to cents as an exact decimal, so sums do not depend on the order
    rows are added in."""
    return F.round(_c(c), 2).cast("decimal(18,2)")


# Wage bins of the program report: fixed values (label, low, high inclusive).
WAGE_BINS = [
    ("$0-25k", 0, 24999),
    ("$25k-50k", 25000, 49999),
    ("$50k-75k", 50000, 74999),
    ("$75k-100k", 75000, 99999),
    ("$100k +", 100000, None),
]
WAGE_BIN_NONE = "None"


def bin_label(x: Column | str, bins: Sequence[tuple[str, float, float | None]] = WAGE_BINS,
              none_label: str = WAGE_BIN_NONE) -> Column:
    """First bin whose inclusive range holds ``x``; ``none_label`` otherwise
    (including NULL and values between bins)."""
    v = _c(x)
    out = None
    for label, lo, hi in bins:
        cond = (v >= lo) if hi is None else v.between(lo, hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(none_label)


def bin_sort_key(label: Column | str, bins: Sequence[tuple[str, float, float | None]] = WAGE_BINS,
                 none_label: str = WAGE_BIN_NONE) -> Column:
    """Sort key 1..n for the bin labels, n+1 for ``none_label``; NULL otherwise."""
    lab = _c(label)
    out = None
    for i, (name, _, _) in enumerate(bins, start=1):
        out = F.when(lab == name, i) if out is None else out.when(lab == name, i)
    return out.when(lab == none_label, len(bins) + 1)
