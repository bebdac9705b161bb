"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_key(k: Column | str) -> Column:
    """``to_date(k, 'yyyymmdd')`` for an int or string date key."""
    return F.to_date(_c(k).cast("string"), "yyyyMMdd")


def month_abbrev(d: Column | str) -> Column:
    """Oracle ``to_char(d, 'MON')``: upper-case English month abbreviation."""
    return F.upper(F.date_format(_c(d), "MMM"))


def year_diff(as_of: dt.date | Column, d: Column | str) -> Column:
    """``YEAR(as_of) - YEAR(d)``: age by calendar year, birthdays ignored."""
    a = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return F.year(a) - F.year(_c(d))


def elapsed_years(end: Column | str, start: Column | str, places: int = 2) -> Column:
    """``round((end - start) / 365.25, places)`` in double arithmetic."""
    return F.round(F.datediff(_c(end), _c(start)).cast("double") / F.lit(365.25), places)


def as_of_literal(as_of: dt.date | dt.datetime) -> Column:
    """The run's reproducible stand-in for ``sysdate`` / ``GETDATE()``."""
    return F.lit(as_of)
