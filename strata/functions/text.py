"""String expressions (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before_delimiter(s: Column | str, delim: str = ":") -> Column:
    """Text before the first ``delim``; the whole text when absent.  An empty
    result (leading delimiter) becomes NULL, as Oracle treats '' as NULL."""
    return F.nullif(F.substring_index(_c(s), delim, 1), F.lit(""))


def split_first(s: Column | str, delim: str = ",") -> tuple[Column, Column]:
    """Split at the first ``delim``: (before, after), trimmed.  With no delimiter
    both parts are NULL (the reference's SUBSTRING/CHARINDEX raises there)."""
    c = _c(s)
    pos = F.locate(delim, c)
    has = pos > 0
    before = F.when(has, F.trim(F.substr(c, F.lit(1), pos - 1)))
    after = F.when(has, F.trim(F.substr(c, pos + len(delim))))
    return before, after


def part_from_right(s: Column | str, n: int, delim: str = ",") -> Column:
    """The n-th part counting from the right (1 = last), trimmed; NULL when the
    text has fewer parts (PARSENAME(REPLACE(s, ',', '.'), n)).  The delimiter is
    taken literally."""
    quoted = "\\Q" + delim.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.split(_c(s), quoted)
    return F.trim(F.try_element_at(parts, F.lit(-n)))


def concat_null_as_empty(*cols: Column | str) -> Column:
    """Oracle ``a || b``: NULL operands count as empty text."""
    return F.concat_ws("", *[_c(c) for c in cols])
