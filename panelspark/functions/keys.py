"""Entity-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zfill(col: str | Column, width: int) -> Column:
    """Left-pad with zeros to ``width`` like ``str.zfill``.

    Bare ``lpad`` truncates values longer than ``width``; ``zfill`` keeps
    them, so longer values pass through unchanged.  Numeric input is cast
    to text first.
    """
    c = _c(col).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def composite_key(*parts: tuple[str | Column, int]) -> Column:
    """Concatenate zero-padded parts, e.g. state(2) ‖ county(3) → geoid."""
    return F.concat(*[zfill(c, w) for c, w in parts])


def right_chars(col: str | Column, n: int) -> Column:
    """Last ``n`` characters (``s.str[-n:]``)."""
    return F.substring(_c(col), -n, n)


def starts_with(col: str | Column, prefix: str) -> Column:
    """Prefix predicate where a missing value is false, not NULL."""
    return F.coalesce(_c(col).startswith(prefix), F.lit(False))
