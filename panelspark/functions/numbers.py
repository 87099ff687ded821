"""Numeric cleaning and derivation expressions (P06, P07, P10, P11,
P17-P22, P34).

Spark runs with ANSI mode on: plain ``cast`` throws on bad text and ``x/0``
throws, so every lenient path uses ``try_cast`` / ``nullif``.  pandas uses
NaN for missing; Spark keeps NULL and NaN apart, so NaN is folded into NULL
wherever a value enters the panel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: numeric sentinels at or below this floor mean "missing".
SENTINEL_FLOOR = -1e8


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col: str | Column) -> Column:
    c = _c(col)
    return F.when(~F.isnan(c), c)


def to_number(col: str | Column) -> Column:
    """Lenient numeric coercion: unparsable text → NULL (never NaN)."""
    return nan_to_null(_c(col).cast("string").try_cast("double"))


def parse_grouped_number(col: str | Column) -> Column:
    """'12,345' → 12345.0; 'nan', '' and junk → NULL."""
    return to_number(F.regexp_replace(_c(col).cast("string"), ",", ""))


def null_sentinel_col(col: str | Column, floor: float = SENTINEL_FLOOR) -> Column:
    """Values at or below ``floor`` (e.g. -666666666) become NULL."""
    c = _c(col)
    return F.when(c > F.lit(floor), c)


def null_infinite_col(col: str | Column) -> Column:
    c = _c(col)
    return F.when(F.abs(c) != F.lit(float("inf")), c)


def share(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero denominator giving NULL."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def rate(num: str | Column, den: str | Column) -> Column:
    """Ratio used for poverty / unemployment / day shares; zero-safe."""
    return share(num, den)


def sum_cols(cols: list[str | Column]) -> Column:
    """Row-wise sum that skips missing values (all missing → 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def sum_cols_strict(cols: list[str | Column]) -> Column:
    """Row-wise sum where any missing value makes the result missing."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def complement(col: str | Column) -> Column:
    return F.lit(1.0) - _c(col)


def clip(col: str | Column, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` skip NULL)."""
    c = _c(col)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def round_half_even(col: str | Column, digits: int) -> Column:
    """pandas/NumPy rounding (banker's); Spark ``round`` is half-up."""
    return F.bround(_c(col), digits)
