"""Guarded arithmetic and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimals that averages keep.
MEAN_DIGITS = 9


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """``num / den``, 0.0 when the denominator is 0."""
    d = _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(_c(num) / d)


def percent_of(part: Column | str, total: Column | str) -> Column:
    """``(part / total) * 100`` in that order of operations."""
    return (_c(part) / _c(total)) * 100


def to_number(col: Column | str, dtype: str = "double") -> Column:
    """Lenient numeric cast: text that is not a number becomes null (V6)."""
    return _c(col).try_cast(dtype)


def mean(col: Column | str, digits: int = MEAN_DIGITS) -> Column:
    """``avg`` rounded to ``digits`` decimals, as an aggregate expression.

    The last bits of an average of doubles depend on the order in which
    partial sums arrive; rounding the result (never the inputs) makes equal
    averages equal on every run, so ties in rankings are true ties."""
    return F.round(F.avg(_c(col)), digits)


def mean_of_sums(total: Column | str, n: Column | str, digits: int = MEAN_DIGITS) -> Column:
    """The same average from partial sums and non-null counts that were
    aggregated before; null without rows."""
    return F.round(F.try_divide(F.sum(_c(total)), F.sum(_c(n))), digits)
