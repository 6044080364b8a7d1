"""Calendar functions.

All return Columns built from Spark's own date/time expressions, so they stay
inside whole-stage codegen. Results that depend on a time zone follow the
session zone, which ``kestrel.session.prepare`` pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# The tweets' packed timestamps.
PACKED_FORMAT = "yyyyMMddHHmmss"
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def packed_to_timestamp(col: Column | str, fmt: str = PACKED_FORMAT) -> Column:
    """14-digit ``yyyyMMddHHmmss`` number or text to a timestamp (F1).

    ``try_to_timestamp`` gives null for text that does not parse, where the
    plain form fails the whole query under ANSI mode."""
    return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt))


def epoch_to_timestamp(col: Column | str) -> Column:
    """Epoch seconds to a timestamp (F2; ``from_unixtime`` gives text)."""
    return F.timestamp_seconds(_c(col))


def date_text(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def day_name(col: Column | str) -> Column:
    """Full English day name, e.g. ``Monday``."""
    return F.date_format(_c(col), "EEEE")


def year_text(col: Column | str) -> Column:
    """Four-digit year as text."""
    return F.date_format(_c(col), "yyyy")


def month_text(col: Column | str) -> Column:
    """Two-digit month as text."""
    return F.date_format(_c(col), "MM")


def is_weekday(col: Column | str) -> Column:
    """Monday to Friday; ``dayofweek`` counts Sunday as 1."""
    return F.dayofweek(_c(col)).between(2, 6)


def hour_of_day(col: Column | str) -> Column:
    """Hour 0-23 (F8)."""
    return F.hour(_c(col))
