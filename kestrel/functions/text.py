"""Text functions: key building, splitting, log-line captures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# Source host in an HDFS log line: the address after "src: /", up to the colon.
LOG_HOST_PATTERN = r"src:\s*/([\d\.]+):"
# The integer at the end of a line, trailing blanks allowed (read as bytes).
LOG_TRAILING_NUMBER_PATTERN = r"(\d+)\s*$"
# Substrings the log queries filter on (case-sensitive).
LOG_DATANODE = "DataNode"
LOG_INFO = "INFO"
LOG_BLOCK = "blk_"
# Genre separator in a movie's genres field (a regex: the pipe is escaped).
GENRE_SEPARATOR = r"\|"
# Hashtag: '#' followed by word characters.
HASHTAG_PATTERN = r"#(\w+)"
# ---------------------------------------------------------------------------

# Stricter byte capture (our option, not the reference's rule): the number
# after "size ", so a trailing port is not read as a byte count.
LOG_SIZE_PATTERN = r"size (\d+)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def location_key(longitude: Column | str, latitude: Column | str) -> Column:
    """``"lon,lat"`` text; null when either part is null."""
    return F.concat(_c(longitude), F.lit(","), _c(latitude))


def split_to_array(col: Column | str, pattern: str = GENRE_SEPARATOR) -> Column:
    """Split on a regex (F12); feed to ``F.explode`` for one row per part."""
    return F.split(_c(col), pattern)


def log_host(line: Column | str) -> Column:
    """Source host of a log line; ``''`` when the line has none."""
    return F.regexp_extract(_c(line), LOG_HOST_PATTERN, 1)


def log_trailing_number(line: Column | str) -> Column:
    """Trailing integer of a line as a long.

    Lines with no trailing number give ``''``; ``try_cast`` turns that into
    null where a plain cast would fail the query under ANSI mode."""
    return F.regexp_extract(_c(line), LOG_TRAILING_NUMBER_PATTERN, 1).try_cast("long")


def log_size(line: Column | str) -> Column:
    """The number after ``size`` in a line as a long; null when absent."""
    return F.regexp_extract(_c(line), LOG_SIZE_PATTERN, 1).try_cast("long")


def hashtags(text: Column | str) -> Column:
    """All hashtags of a text, without the '#', as an array."""
    return F.regexp_extract_all(_c(text), F.lit(HASHTAG_PATTERN), 1)
