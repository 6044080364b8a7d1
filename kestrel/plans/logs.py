"""HDFS log-line analysis over ``(value, timestamp)`` lines.

The same functions serve a static table and a stream: they use only
operators Structured Streaming supports on unbounded input. Ordering by a
measure is applied separately (``ranked_hosts``), since a stream may sort
only in complete output mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import (LOG_BLOCK, LOG_DATANODE, LOG_INFO, log_host, log_size,
                                    log_trailing_number)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
WATERMARK_DELAY = "5 seconds"
WINDOW_LENGTH = "60 seconds"
WINDOW_SLIDE = "30 seconds"
PATTERN_TRIGGER = "15 seconds"
# ---------------------------------------------------------------------------


def with_watermark(lines: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event-time watermark on ``timestamp`` (ST1); a no-op for static input."""
    return lines.withWatermark("timestamp", delay)


def datanode_windows(lines: DataFrame, length: str = WINDOW_LENGTH,
                     slide: str = WINDOW_SLIDE) -> DataFrame:
    """Q4: lines mentioning ``DataNode`` per sliding event-time window (ST2).
    Each line falls in length/slide windows. The window struct is flattened."""
    counted = (lines.filter(F.col("value").contains(LOG_DATANODE))
               .groupBy(F.window("timestamp", length, slide))
               .agg(F.count(F.lit(1)).alias("datanode_count")))
    return counted.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), "datanode_count")


def bytes_per_host(lines: DataFrame, strict_size: bool = False) -> DataFrame:
    """Q5: sum of each line's trailing number per source host (ST3).

    Lines without a ``src:`` host group under ``''``; the trailing number
    may be a port rather than a size (a line ending ``:50010`` adds 50010),
    as in the reference; lines without one add nothing. ``strict_size=True``
    reads the number after ``size `` instead."""
    size = log_size("value") if strict_size else log_trailing_number("value")
    return (lines.select(log_host("value").alias("hostname"), size.alias("bytes"))
            .groupBy("hostname").agg(F.sum("bytes").alias("total_bytes")))


def info_block_counts(lines: DataFrame) -> DataFrame:
    """Q6: lines containing both ``INFO`` and ``blk_`` per source host (ST4)."""
    matched = lines.filter(F.col("value").contains(LOG_INFO) & F.col("value").contains(LOG_BLOCK))
    return matched.select(log_host("value").alias("hostname")).groupBy("hostname").count()


def ranked_hosts(per_host: DataFrame, measure: str = "total_bytes") -> DataFrame:
    """Hosts by a measure, largest first, ties by host name."""
    return per_host.orderBy(F.col(measure).desc(), F.col("hostname").asc())
