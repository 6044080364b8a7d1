"""Column expressions shared by the text operators (built-in functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 256
# The white space of the word rule, x20 and x09-x0D.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-white-space; empty for null."""
    bare = F.btrim(text_or_empty(text), F.lit(WHITE_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, WHITE_SPACE_RUN))


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once: inside a lambda an inlined
    expression would be evaluated again for every element."""
    return F.transform(F.array(value), body)[0]


def small_batches(spark: SparkSession) -> None:
    """Hand Python tasks at most ``BATCH_ROWS`` whole texts (or index shards)
    at a time: a batch is held in the JVM and in the worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
