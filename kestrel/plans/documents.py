"""Hashtag frequency over document texts (R1, promised by the reference's
README; its code never extracts hashtags)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import hashtags
from kestrel.operators import aggregate as agg


def hashtag_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences of each hashtag (without '#', case kept) over whole texts.
    Each text is scanned once, in the task that reads it; only (tag, count)
    partials cross the shuffle."""
    tags = docs.select(F.explode(hashtags(text_col)).alias("hashtag"))
    return agg.group_count(tags, "hashtag")
