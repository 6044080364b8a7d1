"""The corpus pipeline: quality rules, line deduplication, near-duplicate
removal, mixing of sources and packing into sequences.

Every stage works on all that its predecessor kept, its result is written as
Parquet to the shared folder and read again as the next one's documents, so a
lost executor costs at most the running stage. All stages but the last return
the columns of ``documents``.

Defined results: a null or empty text fails the quality rules; a document that
line deduplication empties stays with an empty text and takes no part in the
later matching; repeated rows are judged alone by the rules and lines, and one
document of each group of near-duplicates stays; an empty table passes every
stage as an empty table; extra columns are carried along until packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm.line_dedup import drop_lines
from kestrel.llm.mixing import mix_documents
from kestrel.llm.near_dedup import drop_near_duplicates
from kestrel.llm.packing import pack_documents
from kestrel.llm.quality_rules import filter_documents
from kestrel.session import materialize, prepare
from kestrel.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rule table."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen earlier in the corpus."""
    return drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at similarity 0.8 on five-word shingles."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per copy that the mix takes."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Near-duplicate components and best-fit packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
