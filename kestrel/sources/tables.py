"""The Parquet tables every query reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan one table. Naming the columns keeps the Parquet ReadSchema to
    what the query uses (Catalyst prunes anyway; this makes it explicit)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def stream_glob(sf_dir: str, name: str) -> str:
    """A path pattern matching exactly the file(s) of one table, for a file
    stream source (which needs a directory or a pattern, not a bare file)."""
    return f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
