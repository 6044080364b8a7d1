"""Sinks: CSV with a header (S5) and partitioned Parquet.

``single_file=True`` funnels every row through one task; use it only for
small aggregated results. Row-level tables are written in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, rows_per_file: int | None = None) -> None:
    writer = df.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
