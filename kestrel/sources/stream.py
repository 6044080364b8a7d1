"""Replayable file streams (the re-aimed socket source, S4).

A file source replays exactly, needs no open port and lets a query be
restarted from its checkpoint after a failure. Files are taken in
modification-time order, ``max_files_per_trigger`` at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_file_stream(spark: SparkSession, path: str, schema: StructType | str,
                     fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
