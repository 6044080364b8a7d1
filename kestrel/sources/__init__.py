"""Readers and writers: Parquet test tables, CSV with explicit schemas,
object-store addressing, CSV/Parquet sinks and replayable file streams."""

from kestrel.sources.tables import TABLES, read_table, table_path
from kestrel.sources.csv import read_csv
from kestrel.sources.objectstore import with_s3a
from kestrel.sources.sinks import write_csv, write_parquet
from kestrel.sources.stream import read_file_stream

__all__ = ["TABLES", "read_table", "table_path", "read_csv", "with_s3a",
           "write_csv", "write_parquet", "read_file_stream"]
