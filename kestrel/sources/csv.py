"""CSV scans with a header row (S1) and a timestamp pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# The 12-hour pattern the taxi export writes its timestamps in.
TAXI_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"
# ---------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer_schema: bool = False,
             timestamp_format: str | None = None) -> DataFrame:
    """Read CSV. Pass ``schema`` in production: inference is an extra full
    pass over the input and guesses types per file."""
    reader = spark.read.option("header", header)
    if timestamp_format:
        # The pattern applies to zoned and wall-clock (NTZ) timestamp columns.
        reader = (reader.option("timestampFormat", timestamp_format)
                  .option("timestampNTZFormat", timestamp_format))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)
