"""Readers for the four raw inputs in their original layouts, mapped onto
the columns the query functions take (see ``kestrel.plans.fixtures`` for
the same columns derived from the test tables).

CSV columns are read as text with a header and parsed leniently: one pass,
no schema inference, ``8.0`` is a whole number and ``1,234.5`` a number. A
value that still does not parse becomes null instead of failing the job, and
``with_malformed=True`` adds a column that counts such values per row.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.numeric import to_number
from kestrel.sources.csv import TAXI_TIMESTAMP_FORMAT, read_csv
from kestrel.sources.sinks import write_csv

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# Column names of the taxi-trip export.
TAXI_COLUMNS = {
    "trip_start": "Trip Start Timestamp",
    "trip_seconds": "Trip Seconds",
    "trip_miles": "Trip Miles",
    "fare": "Fare",
    "pickup_area": "Pickup Community Area",
    "pickup_lat": "Pickup Centroid Latitude",
    "pickup_lon": "Pickup Centroid Longitude",
    "pickup_tract": "Pickup Census Tract",
    "dropoff_area": "Dropoff Community Area",
    "dropoff_lat": "Dropoff Centroid Latitude",
    "dropoff_lon": "Dropoff Centroid Longitude",
    "dropoff_tract": "Dropoff Census Tract",
}
# ---------------------------------------------------------------------------

MALFORMED = "malformed"
# HDFS log lines start with a date and a time.
LINE_STAMP = r"^(\d{6} \d{6})\b"
LINE_STAMP_FORMAT = "yyMMdd HHmmss"

_TAXI_TYPES = {"trip_seconds": "long", "trip_miles": "double", "fare": "double",
               "pickup_area": "int", "pickup_lat": "double", "pickup_lon": "double",
               "pickup_tract": "long", "dropoff_area": "int", "dropoff_lat": "double",
               "dropoff_lon": "double", "dropoff_tract": "long"}


# --- lenient parsing, with an account of what did not parse ----------------------

def _number(text: Column, dtype: str) -> Column:
    """Text as a number: blanks around it and thousands separators are
    accepted, and whole numbers may be written with a fraction (``8.0``)."""
    bare = F.btrim(text)
    plain = F.when(bare.rlike(r"^[-+]?\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(bare, F.lit(","), F.lit(""))).otherwise(bare)
    if dtype == "double":
        return to_number(plain)
    # Through an exact decimal, so that long codes keep every digit.
    exact = plain.try_cast("decimal(38,9)")
    return F.coalesce(to_number(plain, dtype), F.when(exact == F.floor(exact), exact.try_cast(dtype)))


def _parsed(df: DataFrame, columns: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """``columns`` maps output names to (input name, parsed value; None keeps
    the text). Adds ``malformed``: how many values of the row hold text that
    did not parse."""
    values, bad = [], []
    for name, (source, value) in columns.items():
        text = F.col(f"`{source}`")
        values.append((text if value is None else value).alias(name))
        if value is not None:
            bad.append((value.isNull() & (F.btrim(text) != "")).cast("int"))
    count = reduce(add, [F.coalesce(b, F.lit(0)) for b in bad], F.lit(0))
    return df.select(*values, count.alias(MALFORMED))


def _keep(df: DataFrame, with_malformed: bool) -> DataFrame:
    return df if with_malformed else df.drop(MALFORMED)


def _numbers(types: dict[str, str]) -> dict[str, tuple[str, Column]]:
    return {name: (name, _number(F.col(name), dtype)) for name, dtype in types.items()}


def tweets_csv(spark: SparkSession, path: str, with_malformed: bool = False) -> DataFrame:
    """``(timestamp, longitude, latitude)`` from the tweet CSV."""
    return _keep(_parsed(read_csv(spark, path), _numbers(
        {"timestamp": "long", "longitude": "double", "latitude": "double"})), with_malformed)


def ratings_csv(spark: SparkSession, path: str, with_malformed: bool = False) -> DataFrame:
    """``(userId, movieId, rating, timestamp)`` from the ratings CSV."""
    return _keep(_parsed(read_csv(spark, path), _numbers(
        {"userId": "int", "movieId": "int", "rating": "double", "timestamp": "long"})), with_malformed)


def movies_csv(spark: SparkSession, path: str, with_malformed: bool = False) -> DataFrame:
    """``(movieId, title, genres)`` from the movies CSV."""
    return _keep(_parsed(read_csv(spark, path), {
        **_numbers({"movieId": "int"}), "title": ("title", None), "genres": ("genres", None)}), with_malformed)


def taxi_csv(spark: SparkSession, path: str, with_malformed: bool = False) -> DataFrame:
    """The trip columns ``kestrel.plans.trips`` works on, from the taxi export."""
    text = lambda name: F.col(f"`{TAXI_COLUMNS[name]}`")
    columns = {"trip_start": (TAXI_COLUMNS["trip_start"],
                              F.try_to_timestamp(F.btrim(text("trip_start")), F.lit(TAXI_TIMESTAMP_FORMAT)))}
    columns |= {name: (TAXI_COLUMNS[name], _number(text(name), dtype)) for name, dtype in _TAXI_TYPES.items()}
    return _keep(_parsed(read_csv(spark, path), columns), with_malformed)


def write_plain_csv(df: DataFrame, path: str) -> None:
    """Tweets, ratings or movies in their original layout."""
    write_csv(df, path)


def write_taxi_csv(trips: DataFrame, path: str) -> None:
    """Trip columns in the layout of the taxi export."""
    start = F.date_format("trip_start", TAXI_TIMESTAMP_FORMAT)
    write_csv(trips.select(*[(start if name == "trip_start" else F.col(name)).alias(source)
                             for name, source in TAXI_COLUMNS.items()]), path)


def line_time(value: Column) -> Column:
    """The ``yyMMdd HHmmss`` stamp that an HDFS log line starts with."""
    return F.try_to_timestamp(F.regexp_extract(value, LINE_STAMP, 1), F.lit(LINE_STAMP_FORMAT))


def write_log_lines(lines: DataFrame, path: str, thread: int = 35) -> None:
    """``(value, timestamp)`` lines as HDFS text logs: stamp, thread, line."""
    stamped = F.concat_ws(" ", F.date_format("timestamp", LINE_STAMP_FORMAT), F.lit(str(thread)), F.col("value"))
    lines.select(stamped.alias("value")).write.text(path)


def log_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    event_time: bool = False) -> DataFrame:
    """``(value, timestamp)`` lines streamed from text files.

    By default a line is stamped with its arrival (processing) time, as the
    socket source's ``includeTimestamp`` did; that is one value per
    micro-batch, so replayed files fall into few windows. With ``event_time``
    the stamp in the line counts; lines without one have a null timestamp and
    take no part in windows."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stamp = line_time(F.col("value")) if event_time else F.current_timestamp()
    return reader.load(path).select("value", stamp.alias("timestamp"))
