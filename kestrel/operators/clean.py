"""Row cleaning and the map-point preparation of the notebooks
(P11, P16-P18, V2, V3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numeric import to_number

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# Continental-US view box: longitude -125..-66, latitude 24..50.
US_BOUNDING_BOX = (-125.0, -66.0, 24.0, 50.0)
# ---------------------------------------------------------------------------


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows with a value in every listed column."""
    return df.dropna(how="any", subset=list(columns))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Keep rows without any null."""
    return df.dropna(how="any")


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column."""
    return df.fillna(dict(values))


def parse_location(df: DataFrame, key: str = "location",
                   count_col: str = "count") -> DataFrame:
    """``"lon,lat"`` text back to numbers (V2, V6): drops a repeated header
    row and any row whose parts or count do not parse."""
    parts = F.split(F.col(key), ",")
    return (df.filter(F.lower(F.col(key)) != key.lower())
            .select(to_number(F.get(parts, 0)).alias("longitude"),
                    to_number(F.get(parts, 1)).alias("latitude"),
                    to_number(count_col, "long").alias(count_col))
            .dropna(subset=["longitude", "latitude", count_col]))


def within_box(df: DataFrame, box: tuple[float, float, float, float] = US_BOUNDING_BOX,
               lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Points inside a longitude/latitude box, edges included (V3)."""
    lon_lo, lon_hi, lat_lo, lat_hi = box
    return df.filter(F.col(lon).between(lon_lo, lon_hi) & F.col(lat).between(lat_lo, lat_hi))
