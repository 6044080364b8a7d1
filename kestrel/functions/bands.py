"""Banding rules (F10, F11) and the fixed category values they produce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# Time of day by hour, bounds inclusive; any other hour (or null) is Night.
TIME_OF_DAY_BANDS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 21))
TIME_OF_DAY_DEFAULT = "Night"
TIME_OF_DAY_ORDER = ("Morning", "Afternoon", "Evening", "Night")
# Ratings: valid from 1 to 5 inclusive; below 3 Low, 3 up to (not incl.) 5 Medium, 5 High.
RATING_MIN, RATING_MAX = 1, 5
RATING_LOW, RATING_MEDIUM, RATING_HIGH = "Low", "Medium", "High"
RATING_BANDS = ((RATING_LOW, float("-inf")), (RATING_MEDIUM, 3.0), (RATING_HIGH, 5.0))
# Half of the year by month number: 1-6 early, anything else late.
EARLY_YEAR, LATE_YEAR = "Early Year", "Late Year"
HALF_YEAR_ORDER = (EARLY_YEAR, LATE_YEAR)
# Raters: strictly more than 50 ratings is frequent.
FREQUENT_RATER_MIN_EXCLUSIVE = 50
FREQUENT_RATERS, INFREQUENT_RATERS = "Frequent Raters", "Infrequent Raters"
# Valid movie genres.
MOVIE_GENRES = ("Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
                "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical",
                "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western")
# Weekday order used when plotting day shares.
WEEKDAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def time_of_day(hour: Column | str,
                bands: Sequence[tuple[str, int, int]] = TIME_OF_DAY_BANDS,
                default: str = TIME_OF_DAY_DEFAULT) -> Column:
    """Band an hour; a null hour lands in the default band."""
    h = _c(hour)
    expr = None
    for name, lo, hi in bands:
        cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(default)


def is_valid_rating(rating: Column | str) -> Column:
    r = _c(rating)
    return (r >= RATING_MIN) & (r <= RATING_MAX)


def rating_band(rating: Column | str,
                bands: Sequence[tuple[str, float]] = RATING_BANDS, most: float = RATING_MAX) -> Column:
    """The band with the highest start that the rating reaches (F11); null for
    a null rating, NaN or one above ``most``."""
    r = _c(rating)
    reached = [F.when(r >= start, name) for name, start in sorted(bands, key=lambda b: b[1], reverse=True)]
    return F.when(r <= most, F.coalesce(*reached))


def half_year(month_text: Column | str) -> Column:
    """Early Year for months 1-6; Late Year otherwise, null month included."""
    return F.when(_c(month_text).try_cast("int") <= 6, EARLY_YEAR).otherwise(LATE_YEAR)


def rater_class(rating_count: Column | str,
                threshold: int = FREQUENT_RATER_MIN_EXCLUSIVE) -> Column:
    return F.when(_c(rating_count) > threshold, FREQUENT_RATERS).otherwise(INFREQUENT_RATERS)
