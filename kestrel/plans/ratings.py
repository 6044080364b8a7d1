"""Movie-rating profile.

Inputs: ratings ``(userId, movieId, rating, timestamp)`` with epoch-second
timestamps, and movies ``(movieId, title, genres)`` with pipe-joined genres.

Per-movie questions aggregate the ratings by ``movieId`` *before* joining
the movie table: the join then sees one row per movie instead of one per
rating, and a movie holding a third of all ratings is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import bands, timefn
from kestrel.functions.numeric import mean_of_sums
from kestrel.functions.text import split_to_array
from kestrel.operators import aggregate as agg


def unique_users(ratings: DataFrame) -> DataFrame:
    """Q1: number of distinct users."""
    return agg.distinct_count(ratings, "userId", "unique_users")


def with_rating_date(ratings: DataFrame) -> DataFrame:
    """Q2: add ``rating_date`` (yyyy-MM-dd). The reference's heading speaks
    of a filter, but none is applied."""
    return ratings.withColumn("rating_date",
                              timefn.date_text(timefn.epoch_to_timestamp("timestamp")))


def rating_bands(ratings: DataFrame) -> DataFrame:
    """Q3: valid ratings (1-5) per Low / Medium / High band."""
    valid = ratings.filter(bands.is_valid_rating("rating"))
    return agg.group_count(valid.select(bands.rating_band("rating").alias("rating_category")),
                           "rating_category")


def rating_band_shares(ratings: DataFrame) -> DataFrame:
    """Notebook pie step: Q3 with each band's share rounded to 0.1% (V5)."""
    shares = agg.with_share_of_total(rating_bands(ratings), name="share")
    return shares.withColumn("share", F.round("share", 1))


def with_year_month(ratings: DataFrame) -> DataFrame:
    t = timefn.epoch_to_timestamp("timestamp")
    return (ratings.withColumn("year", timefn.year_text(t))
            .withColumn("month", timefn.month_text(t))
            .withColumn("time_of_year", bands.half_year("month")))


def half_year_counts(ratings: DataFrame) -> DataFrame:
    """Q4: ratings per half of the year."""
    return agg.group_count(with_year_month(ratings).select("time_of_year"), "time_of_year")


def movie_totals(ratings: DataFrame) -> DataFrame:
    """Per movie: rating sum, non-null rating count and row count."""
    return ratings.groupBy("movieId").agg(
        F.sum("rating").alias("_rating_sum"),
        F.count("rating").alias("_rating_n"),
        F.count(F.lit(1)).alias("_rows"))


def _mean_rating() -> Column:
    """avg(rating) from the per-movie sums and counts."""
    return mean_of_sums("_rating_sum", "_rating_n")


def movie_genres(movies: DataFrame, valid: Sequence[str] = bands.MOVIE_GENRES) -> DataFrame:
    """One row per (movie, listed genre) for genres in ``valid``."""
    return (movies.select("movieId", F.explode(split_to_array("genres")).alias("genre"))
            .filter(F.col("genre").isin(list(valid))))


def genre_counts(ratings: DataFrame, movies: DataFrame,
                 valid: Sequence[str] = bands.MOVIE_GENRES) -> DataFrame:
    """Q5: ratings per valid genre; a rating counts once per genre its movie lists."""
    joined = movie_totals(ratings).join(movie_genres(movies, valid), "movieId")
    return joined.groupBy("genre").agg(F.sum("_rows").alias("count"))


def genre_average(ratings: DataFrame, movies: DataFrame,
                  valid: Sequence[str] = bands.MOVIE_GENRES) -> DataFrame:
    """README extra: average rating per valid genre (R2)."""
    joined = movie_totals(ratings).join(movie_genres(movies, valid), "movieId")
    return joined.groupBy("genre").agg(
        _mean_rating().alias("avg_rating"),
        F.sum("_rating_n").alias("rating_count"))


def year_share(ratings: DataFrame) -> DataFrame:
    """Q6: ratings per year with percentage of the total."""
    years = ratings.select(timefn.year_text(timefn.epoch_to_timestamp("timestamp")).alias("year"))
    return agg.with_share_of_total(agg.group_count(years, "year"))


def rated_years(ratings: DataFrame) -> DataFrame:
    """Notebook axis step: distinct non-null years as numbers (V7)."""
    return (year_share(ratings).select(F.col("year").try_cast("int").alias("year"))
            .dropna().distinct())


def top_movies(ratings: DataFrame, movies: DataFrame, k: int = 10,
               min_count: int = 0) -> DataFrame:
    """Q7: the ``k`` movies with the highest average rating.

    Groups are (movieId, title, genres) as in the reference, so a movie
    table with repeated rows still gives the reference's answer. Ties break
    on movieId. ``min_count`` (0 = the reference) drops movies with fewer
    ratings."""
    joined = movie_totals(ratings).join(movies, "movieId")
    per_movie = joined.groupBy("movieId", "title", "genres").agg(
        _mean_rating().alias("avg_rating"),
        F.sum("_rating_n").alias("rating_count"))
    if min_count:
        per_movie = per_movie.filter(F.col("rating_count") >= min_count)
    return agg.top_k(per_movie, k, F.col("avg_rating").desc_nulls_last(), F.col("movieId").asc())


def user_counts(ratings: DataFrame) -> DataFrame:
    counts = agg.group_count(ratings, "userId", name="rating_count")
    return counts.withColumn("rater_category", bands.rater_class("rating_count"))


def top_raters(ratings: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` users with most ratings; ties broken by userId."""
    return agg.top_k(user_counts(ratings), k, F.col("rating_count").desc(), F.col("userId").asc())


def rater_distribution(ratings: DataFrame) -> DataFrame:
    """Users per rater class (more than 50 ratings is frequent)."""
    return agg.class_distribution(ratings, "userId", bands.rater_class("rating_count"),
                                  "rater_category", "rating_count")
