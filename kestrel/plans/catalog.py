"""Registry of the named queries: name -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the test tables under ``sf_dir`` through the fixture
derivations, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import bands
from kestrel.operators.aggregate import with_category_order
from kestrel.operators.positions import with_positions
from kestrel.plans import documents, fixtures, logs, ratings, trips, tweets
from kestrel.session import materialize, prepare, scratch_path
from kestrel.sources import raw_inputs
from kestrel.sources.objectstore import Store
from kestrel.streaming import logs as stream_logs

Query = Callable[[SparkSession, str], DataFrame]


# --- adapters: fixture in, query function applied ------------------------------

def _tweets(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixtures.tweets(prepare(spark), sf_dir))
    return run


def _ratings(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixtures.ratings(prepare(spark), sf_dir))
    return run


def _ratings_movies(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir))
    return run


def _trips(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixtures.trips(prepare(spark), sf_dir))
    return run


def _staged_trips(fn) -> Query:
    """For graph questions, which read the trips as vertices and as edges:
    the joined trips are written once, so each table is scanned once."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(materialize(fixtures.trips(prepare(spark), sf_dir).drop("trip_start"), "staged-trips"))
    return run


def _ranked(fn):
    """Ranks in order (G10, O2), with their position."""
    def run(trips_df: DataFrame) -> DataFrame:
        placed = with_positions(fn(trips_df), F.col("pagerank").desc(), F.col("id"))
        return trips.ranked(placed.withColumn("position", F.col("position").cast("int")))
    return run


def _csv(write, read, fn, *sources) -> Query:
    """Write a derived input as the original CSV, read it back, answer from it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        frames = []
        for source, write_one, read_one in zip(sources, write, read):
            path = scratch_path(spark, "csv-input")
            write_one(source(spark, sf_dir), path)
            frames.append(read_one(spark, path))
        return fn(*frames)
    return run


def _lines(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(logs.with_watermark(fixtures.log_lines(prepare(spark), sf_dir)))
    return run


def _stream(fn, *ntz_columns: str) -> Query:
    """Run a streaming query over the events file to completion; return its
    final answer."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = fn(prepare(spark), stream_logs.events_path(sf_dir)).result
        return _ntz(result, *ntz_columns)
    return run


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as wall-clock values (UTC), readable alike in any client zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns}) if columns else df


def _ordered(fn, col: str, order: Sequence[str]):
    return lambda *frames: with_category_order(fn(*frames), col, order)


# --- registry ----------------------------------------------------------------------

def tweet_queries() -> dict[str, Query]:
    return {
        "tweets_total_entries": _tweets(tweets.total_entries),
        "tweets_weekday_rows": _tweets(lambda t: _ntz(tweets.weekday_tweets(t), "tweet_time")),
        "tweets_location_counts": _tweets(tweets.location_counts),
        "tweets_time_of_day": _tweets(tweets.time_of_day_counts),
        "tweets_time_of_day_ordered": _tweets(
            _ordered(tweets.time_of_day_counts, "time_of_day", bands.TIME_OF_DAY_ORDER)),
        "tweets_day_share": _tweets(tweets.day_share),
        "tweets_day_share_ordered": _tweets(
            _ordered(tweets.day_share, "day_name", bands.WEEKDAY_ORDER)),
        "tweets_busy_days": _tweets(tweets.busy_days),
        "tweets_top_locations": _tweets(tweets.top_locations),
        "tweets_map_points": _tweets(tweets.map_points),
    }


def rating_queries() -> dict[str, Query]:
    valid = fixtures.TEST_GENRES
    return {
        "ratings_unique_users": _ratings(ratings.unique_users),
        "ratings_with_date": _ratings(ratings.with_rating_date),
        "ratings_bands": _ratings(ratings.rating_bands),
        "ratings_band_shares": _ratings(ratings.rating_band_shares),
        "ratings_half_year": _ratings(ratings.half_year_counts),
        "ratings_half_year_ordered": _ratings(
            _ordered(ratings.half_year_counts, "time_of_year", bands.HALF_YEAR_ORDER)),
        "ratings_genre_counts": _ratings_movies(lambda r, m: ratings.genre_counts(r, m, valid)),
        "ratings_genre_average": _ratings_movies(lambda r, m: ratings.genre_average(r, m, valid)),
        "ratings_year_share": _ratings(ratings.year_share),
        "ratings_years": _ratings(ratings.rated_years),
        "ratings_top_movies": _ratings_movies(ratings.top_movies),
        "ratings_top_raters": _ratings(ratings.top_raters),
        "ratings_rater_distribution": _ratings(ratings.rater_distribution),
    }


def _supplier_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, _ = fixtures.supply_graph(prepare(spark), sf_dir)
    return trips.supplier_routes(vertices, fixtures.supply_pairs(spark, sf_dir), collapsed=True)


def _supplier_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, _ = fixtures.supply_graph(prepare(spark), sf_dir)
    return trips.supplier_paths(vertices, fixtures.supply_pairs(spark, sf_dir))


def trip_queries() -> dict[str, Query]:
    out = {
        "trips_record_count": _trips(trips.record_count),
        "trips_vertices": _trips(trips.vertices),
        "trips_edges": _trips(trips.edges),
        "trips_triplets": _trips(trips.trip_triplets),
        "trips_same_area": _trips(trips.same_area_trips),
        "trips_same_area_count": _trips(trips.same_area_count),
        "trips_bfs_summary": _staged_trips(lambda t: trips.bfs_to(t, trips.BFS_TARGET_AREA)),
        "trips_bfs_paths": _staged_trips(lambda t: trips.paths_to(t, trips.BFS_TARGET_AREA)),
        "supply_bfs_summary": _supplier_routes,
        "supply_bfs_paths": _supplier_paths,
        "trips_unique_vertices": _trips(trips.unique_vertices),
        "trips_weighted_edges": _trips(trips.weighted_edges),
        "trips_weighted_pagerank": _staged_trips(trips.weighted_pagerank),
        "trips_weighted_pagerank_ranked": _staged_trips(_ranked(trips.weighted_pagerank)),
        "trips_pagerank": _staged_trips(trips.standard_pagerank),
        "trips_pagerank_ranked": _staged_trips(_ranked(trips.standard_pagerank)),
        "trips_fare_table": _trips(trips.fare_table),
        "trips_avg_fare_by_distance": _trips(lambda t: trips.average_fare_by(t, "distance")),
        "trips_avg_fare_by_duration": _trips(lambda t: trips.average_fare_by(t, "duration")),
        "trips_avg_fare_by_hour": _trips(lambda t: trips.average_fare_by(t, "start_hour")),
        "trips_fare_correlations": _trips(trips.fare_correlations),
    }
    for column, _lo, _hi, _bins in trips.FARE_HISTOGRAMS:
        out[f"trips_histogram_{column}"] = _trips(lambda t, c=column: trips.fare_histogram(t, c))
    return out


def log_queries() -> dict[str, Query]:
    return {
        "logs_lines": _lines(lambda l: _ntz(l, "timestamp")),
        "logs_datanode_windows": _lines(
            lambda l: _ntz(logs.datanode_windows(l), "window_start", "window_end")),
        "logs_bytes_per_host": _lines(lambda l: logs.ranked_hosts(logs.bytes_per_host(l))),
        "logs_info_block_counts": _lines(logs.info_block_counts),
        "logs_lines_stream": _stream(stream_logs.stream_lines, "timestamp"),
        "logs_datanode_windows_stream": _stream(stream_logs.stream_datanode_windows,
                                                "window_start", "window_end"),
        "logs_datanode_windows_replay": lambda spark, sf_dir: _ntz(
            stream_logs.replay_datanode_windows(prepare(spark), sf_dir).result, "window_start", "window_end"),
        "logs_text_windows_replay": lambda spark, sf_dir: _ntz(
            stream_logs.replay_text_windows(prepare(spark), sf_dir).result, "window_start", "window_end"),
        "logs_late_windows_replay": lambda spark, sf_dir: _ntz(stream_logs.replay_dropped(prepare(spark), sf_dir), "watermark"),
        "logs_text_windows_interrupted": lambda spark, sf_dir: _ntz(
            stream_logs.interrupted_text_windows(prepare(spark), sf_dir).result, "window_start", "window_end"),
        "logs_info_block_counts_triggered": lambda spark, sf_dir:
            stream_logs.triggered_info_block_counts(prepare(spark), sf_dir).result,
        "logs_bytes_per_host_stream": _stream(stream_logs.stream_bytes_per_host),
        "logs_info_block_counts_stream": _stream(stream_logs.stream_info_block_counts),
    }


def document_queries() -> dict[str, Query]:
    def hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
        return documents.hashtag_counts(fixtures.tagged_documents(prepare(spark), sf_dir))
    return {"documents_hashtags": hashtags}


def _stored_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets written to and read from a Hadoop file system that is not the
    session's default one, addressed by URI alone (S3)."""
    rows = fixtures.tweets(prepare(spark), sf_dir)
    store = Store.mounted("kestrel", scratch_path(spark, "store"))
    store.write(rows, "tweets.csv", "csv", header="true")
    return tweets.day_share(store.read(spark, "tweets.csv", rows.schema, "csv", header="true"))


def csv_queries() -> dict[str, Query]:
    """Questions answered from the original CSV layouts."""
    taxi = ([raw_inputs.write_taxi_csv], [raw_inputs.taxi_csv])
    counted = ([raw_inputs.write_taxi_csv], [lambda spark, path: raw_inputs.taxi_csv(spark, path, with_malformed=True)])

    def spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Areas as 8.0, and every 43rd duration unreadable.
        return fixtures.trips(spark, sf_dir).withColumns({
            "pickup_area": F.col("pickup_area").cast("decimal(10,1)"),
            "trip_seconds": F.when(F.col("trip_seconds") % 43 == 0, F.lit("n/a")).otherwise(F.col("trip_seconds").cast("string"))})

    def account(trips_df: DataFrame) -> DataFrame:
        return trips_df.agg(F.sum(raw_inputs.MALFORMED).alias("malformed_values"), F.count("*").alias("trips"),
                            F.count("pickup_area").alias("with_pickup"))

    return {
        "csv_tweets_day_share": _csv([raw_inputs.write_plain_csv], [raw_inputs.tweets_csv], tweets.day_share, fixtures.tweets),
        "csv_ratings_top_movies": _csv([raw_inputs.write_plain_csv] * 2, [raw_inputs.ratings_csv, raw_inputs.movies_csv],
                                       ratings.top_movies, fixtures.ratings, fixtures.movies),
        "csv_trips_avg_fare_by_hour": _csv(*taxi, lambda t: trips.average_fare_by(t, "start_hour"), fixtures.trips),
        "csv_stored_tweets_day_share": _stored_tweets,
        "csv_trips_malformed": _csv(*counted, account, spoiled),
    }


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (tweet_queries, rating_queries, trip_queries, log_queries, document_queries, csv_queries):
        out.update(group())
    return out
