"""One call per analysis: read the raw input, answer every question, write
each result as CSV with a header.

The raw CSV is parsed once and staged as Parquet in the shared checkpoint
folder; every question then reads only its columns from the staged copy
instead of parsing the CSV again. Results with a fixed size bound are
written as single files; results that grow with the data, and the
row-level fare table, are written in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.plans import logs, ratings, trips, tweets
from kestrel.session import materialize, prepare
from kestrel.sources import raw_inputs
from kestrel.sources.sinks import write_csv
from kestrel.streaming.runner import StreamRun, run_stream


# Results with a fixed size bound (a few bands, seven days, ten rows, one
# row): written as one file each. Every other result can grow with the data
# (distinct locations, distances, vertices) and is written in parallel.
BOUNDED = frozenset({
    "time_of_day", "day_share", "busy_days", "top_locations",
    "unique_users", "rating_bands", "half_year", "genres", "top_movies", "top_raters",
    "rater_distribution", "record_count", "same_area_count", "avg_fare_by_hour",
    "fare_correlations", "input_account", "total_entries", "genre_average",
    *(f"histogram_{c}" for c, *_ in trips.FARE_HISTOGRAMS),
})


def _write_all(results: dict[str, DataFrame], output_dir: str) -> dict[str, str]:
    paths = {}
    for name, df in results.items():
        path = f"{output_dir.rstrip('/')}/{name}"
        write_csv(df, path, single_file=name in BOUNDED)
        paths[name] = path
    return paths


def _staged(raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The parsed input as a written table, and an account of it: rows, and
    values that held text but did not parse (counted by the same job)."""
    staged, seen = materialize(raw, name, [F.count(F.lit(1)).alias("n"),
                                           F.coalesce(F.sum(raw_inputs.MALFORMED), F.lit(0)).alias("bad")])
    account = raw.sparkSession.createDataFrame([(name, seen["n"], seen["bad"])],
                                               "input string, input_rows long, malformed_values long")
    return staged.drop(raw_inputs.MALFORMED), account


def tweets_report(spark: SparkSession, tweets_csv: str, output_dir: str) -> dict[str, str]:
    """Row count, weekday rows, weekday location counts, time-of-day bands,
    day shares, busy days and top locations."""
    tw, account = _staged(raw_inputs.tweets_csv(prepare(spark), tweets_csv, with_malformed=True), "tweets-input")
    return _write_all({
        "input_account": account,
        "total_entries": tweets.total_entries(tw),
        "weekday_rows": tweets.weekday_tweets(tw),
        "location_counts": tweets.location_counts(tw),
        "time_of_day": tweets.time_of_day_counts(tw),
        "day_share": tweets.day_share(tw),
        "busy_days": tweets.busy_days(tw),
        "top_locations": tweets.top_locations(tw),
    }, output_dir)


def ratings_report(spark: SparkSession, ratings_csv: str, movies_csv: str,
                   output_dir: str) -> dict[str, str]:
    """Unique users, ratings with their date, rating bands, half-year counts,
    genre counts and averages, year shares, top movies, top raters and rater
    classes."""
    prepare(spark)
    rt, rt_account = _staged(raw_inputs.ratings_csv(spark, ratings_csv, with_malformed=True), "ratings-input")
    mv, mv_account = _staged(raw_inputs.movies_csv(spark, movies_csv, with_malformed=True), "movies-input")
    return _write_all({
        "input_account": rt_account.unionAll(mv_account),
        "with_date": ratings.with_rating_date(rt),
        "genre_average": ratings.genre_average(rt, mv),
        "unique_users": ratings.unique_users(rt),
        "rating_bands": ratings.rating_bands(rt),
        "half_year": ratings.half_year_counts(rt),
        "genres": ratings.genre_counts(rt, mv),
        "years": ratings.year_share(rt),
        "top_movies": ratings.top_movies(rt, mv),
        "top_raters": ratings.top_raters(rt),
        "rater_distribution": ratings.rater_distribution(rt),
    }, output_dir)


def taxi_report(spark: SparkSession, taxi_csv: str, output_dir: str,
                landmark: int = 49) -> dict[str, str]:
    """Record count, vertices, edges, triplets, same-area trips, BFS to
    ``landmark``, both PageRanks, average fares, correlations, histograms,
    and the fare table (partitioned)."""
    tr, account = _staged(raw_inputs.taxi_csv(prepare(spark), taxi_csv, with_malformed=True), "taxi-input")
    paths = _write_all({
        "input_account": account,
        "vertices": trips.vertices(tr),
        "edges": trips.edges(tr),
        "triplets": trips.trip_triplets(tr),
        "same_area": trips.same_area_trips(tr),
        **{f"histogram_{c}": trips.fare_histogram(tr, c) for c, *_ in trips.FARE_HISTOGRAMS},
        "record_count": trips.record_count(tr),
        "same_area_count": trips.same_area_count(tr),
        "bfs_to_landmark": trips.bfs_to(tr, landmark),
        "pagerank": trips.ranked(trips.standard_pagerank(tr)),
        "weighted_pagerank": trips.ranked(trips.weighted_pagerank(tr)),
        "avg_fare_by_distance": trips.average_fare_by(tr, "distance"),
        "avg_fare_by_duration": trips.average_fare_by(tr, "duration"),
        "avg_fare_by_hour": trips.average_fare_by(tr, "start_hour"),
        "fare_correlations": trips.fare_correlations(tr),
    }, output_dir)
    fare_path = f"{output_dir.rstrip('/')}/fare_table"
    trips.export_fare_table(tr, fare_path)
    paths["fare_table"] = fare_path
    return paths


def logs_report(spark: SparkSession, lines_path: str, max_files_per_trigger: int | None = None,
                event_time: bool = False, timed_s: float | None = None) -> dict[str, StreamRun]:
    """The streaming questions over text log files: the lines themselves
    (append), DataNode windows (update), bytes per host and INFO/blk_ counts
    per host (complete).

    Lines count at their arrival, as in the original; with ``event_time``,
    at the stamp they carry, which is what replayed files need. ``timed_s``
    runs the pattern count for so many seconds on its processing-time trigger
    instead of until the input is used up."""
    prepare(spark)

    def lines() -> DataFrame:
        return logs.with_watermark(raw_inputs.log_line_stream(spark, lines_path, max_files_per_trigger, event_time))

    timed = {"processing_time": logs.PATTERN_TRIGGER, "timeout_s": timed_s} if timed_s else {}
    return {
        "lines": run_stream(spark, lines(), "append", name="report-lines"),
        "datanode_windows": run_stream(spark, logs.datanode_windows(lines()), "update",
                                       keys=["window_start", "window_end"], name="report-windows"),
        "bytes_per_host": run_stream(spark, logs.ranked_hosts(logs.bytes_per_host(lines())),
                                     "complete", name="report-bytes"),
        "info_block_counts": run_stream(spark, logs.info_block_counts(lines()), "complete",
                                        name="report-info", **timed),
    }
