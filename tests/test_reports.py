"""End-to-end reports: raw CSV in, one CSV per question out, equal to the
query functions' answers."""

import os
import tempfile

from pyspark.sql import functions as F

from kestrel.plans import fixtures, reports, tweets, trips
from kestrel.sources.raw_inputs import TAXI_COLUMNS
from tests.conftest import SMALL_DIR


def _as_csv(df, folder, name):
    path = os.path.join(folder, name)
    df.coalesce(1).write.option("header", True).csv(path)
    return path


def test_tweets_report_matches_queries(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-report-")
    tw = fixtures.tweets(spark, SMALL_DIR)
    src = _as_csv(tw, folder, "tweets_csv")
    paths = reports.tweets_report(spark, src, os.path.join(folder, "out"))
    got = spark.read.option("header", True).csv(paths["day_share"])
    want = tweets.day_share(tw)
    assert {(r.day_name, int(r["count"])) for r in got.collect()} == \
        {(r.day_name, r["count"]) for r in want.collect()}
    assert len([f for f in os.listdir(paths["top_locations"]) if f.endswith(".csv")]) == 1


def test_taxi_report_end_to_end(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-report-")
    t = fixtures.trips(spark, SMALL_DIR)
    raw = t.select(F.date_format("trip_start", "MM/dd/yyyy hh:mm:ss a").alias(TAXI_COLUMNS["trip_start"]),
                   *[F.col(k).alias(v) for k, v in TAXI_COLUMNS.items() if k != "trip_start"])
    src = _as_csv(raw, folder, "taxi_csv")
    paths = reports.taxi_report(spark, src, os.path.join(folder, "out"), landmark=7)
    got = spark.read.option("header", True).csv(paths["record_count"]).first()
    assert int(got.record_count) == t.count()
    corr = spark.read.option("header", True).csv(paths["fare_correlations"]).first()
    want = trips.fare_correlations(t).first()
    assert abs(float(corr.corr_distance) - want.corr_distance) < 1e-9
    assert spark.read.option("header", True).csv(paths["fare_table"]).count() == trips.fare_table(t).count()
    account = spark.read.option("header", True).csv(paths["input_account"]).first()
    assert (int(account.input_rows), int(account.malformed_values)) == (t.count(), 0)
    assert spark.read.option("header", True).csv(paths["edges"]).count() == trips.edges(t).count()


def test_ratings_report(spark):
    from kestrel.plans import ratings
    folder = tempfile.mkdtemp(prefix="kestrel-report-")
    rt = fixtures.ratings(spark, SMALL_DIR)
    mv = fixtures.movies(spark, SMALL_DIR)
    paths = reports.ratings_report(spark, _as_csv(rt, folder, "ratings_csv"),
                                   _as_csv(mv, folder, "movies_csv"), os.path.join(folder, "out"))
    users = spark.read.option("header", True).csv(paths["unique_users"]).first()
    assert int(users.unique_users) == ratings.unique_users(rt).first().unique_users
    top = [int(r.userId) for r in spark.read.option("header", True).csv(paths["top_raters"]).collect()]
    assert sorted(top) == sorted(r.userId for r in ratings.top_raters(rt).collect())


def test_logs_report_over_text_files(spark):
    from kestrel.plans import logs
    folder = tempfile.mkdtemp(prefix="kestrel-report-")
    lines = fixtures.log_lines(spark, SMALL_DIR)
    lines.select("value").write.text(os.path.join(folder, "logs"))
    runs = reports.logs_report(spark, os.path.join(folder, "logs"))
    assert runs["lines"].result.count() == lines.count()
    got = {r.hostname: r.total_bytes for r in runs["bytes_per_host"].result.collect()}
    assert got == {r.hostname: r.total_bytes for r in logs.bytes_per_host(lines).collect()}
    counts = {r.hostname: r["count"] for r in runs["info_block_counts"].result.collect()}
    assert counts == {r.hostname: r["count"] for r in logs.info_block_counts(lines).collect()}
    # All lines of the one batch arrive at one moment: two sliding windows.
    windows = [r.datanode_count for r in runs["datanode_windows"].result.collect()]
    assert windows == [lines.filter(F.col("value").contains("DataNode")).count()] * 2


def test_logs_report_at_event_time(spark):
    from kestrel.plans import logs
    folder = tempfile.mkdtemp(prefix="kestrel-report-")
    lines = fixtures.log_lines(spark, SMALL_DIR)
    stamped = lines.select(F.concat(F.date_format("timestamp", "yyMMdd HHmmss"), F.lit(" 143 "), "value").alias("value"))
    stamped.write.text(os.path.join(folder, "logs"))
    runs = reports.logs_report(spark, os.path.join(folder, "logs"), event_time=True)
    whole = lines.withColumn("timestamp", F.date_trunc("second", "timestamp"))
    want = {(r.window_start, r.window_end): r.datanode_count for r in logs.datanode_windows(whole).collect()}
    got = {(r.window_start, r.window_end): r.datanode_count for r in runs["datanode_windows"].result.collect()}
    assert got == want and len(want) > 100
