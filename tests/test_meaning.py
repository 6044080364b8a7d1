"""The derived inputs reach the behaviour that each query is for: rows with
nulls, one-way vertices, fares in range, tags, late rows."""

import pytest
from pyspark.sql import functions as F

from kestrel.operators import clean, graph
from kestrel.plans import catalog, fixtures, trips, tweets
from kestrel.streaming import logs as stream_logs
from tests.conftest import SF_DIR, SMALL_DIR


@pytest.fixture(scope="module")
def taxi(spark):
    return fixtures.trips(spark, SF_DIR)


def test_nulls_are_there_and_dropped(spark, taxi):
    n = taxi.count()
    assert trips.edges(taxi).count() < n
    assert trips.fare_table(taxi).count() < n
    assert taxi.filter("pickup_area is null").count() and taxi.filter("dropoff_tract is null").count()
    candidates = [{"id": "pickup_area", "t": "pickup_tract"}, {"id": "dropoff_area", "t": "dropoff_tract"}]
    assert graph.endpoint_vertices(taxi, candidates).filter("id is null or t is null").isEmpty()
    raw = taxi.groupBy(F.col("pickup_area").alias("src"), F.col("dropoff_area").alias("dst")).agg(F.sum("trip_miles").alias("weight"))
    assert clean.drop_any_null(raw).count() < raw.count()
    places = tweets.location_counts(fixtures.tweets(spark, SF_DIR))
    assert not places.filter("location is null").isEmpty()


def test_one_way_vertices(spark, taxi):
    edges = trips.edges(taxi)
    ids = {r.id for r in trips.unique_vertices(taxi).collect()}
    sources = {r.src for r in edges.select("src").distinct().collect()}
    ends = {r.dst for r in edges.select("dst").distinct().collect()}
    assert 100 in ids - ends and 200 in ids - sources


@pytest.mark.parametrize("name", ["trips_histogram_fare_amount", "trips_histogram_distance", "trips_histogram_duration",
                                  "trips_histogram_start_hour"])
def test_histograms_count_something(spark, name):
    counts = [r["count"] for r in catalog.all_queries()[name](spark, SF_DIR).collect()]
    assert sum(counts) > 1000 and sum(c > 0 for c in counts) > len(counts) / 2


def test_hashtags_are_found(spark):
    assert catalog.all_queries()["documents_hashtags"](spark, SMALL_DIR).count() > 10


def test_ratings_have_two_decimals(spark):
    rated = fixtures.ratings(spark, SF_DIR)
    assert not rated.filter(F.round("rating", 1) != F.col("rating")).isEmpty()


def test_replay_moves_the_watermark_and_drops_late_rows(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    run = stream_logs.replay_datanode_windows(spark, SMALL_DIR)
    late = stream_logs.replay_slices(spark, SMALL_DIR)[-1]
    clicks = late.filter(F.col("event_type").isin("click", "purchase", "signup")).count()
    assert clicks > 0
    assert run.rows_dropped_by_watermark() == 2 * clicks  # two sliding windows each
    assert max(run.dropped) >= stream_logs.REPLAY_SLICES
