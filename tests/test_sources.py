"""CSV read with a timestamp pattern, CSV/Parquet sinks, S3A settings."""

import datetime as dt
import os
import tempfile

from pyspark.sql import SparkSession

from kestrel.sources import read_csv, with_s3a, write_csv, write_parquet
from kestrel.sources.csv import TAXI_TIMESTAMP_FORMAT


def test_csv_roundtrip_with_12_hour_timestamps(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-csv-")
    src = os.path.join(folder, "trips.csv")
    with open(src, "w") as f:
        f.write("Trip Start Timestamp,Trip Miles,Fare\n")
        f.write("01/31/2024 01:15:00 PM,2.5,10.25\n")
        f.write("02/29/2024 12:00:00 AM,,7.00\n")
    df = read_csv(spark, src, schema="`Trip Start Timestamp` timestamp_ntz, `Trip Miles` double, Fare double",
                  timestamp_format=TAXI_TIMESTAMP_FORMAT)
    rows = df.collect()
    assert rows[0][0] == dt.datetime(2024, 1, 31, 13, 15)
    assert rows[1][0] == dt.datetime(2024, 2, 29, 0, 0)
    assert rows[1][1] is None
    out = os.path.join(folder, "out")
    write_csv(df, out, single_file=True)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    back = read_csv(spark, out, infer_schema=True)
    assert back.count() == 2


def test_partitioned_parquet_sink(spark):
    folder = tempfile.mkdtemp(prefix="kestrel-pq-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    write_parquet(df, folder + "/t", partition_by=["k"])
    assert sorted(os.listdir(folder + "/t"))[:2] == ["_SUCCESS", "k=a"] or "k=a" in os.listdir(folder + "/t")
    assert spark.read.parquet(folder + "/t").count() == 2


def test_s3a_settings_on_builder():
    b = with_s3a(SparkSession.builder, endpoint="http://store:9000", path_style=True, ssl=False)
    opts = b._options
    assert opts["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert opts["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert opts["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_raw_taxi_csv_feeds_the_trip_queries(spark):
    from kestrel.plans import trips
    from kestrel.sources.raw_inputs import TAXI_COLUMNS, taxi_csv
    folder = tempfile.mkdtemp(prefix="kestrel-taxi-")
    header = ",".join(TAXI_COLUMNS.values())
    rows = [
        "01/31/2024 01:15:00 PM,600,2.5,10.25,8,41.9,-87.6,17031081500,32,41.88,-87.62,17031839100",
        "01/31/2024 11:59:59 PM,300,1.0,5.00,32,41.88,-87.62,17031839100,8,41.9,-87.6,17031081500",
        "not a time,abc,,7.00,8,41.9,-87.6,17031081500,8,41.9,-87.6,17031081500",
    ]
    with open(os.path.join(folder, "t.csv"), "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    t = taxi_csv(spark, folder)
    fares = trips.fare_table(t).collect()
    assert sorted((r.start_hour, r.distance, r.duration, r.fare_amount) for r in fares) == [
        (13, 2.5, 600.0, 10.25), (23, 1.0, 300.0, 5.0)]
    assert trips.vertices(t).count() == 2
    assert trips.same_area_count(t).first().same_area_count == 0  # the bad row has no miles


def test_raw_tweets_and_ratings_csv(spark):
    from kestrel.plans import ratings, tweets
    from kestrel.sources.raw_inputs import movies_csv, ratings_csv, tweets_csv
    folder = tempfile.mkdtemp(prefix="kestrel-raw-")
    with open(os.path.join(folder, "tweets.csv"), "w") as f:
        f.write("id,timestamp,longitude,latitude\n1,20240105093000,-87.5,41.0\n2,bad,-87.5,41.0\n")
    with open(os.path.join(folder, "ratings.csv"), "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,10,4.5,1704067200\n2,10,5.0,1704067200\n")
    with open(os.path.join(folder, "movies.csv"), "w") as f:
        f.write('movieId,title,genres\n10,"Heat (1995)",Action|Crime|Thriller\n')
    tw = tweets_csv(spark, os.path.join(folder, "tweets.csv"))
    assert {r.day_name: r["count"] for r in tweets.day_share(tw).collect()} == {"Friday": 1, None: 1}
    rt = ratings_csv(spark, os.path.join(folder, "ratings.csv"))
    mv = movies_csv(spark, os.path.join(folder, "movies.csv"))
    assert {r.genre: r["count"] for r in ratings.genre_counts(rt, mv).collect()} == {
        "Action": 2, "Crime": 2, "Thriller": 2}
    top = ratings.top_movies(rt, mv).first()
    assert (top.title, top.avg_rating, top.rating_count) == ("Heat (1995)", 4.75, 2)


def test_numbers_are_read_leniently_and_losses_counted(spark):
    from kestrel.sources.raw_inputs import TAXI_COLUMNS, taxi_csv
    folder = tempfile.mkdtemp(prefix="kestrel-lenient-")
    rows = [
        ["01/31/2024 01:15:00 PM", "600.0", '"1,234.5"', " 10.25 ", "8.0", "41.9", "-87.6", "17031081500.0", "32", "41.8", "-87.6", "1"],
        ["31/31/2024 01:15:00 PM", "6.5", "x", "", "8", "41.9", "-87.6", "17031081500", "32", "41.8", "-87.6", "1"],
    ]
    with open(os.path.join(folder, "t.csv"), "w") as f:
        f.write("\n".join([",".join(TAXI_COLUMNS.values()), *map(",".join, rows)]) + "\n")
    good, bad = sorted(taxi_csv(spark, folder, with_malformed=True).collect(), key=lambda r: r.malformed)
    assert (good.trip_seconds, good.trip_miles, good.fare, good.pickup_area, good.pickup_tract) == (600, 1234.5, 10.25, 8, 17031081500)
    assert good.malformed == 0
    # The date, the seconds (not whole) and the miles; an empty fare is missing, not malformed.
    assert (bad.malformed, bad.trip_seconds, bad.trip_miles, bad.fare) == (3, None, None, None)
    assert "malformed" not in taxi_csv(spark, folder).columns


def test_store_is_addressed_by_its_uri(spark, tmp_path):
    """Settings travel with reads and writes; the session never learns them."""
    from kestrel.sources.objectstore import Store
    store = Store.mounted("tested", f"file:{tmp_path}")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    uri = store.write(df, "some/table", "csv", header="true")
    assert uri == "viewfs://tested/data/some/table"
    back = store.read(spark, "some/table", df.schema, "csv", header="true")
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]
    assert all(f.startswith("viewfs://tested/data/some/table/") for f in back.inputFiles())
    assert spark.conf.get("fs.viewfs.mounttable.tested.link./data", None) is None
