"""Column functions on tiny literal rows, with the edge cases of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.functions import bands, numeric, text, timefn


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_packed_timestamp_edges(spark):
    df = _one_col(spark, ["20240101000000", "20231231235959", "20240229120000", "not a time", None],
                  "string")
    got = [r[0] for r in df.select(timefn.packed_to_timestamp("v").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2023, 12, 31, 23, 59, 59),
                   dt.datetime(2024, 2, 29, 12, 0, 0), None, None]


def test_packed_timestamp_from_number(spark):
    df = _one_col(spark, [20240105093000], "bigint")
    row = df.select(timefn.day_name(timefn.packed_to_timestamp("v")).alias("d"),
                    timefn.date_text(timefn.packed_to_timestamp("v")).alias("t")).first()
    assert (row.d, row.t) == ("Friday", "2024-01-05")


def test_weekday_filter(spark):
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]  # Fri Sat Sun Mon
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = [r[0] for r in df.select(timefn.is_weekday("d")).collect()]
    assert got == [True, False, False, True]


def test_time_of_day_bands(spark):
    hours = [4, 5, 11, 12, 16, 17, 21, 22, None]
    got = [r[0] for r in _one_col(spark, hours, "int").select(bands.time_of_day("v")).collect()]
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
                   "Night", "Night"]


def test_rating_bands_and_validity(spark):
    vals = [0.5, 1.0, 2.9, 3.0, 4.5, 5.0, 5.5, None]
    rows = _one_col(spark, vals, "double").select(
        bands.rating_band("v").alias("b"), bands.is_valid_rating("v").alias("ok")).collect()
    assert [r.b for r in rows] == ["Low", "Low", "Low", "Medium", "Medium", "High", None, None]
    assert [r.ok for r in rows] == [False, True, True, True, True, True, False, None]


def test_half_year(spark):
    got = [r[0] for r in _one_col(spark, ["06", "07", None, "xx"], "string")
           .select(bands.half_year("v")).collect()]
    assert got == ["Early Year", "Late Year", "Late Year", "Late Year"]


def test_rater_class_threshold(spark):
    got = [r[0] for r in _one_col(spark, [50, 51], "bigint").select(bands.rater_class("v")).collect()]
    assert got == ["Infrequent Raters", "Frequent Raters"]


def test_location_key_null_part(spark):
    df = spark.createDataFrame([(-87.5, 41.0), (None, 41.0)], "lon double, lat double")
    got = [r[0] for r in df.select(text.location_key("lon", "lat")).collect()]
    assert got == ["-87.5,41.0", None]


def test_log_captures(spark):
    lines = [
        "INFO dfs.DataNode$DataXceiver: Receiving block blk_1 src: /10.0.0.5:50010 dest: /10.0.1.1:50010 of size 123",
        "INFO dfs.DataNode$PacketResponder: Received block blk_2 of size 7 from /10.0.0.6:50010",
        "INFO dfs.DataNode$DataXceiver: Served block blk_3 to /10.0.0.7 of size 99   ",
        "ERROR dfs.datanode: blk_4 src: /10.0.0.8:50010 checksum mismatch",
    ]
    rows = _one_col(spark, lines, "string").select(
        text.log_host("v").alias("h"), text.log_trailing_number("v").alias("n"),
        F.col("v").contains(text.LOG_DATANODE).alias("dn")).collect()
    assert [r.h for r in rows] == ["10.0.0.5", "", "", "10.0.0.8"]
    # A line ending in a port yields the port; trailing blanks are allowed.
    assert [r.n for r in rows] == [123, 50010, 99, None]
    # Matching is case-sensitive: lower-case "datanode" does not count.
    assert [r.dn for r in rows] == [True, True, True, False]


def test_split_explode_genres(spark):
    df = spark.createDataFrame([(1, "Action|Comedy"), (2, "Drama"), (3, ""),
                                (4, "(no genres listed)"), (5, None)], "id int, g string")
    rows = df.select("id", F.explode(text.split_to_array("g")).alias("genre")).collect()
    assert sorted((r.id, r.genre) for r in rows) == [
        (1, "Action"), (1, "Comedy"), (2, "Drama"), (3, ""), (4, "(no genres listed)")]


def test_hashtags(spark):
    df = _one_col(spark, ["loving #Spark and #big_data!", "no tags", None], "string")
    got = [r[0] for r in df.select(text.hashtags("v")).collect()]
    assert got == [["Spark", "big_data"], [], None]


def test_mean_keeps_every_digit_of_its_inputs(spark):
    got = _one_col(spark, [3.75, 4.25, 3.333, None], "double").agg(numeric.mean("v")).first()[0]
    assert got == 3.777666667
    parts = spark.createDataFrame([(8.0, 2), (3.333, 1)], "s double, n int")
    assert parts.agg(numeric.mean_of_sums("s", "n")).first()[0] == 3.777666667
    assert _one_col(spark, [None], "double").agg(numeric.mean("v")).first()[0] is None
    # The order of the rows does not show in the result.
    assert len({_one_col(spark, v, "double").agg(numeric.mean("v")).first()[0]
                for v in ([0.1, 0.2, 0.7], [0.7, 0.1, 0.2], [0.2, 0.7, 0.1])}) == 1


def test_ratio_or_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.ratio_or_zero("a", "b")).collect()] == [0.0, 0.25]


def test_strict_size_option(spark):
    from kestrel.plans import logs
    lines = spark.createDataFrame([
        ("INFO a blk_1 of size 7 from /10.0.0.6:50010", None),
        ("INFO b src: /10.0.0.5:50010 of size 120", None)], "value string, timestamp timestamp")
    loose = {r.hostname: r.total_bytes for r in logs.bytes_per_host(lines).collect()}
    strict = {r.hostname: r.total_bytes for r in logs.bytes_per_host(lines, strict_size=True).collect()}
    assert loose == {"": 50010, "10.0.0.5": 120}
    assert strict == {"": 7, "10.0.0.5": 120}
