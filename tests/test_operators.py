"""Aggregation, histogram and cleaning operators on tiny inputs."""

from pyspark.sql import functions as F

from kestrel.operators import aggregate as agg
from kestrel.operators import clean
from kestrel.operators.histogram import histogram


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"], "k string")
    rows = agg.with_share_of_total(agg.group_count(df, "k")).collect()
    assert abs(sum(r.percentage for r in rows) - 100.0) < 1e-9
    assert {r.k: r["count"] for r in rows} == {"a": 3, "b": 2, "c": 1}


def test_share_one_group_and_empty(spark):
    one = spark.createDataFrame([("x",), ("x",)], "k string")
    assert agg.with_share_of_total(agg.group_count(one, "k")).first().percentage == 100.0
    empty = spark.createDataFrame([], "k string")
    assert agg.with_share_of_total(agg.group_count(empty, "k")).count() == 0


def test_above_mean(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"], "k string")
    assert [r.k for r in agg.above_mean(agg.group_count(df, "k")).collect()] == ["a"]
    equal = spark.createDataFrame([(k,) for k in "aabbcc"], "k string")
    assert agg.above_mean(agg.group_count(equal, "k")).count() == 0


def test_top_k_ties_across_cut(spark):
    df = spark.createDataFrame([("d", 5), ("b", 3), ("a", 3), ("c", 3)], "k string, n int")
    got = [r.k for r in agg.top_k(df, 2, F.col("n").desc(), F.col("k").asc()).collect()]
    assert got == ["d", "a"]


def test_distinct_count_skips_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "u int")
    assert agg.distinct_count(df, "u", "n").first().n == 2


def test_class_distribution(spark):
    rows = [(1,)] * 51 + [(2,)] * 50
    df = spark.createDataFrame(rows, "u int")
    dist = agg.class_distribution(df, "u", F.when(F.col("count") > 50, "F").otherwise("I"), "cls")
    assert sorted((r.cls, r["count"]) for r in dist.collect()) == [("F", 1), ("I", 1)]


def test_pearson_edges(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert const.agg(agg.pearson("x", "y")).first()[0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert one.agg(agg.pearson("x", "y")).first()[0] is None
    lin = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 1.0)], "x double, y double")
    got = lin.agg(agg.pearson("x", "y")).first()[0]
    import statistics
    assert abs(got - statistics.correlation([1.0, 2.0, 3.0], [2.0, 4.0, 6.5])) < 1e-12


def test_histogram_edges(spark):
    vals = [-1.0, 0.0, 2.0, 1.999, 99.0, 100.0, 100.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = {r.bin: r for r in histogram(df, "v", 0, 100, 50).collect()}
    assert len(rows) == 50
    assert rows[1]["count"] == 2          # 0.0 and 1.999
    assert rows[2]["count"] == 1          # a bin edge goes right
    assert rows[50]["count"] == 2         # 99.0 and the top edge 100.0
    assert rows[25]["count"] == 0         # empty bins are kept
    assert sum(r["count"] for r in rows.values()) == 5
    assert (rows[2].bin_start, rows[2].bin_end) == (2.0, 4.0)


def test_parse_location_drops_header_and_bad_rows(spark):
    df = spark.createDataFrame([("location", "count"), ("-87.5,41.0", "3"), ("abc,1", "2"),
                                ("-100.0,30.5", "x")], "location string, count string")
    rows = clean.parse_location(df).collect()
    assert [(r.longitude, r.latitude, r["count"]) for r in rows] == [(-87.5, 41.0, 3)]


def test_within_box(spark):
    df = spark.createDataFrame([(-125.0, 24.0), (-60.0, 30.0), (-90.0, 51.0)], "longitude double, latitude double")
    assert clean.within_box(df).count() == 1


def test_category_order(spark):
    df = spark.createDataFrame([("Friday",), ("Monday",), ("Sunday",)], "d string")
    out = df.orderBy(agg.category_order("d", ["Monday", "Tuesday", "Friday"]).asc_nulls_last())
    assert [r.d for r in out.collect()] == ["Monday", "Friday", "Sunday"]


def test_fill_and_drops(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 4.0)], "a int, b double")
    assert clean.drop_any_null(df).count() == 1
    assert clean.not_null(df, ["a"]).count() == 2
    assert clean.fill(df, {"b": 0.0}).filter(F.col("b") == 0.0).count() == 1


def test_hashtag_counts(spark):
    from kestrel.plans.documents import hashtag_counts
    docs = spark.createDataFrame([("#spark is #fast, #spark!",), ("none",), (None,)], "text string")
    got = {r.hashtag: r["count"] for r in hashtag_counts(docs).collect()}
    assert got == {"spark": 2, "fast": 1}
