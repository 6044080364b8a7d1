"""Distributed row positions against Python's sort."""

import random

from pyspark.sql import functions as F

from kestrel.operators.positions import with_group_positions, with_positions
from kestrel.plans import catalog


def rows():
    rng = random.Random(3)
    return [(i, rng.choice([None, "a", "a", "a", "b", "é"]), rng.choice([None, float("nan"), 1.0, 2.5, -0.5])) for i in range(500)]


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame(rows(), "id long, g string, v double")
    got = with_positions(df, F.col("v").desc(), F.col("id")).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 501))
    assert [r.id for r in got] == [r.id for r in df.orderBy(F.col("v").desc(), "id").collect()]


def test_positions_within_groups_and_their_sizes(spark):
    df = spark.createDataFrame(rows(), "id long, g string, v double")
    got = with_group_positions(df, "g", F.col("id"), column="at", size_column="n").collect()
    for group in {r[1] for r in rows()}:
        ids = [r[0] for r in rows() if r[1] == group]
        own = sorted((r["at"], r.id, r.n) for r in got if r.g == group)
        assert own == [(k + 1, i, len(ids)) for k, i in enumerate(ids)]


def test_empty_table_and_ties(spark):
    df = spark.createDataFrame([], "id long, g string")
    assert with_positions(df, "id").collect() == [] and with_group_positions(df, "g", "id").collect() == []
    same = spark.range(0, 100).select(F.lit(1).alias("id"), F.lit(None).cast("string").alias("g"))
    assert sorted(r.position for r in with_group_positions(same, "g", "id").collect()) == list(range(1, 101))


def test_ranking_plan_has_no_window(spark):
    ranks = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "id string, pagerank double")
    ranked = catalog._ranked(lambda _: ranks)(None)
    assert [(r.id, r.position) for r in ranked.collect()] == [("b", 1), ("c", 2), ("a", 3)]
    assert "Window" not in ranked._jdf.queryExecution().toString()
