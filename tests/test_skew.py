"""Hot keys: one vertex (or group) holds a third of all rows.

Results must stay whole and exact, and every collapse must combine
map-side (a partial aggregate below the shuffle), so the hot key costs one
row per task in the exchange instead of a third of the input in one task."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import aggregate, graph
from tests.test_graph import ref_bfs, ref_dynamic_pagerank, ref_weighted_pagerank

HOT = 0
IDS = list(range(12))


def _hot_edges(n=900, seed=7):
    """``n`` edges over ``IDS``; a third leave the hot vertex, mostly as
    parallel edges to a few neighbours (and to itself)."""
    rng = random.Random(seed)
    edges = []
    for i in range(n):
        if i % 3 == 0:
            edges.append((HOT, rng.choice([HOT, 1, 2, 3]), float(rng.randint(1, 9))))
        else:
            edges.append((rng.choice(IDS[1:]), rng.choice(IDS), float(rng.randint(1, 9))))
    return edges


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dynamic_pagerank_with_a_hot_vertex(spark):
    edges = _hot_edges()
    e = spark.createDataFrame([(s, t) for s, t, _ in edges], "src int, dst int")
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    got = {r.id: r.pagerank for r in graph.pagerank(ids, e).collect()}
    want = ref_dynamic_pagerank(IDS, [(s, t) for s, t, _ in edges])
    assert set(got) == set(want)
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-12)


def test_weighted_pagerank_with_a_hot_vertex(spark):
    edges = _hot_edges()
    df = spark.createDataFrame(edges, "s int, d int, m double")
    weighted = graph.parallel_edge_weights(df, F.col("s"), F.col("d"), F.col("m"))
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    got = {r.id: r.pagerank for r in
           graph.weighted_pagerank(ids, graph.normalize_out_weights(weighted)).collect()}
    summed = {}
    for s, t, m in edges:
        summed[(s, t)] = summed.get((s, t), 0.0) + m
    want = ref_weighted_pagerank(IDS, [(s, t, w) for (s, t), w in summed.items()])
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-12)


def test_bfs_with_a_hot_vertex(spark):
    # Target 11 is entered only from vertices 5 and 6, which are not
    # starts, so shortest paths have two hops or more and the hot vertex
    # (with its parallel edges) is among the starts that reach it.
    edges = [e for e in _hot_edges(n=300, seed=3) if e[1] != 11]
    edges += [(5, 11, 4.0), (6, 11, 2.0), (5, 11, 1.0), (HOT, 5, 3.0), (HOT, 5, 8.0)]
    starts = {i for i in IDS if i not in (5, 6, 11)}
    v = spark.createDataFrame([(i,) for i in IDS], "id int")
    e = spark.createDataFrame(edges, "src int, dst int, TripMiles double")
    hops = graph.bfs_first_hops(v, graph.min_per_pair(e, "TripMiles"),
                                F.col("id").isin(*starts), F.col("id") == 11, 10, distinct_pairs=True)
    got = {r.startComm: r.shortestMiles for r in graph.bfs_summary(hops, end=11).collect()}
    want = {}
    for s, _t, _n, m in ref_bfs(IDS, edges, lambda x: x in starts, lambda x: x == 11, 10):
        want[s] = min(m, want.get(s, m))
    assert HOT in want
    assert got == want


def test_collapses_combine_map_side(spark):
    edges = spark.createDataFrame(_hot_edges(), "src int, dst int, TripMiles double")
    verts = edges.select(F.col("src").alias("id"), F.col("TripMiles").alias("lat"))
    checks = {
        "partial_count": aggregate.group_count(edges, "src"),
        "partial_sum": graph.parallel_edge_weights(edges, F.col("src"), F.col("dst"),
                                                   F.col("TripMiles")),
        "partial_min": graph.min_per_pair(edges, "TripMiles"),
    }
    for partial, df in checks.items():
        assert partial in _plan(df), partial
    # min(struct) per id is combined map-side too.
    assert "partial_min" in _plan(graph.one_row_per_vertex(verts, ["lat"]))
    # Distinct vertices: a key-only partial aggregate below the exchange.
    plan = _plan(graph.endpoint_vertices(edges, [{"id": "src"}, {"id": "dst"}]))
    assert plan.count("HashAggregate(keys=[id") == 2


def test_a_hub_of_distinct_pairs_is_split(spark):
    """Two thirds of the distinct pairs leave one vertex: the join of a round
    is split by Spark, and the ranks are those of the reference."""
    n = 40_000
    pairs = (spark.range(0, 2 * n).select(F.lit(0).cast("long").alias("src"), (F.col("id") + 1).alias("dst"))
             .unionAll(spark.range(0, n).select((F.col("id") % 997 + 1).alias("src"), (F.col("id") * 7 % (2 * n) + 1).alias("dst"))))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        from kestrel.session import materialize
        edges = materialize(pairs.distinct().withColumn("w", F.lit(1.0)), "hub-edges")
        state = materialize(edges.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0)), "hub-state")
        assert edges.count() >= 100_000
        round_ = graph._along(edges, state.withColumnRenamed("id", "src"), "src").groupBy("dst").agg(F.sum("w"))
        round_.collect()
        assert "skew=true" in round_._jdf.queryExecution().executedPlan().toString()
        ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        got = {r.id: r.pagerank for r in graph.pagerank(ids, edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    listed = [(r.src, r.dst) for r in edges.collect()]
    want = ref_dynamic_pagerank(sorted(got), listed)
    assert all(got[v] == pytest.approx(want[v], abs=1e-9) for v in want)


def test_scratch_tables_do_not_pile_up(spark):
    from kestrel import session
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (1, 3, 2.0)], "src int, dst int, TripMiles double")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    session.release_scratch(spark)
    held = []
    for _ in range(3):
        graph.pagerank(ids, e).collect()
        graph.bfs_first_hops(ids, e, F.col("id") == 1, F.col("id") == 3).collect()
        graph.weighted_pagerank(ids, e.withColumn("norm_weight", F.lit(0.5))).collect()
        held.append(session.release_scratch(spark))
    assert held == [3, 3, 3]  # each run leaves its result alone
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
