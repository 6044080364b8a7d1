"""Graph operators against brute-force Python references on small graphs."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.operators import graph


# --- references --------------------------------------------------------------

def ref_weighted_pagerank(ids, wedges, d=0.85, rounds=10):
    """The reference's recurrence, straight from its description."""
    n = len(ids)
    sum_out = defaultdict(float)
    for s, _t, w in wedges:
        sum_out[s] += w
    norm = [(s, t, 0.0 if sum_out[s] == 0 else w / sum_out[s]) for s, t, w in wedges]
    rank = {v: 1.0 / n for v in ids}
    for _ in range(rounds):
        total = defaultdict(float)
        for s, t, w in norm:
            if s in rank:
                total[t] += rank[s] * w
        rank = {v: (1 - d) / n + d * total.get(v, 0.0) for v in ids}
    return rank


def ref_dynamic_pagerank(ids, edges, reset=0.15, tol=0.01):
    """GraphX-style delta PageRank with per-vertex gating, then scaled to n."""
    ids = set(ids)
    known = [(s, t) for s, t in edges if s in ids and t in ids]
    deg = defaultdict(int)
    for s, _t in known:
        deg[s] += 1
    keep = 1 - reset
    pr = {v: keep * (reset / keep) for v in ids}
    delta = dict(pr)
    active = set(ids)
    while True:
        msg = defaultdict(float)
        got = set()
        for s, t in known:
            if s in active and delta[s] > tol:
                msg[t] += delta[s] / deg[s]
                got.add(t)
        if not got:
            break
        for v in got:
            new = pr[v] + keep * msg[v]
            delta[v] = new - pr[v]
            pr[v] = new
        active = got
    total = sum(pr.values())
    return {v: pr[v] * len(ids) / total for v in ids}


def ref_bfs(vertex_ids, edges, is_from, is_to, max_len):
    """Enumerate simple paths level by level; keep the first level that
    reaches a target. Returns {(start, end, next_id, miles)}."""
    ids = set(vertex_ids)
    out = defaultdict(list)
    for s, t, m in edges:
        if s in ids and t in ids:
            out[s].append((t, m))
    zero = {(v, v, None, None) for v in ids if is_from(v) and is_to(v)}
    if zero:
        return zero
    paths = [(v, [v], None) for v in ids if is_from(v)]
    for _k in range(max_len):
        nxt = []
        for start, seq, first in paths:
            for t, m in out[seq[-1]]:
                if t in seq:
                    continue
                nxt.append((start, seq + [t], first if first is not None else (t, m)))
        found = {(start, seq[-1], first[0], first[1]) for start, seq, first in nxt if is_to(seq[-1])}
        if found:
            return found
        paths = nxt
        if not paths:
            break
    return set()


# --- tables -------------------------------------------------------------------

def test_endpoint_vertices_and_triplet_fanout(spark):
    trips = spark.createDataFrame(
        [(1, 10.0, 2, 20.0), (1, 11.0, 2, 20.0), (None, 1.0, 2, 20.0), (2, 20.0, 2, 20.0)],
        "a int, la double, b int, lb double")
    verts = graph.endpoint_vertices(trips, [{"id": "a", "lat": "la"}, {"id": "b", "lat": "lb"}])
    assert sorted(tuple(r) for r in verts.collect()) == [(1, 10.0), (1, 11.0), (2, 20.0)]
    edges = graph.edge_table(trips, {"src": "a", "dst": "b"})
    assert edges.count() == 3                      # the null id row is dropped
    trip = graph.triplets(edges, verts, {"lat": "srcLat"}, {"lat": "dstLat"})
    # id 1 has two vertex rows, so each 1->2 edge appears twice.
    assert trip.filter(F.col("src") == 1).count() == 4
    assert graph.self_loops(edges).count() == 1
    one = graph.one_row_per_vertex(verts, ["lat"])
    assert sorted(tuple(r) for r in one.collect()) == [(1, 10.0), (2, 20.0)]


def test_parallel_edges_and_normalisation(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 1.0), (1, 3, 4.0), (4, 5, 0.0), (6, None, 1.0)],
                               "s int, d int, m double")
    w = graph.parallel_edge_weights(df, F.col("s"), F.col("d"), F.col("m"))
    n = {(r.src, r.dst): r.norm_weight for r in graph.normalize_out_weights(w).collect()}
    assert n == {(1, 2): 0.5, (1, 3): 0.5, (4, 5): 0.0}


def test_normalisation_drops_null_sources(spark):
    w = spark.createDataFrame([(1, 2, 1.0), (1, 3, 3.0), (None, 2, 5.0), (4, 5, 0.0)],
                              "src int, dst int, weight double")
    got = {(r.src, r.dst): (r.sumOut, r.norm_weight) for r in graph.normalize_out_weights(w).collect()}
    assert got == {(1, 2): (4.0, 0.25), (1, 3): (4.0, 0.75), (4, 5): (0.0, 0.0)}


# --- PageRank -------------------------------------------------------------------

WEDGES = [(1, 2, 3.0), (2, 1, 1.0), (2, 3, 1.0), (3, 1, 2.0), (3, 9, 5.0),  # 9 is unknown
          (4, 1, 1.0), (5, 5, 0.0)]                                           # 4 has no in-edges
IDS = [1, 2, 3, 4, 5, 6]                                                       # 6 is dangling


def test_weighted_pagerank_matches_reference(spark):
    wedges = spark.createDataFrame(WEDGES, "src int, dst int, weight double")
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    got = {r.id: r.pagerank for r in
           graph.weighted_pagerank(ids, graph.normalize_out_weights(wedges)).collect()}
    want = ref_weighted_pagerank(IDS, WEDGES)
    assert set(got) == set(want)
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-15)
    assert sum(got.values()) < 1.0                 # rank leaks, as in the reference


def test_dynamic_pagerank_matches_reference(spark):
    edges = [(1, 2), (1, 2), (2, 1), (2, 3), (3, 1), (3, 9), (4, 1), (5, 5), (1, 3)]
    e = spark.createDataFrame(edges, "src int, dst int")
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    got = {r.id: r.pagerank for r in graph.pagerank(ids, e).collect()}
    want = ref_dynamic_pagerank(IDS, edges)
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-12)
    assert sum(got.values()) == pytest.approx(len(IDS))


# --- BFS ------------------------------------------------------------------------

BFS_CASES = {
    # name: (vertex ids, edges (src, dst, miles), target, max_len)
    "direct": ([1, 2, 3, 7], [(1, 7, 5.0), (1, 7, 2.0), (2, 3, 1.0), (3, 7, 1.0)], 7, 10),
    "two_hops": ([1, 2, 3, 7], [(1, 2, 4.0), (2, 7, 1.0), (3, 2, 2.0), (3, 1, 9.0), (2, 3, 1.0)], 7, 10),
    "unreachable": ([1, 2, 7], [(1, 2, 1.0), (2, 1, 1.0)], 7, 10),
    "target_absent": ([1, 2], [(1, 2, 1.0)], 7, 10),
    "cycle": ([1, 2, 3, 4, 7], [(1, 2, 1.0), (2, 1, 1.0), (2, 3, 1.0), (3, 4, 1.0), (4, 7, 3.0), (1, 3, 8.0)], 7, 10),
    "depth_limit": ([1, 2, 3, 4, 7], [(1, 2, 1.0), (2, 3, 1.0), (3, 4, 1.0), (4, 7, 1.0)], 7, 3),
    "unknown_vertex": ([1, 2, 7], [(1, 9, 1.0), (9, 7, 1.0), (1, 2, 2.0), (2, 7, 2.0)], 7, 10),
}


@pytest.mark.parametrize("case", sorted(BFS_CASES))
def test_bfs_first_hops_match_path_enumeration(spark, case):
    ids, edges, target, max_len = BFS_CASES[case]
    v = spark.createDataFrame([(i,) for i in ids], "id int")
    e = spark.createDataFrame(edges, "src int, dst int, TripMiles double")
    hops = graph.bfs_first_hops(v, e, F.col("id") != target, F.col("id") == target, max_len)
    got = {(r.start, r.end, r.next_id, r.TripMiles) for r in hops.collect()}
    want = ref_bfs(ids, edges, lambda x: x != target, lambda x: x == target, max_len)
    assert got == want
    summary = {r.startComm: r.shortestMiles for r in graph.bfs_summary(hops, end=target).collect()}
    best = {}
    for s, _t, _n, m in want:
        best[s] = min(m, best.get(s, m))
    assert summary == best


def ref_paths(ids, edges, target, max_len):
    """All shortest id sequences into ``target`` by plain enumeration."""
    out = defaultdict(set)
    for s, t, _ in edges:
        if s in ids and t in ids:
            out[s].add(t)
    paths = [(v,) for v in ids if v != target]
    for _k in range(max_len):
        paths = [p + (t,) for p in paths for t in out[p[-1]] if t not in p]
        found = {p for p in paths if p[-1] == target}
        if found:
            return found
    return set()


@pytest.mark.parametrize("case", sorted(BFS_CASES))
def test_bfs_paths_match_enumeration(spark, case):
    ids, edges, target, max_len = BFS_CASES[case]
    g = graph.PropertyGraph(spark.createDataFrame([(i,) for i in ids], "id int"),
                            spark.createDataFrame(edges, "src int, dst int, TripMiles double"))
    got = g.bfsPaths(f"id != {target}", f"id = {target}", max_len).collect()
    assert sorted(tuple(r.path) for r in got) == sorted(ref_paths(set(ids), edges, target, max_len))
    assert all((r.start, r.end, r.hops) == (r.path[0], r.path[-1], len(r.path) - 1) for r in got)


def test_bfs_paths_of_a_wide_lattice_and_its_limit(spark):
    """Three layers of four vertices: 4 ** 3 paths into one target."""
    layers = [[10 * k + j for j in range(4)] for k in range(1, 4)]
    edges = [(0, v, 1.0) for v in layers[0]] + [(a, b, 1.0) for x, y in zip(layers, layers[1:]) for a in x for b in y] + [(v, 99, 1.0) for v in layers[2]] * 2
    v = spark.createDataFrame([(i,) for i in [0, 99, *sum(layers, [])]], "id int")
    e = spark.createDataFrame(edges, "src int, dst int, TripMiles double")
    ask = lambda limit: graph.bfs_paths(v, e, F.col("id") == 0, F.col("id") == 99, 10, limit)
    got = ask(64).collect()
    assert len({tuple(r.path) for r in got}) == len(got) == 64 and {r.hops for r in got} == {4}
    with pytest.raises(ValueError, match="64 shortest paths"):
        ask(63)


def test_bfs_paths_of_a_start_that_is_a_target_and_of_nothing(spark):
    v = spark.createDataFrame([(1,), (2,)], "id int")
    e = spark.createDataFrame([(1, 2, 1.0)], "src int, dst int, TripMiles double")
    assert [tuple(r) for r in graph.bfs_paths(v, e, F.lit(True), F.col("id") == 2).collect()] == [(2, 2, 0, [2])]
    none = graph.bfs_paths(v, e, F.col("id") == 2, F.col("id") == 1)
    assert none.collect() == [] and none.columns == ["start", "end", "hops", "path"]


def test_bfs_start_that_is_a_target(spark):
    v = spark.createDataFrame([(1,), (2,)], "id int")
    e = spark.createDataFrame([(1, 2, 1.0)], "src int, dst int, TripMiles double")
    hops = graph.bfs_first_hops(v, e, F.lit(True), F.col("id") == 2)
    assert [(r.start, r.end, r.hops) for r in hops.collect()] == [(2, 2, 0)]


def test_property_graph_calls(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b"), (7, "t")], "id int, name string")
    e = spark.createDataFrame([(1, 2, 1.0), (2, 7, 2.0), (2, 2, 0.5)], "src int, dst int, TripMiles double")
    g = graph.PropertyGraph(v, e)
    assert {(r.start, r.next_id) for r in g.bfs("id != 7", "id = 7").collect()} == {(2, 7)}
    assert g.self_loops().count() == 1
    assert set(g.triplets().columns) >= {"src_name", "dst_name"}
    ranks = {r.id: r.pagerank for r in g.pageRank(resetProbability=0.15, tol=0.01).collect()}
    want = ref_dynamic_pagerank([1, 2, 7], [(1, 2), (2, 7), (2, 2)])
    assert all(abs(ranks[k] - want[k]) < 1e-12 for k in want)


def test_cluster_conf_sizes_partitions():
    from kestrel.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4)
    assert conf["spark.sql.shuffle.partitions"] == "409600"
    assert cluster_conf(10 * 1024 ** 3)["spark.sql.shuffle.partitions"] == "200"


def ref_weighted_pagerank_redistribute(ids, wedges, d=0.85, rounds=10):
    n = len(ids)
    sum_out = defaultdict(float)
    for s, _t, w in wedges:
        sum_out[s] += w
    norm = [(s, t, 0.0 if sum_out[s] == 0 else w / sum_out[s]) for s, t, w in wedges]
    rank = {v: 1.0 / n for v in ids}
    for _ in range(rounds):
        total = defaultdict(float)
        for s, t, w in norm:
            if s in rank and t in rank:
                total[t] += rank[s] * w
        lost = sum(rank.values()) - sum(total.values())
        rank = {v: (1 - d) / n + d * (total.get(v, 0.0) + lost / n) for v in ids}
    return rank


def test_weighted_pagerank_redistribute_keeps_mass(spark):
    wedges = spark.createDataFrame(WEDGES, "src int, dst int, weight double")
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    got = {r.id: r.pagerank for r in graph.weighted_pagerank(
        ids, graph.normalize_out_weights(wedges), dangling="redistribute").collect()}
    want = ref_weighted_pagerank_redistribute(IDS, WEDGES)
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-12)


def test_triplets_one_row_per_area(spark):
    from kestrel.plans import fixtures, trips
    from tests.conftest import SMALL_DIR
    t = fixtures.trips(spark, SMALL_DIR)
    assert trips.trip_triplets(t, one_row_per_area=True).count() == trips.edges(t).count()


def test_pagerank_invariant_to_row_order(spark):
    edges = [(1, 2), (1, 2), (2, 1), (2, 3), (3, 1), (4, 1), (5, 5), (1, 3), (3, 2)]
    ids = spark.createDataFrame([(v,) for v in IDS], "id int")
    e = spark.createDataFrame(edges, "src int, dst int")
    shuffled = spark.createDataFrame(list(reversed(edges)), "src int, dst int").repartition(3)
    a = {r.id: r.pagerank for r in graph.pagerank(ids, e).collect()}
    b = {r.id: r.pagerank for r in graph.pagerank(ids, shuffled).collect()}
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_fare_table_export_is_partitioned(spark):
    import os
    import tempfile
    from kestrel.plans import fixtures, trips
    from tests.conftest import SMALL_DIR
    out = tempfile.mkdtemp(prefix="kestrel-fares-") + "/fares"
    t = fixtures.trips(spark, SMALL_DIR)
    trips.export_fare_table(t, out)
    assert any(d.startswith("start_hour=") for d in os.listdir(out))
    back = spark.read.option("header", True).csv(out)
    assert back.count() == trips.fare_table(t).count()


def test_pagerank_round_limit_raises(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src int, dst int")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    with pytest.raises(RuntimeError):
        graph.pagerank(ids, e, max_rounds=2)


def test_fare_export_writes_few_files(spark):
    import os
    import tempfile
    from kestrel.plans import fixtures, trips
    from tests.conftest import SF_DIR
    out = tempfile.mkdtemp(prefix="kestrel-fares-") + "/fares"
    t = fixtures.trips(spark, SF_DIR).repartition(16)
    trips.export_fare_table(t, out)
    for d in os.listdir(out):
        if d.startswith("start_hour="):
            assert len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".csv")]) == 1
