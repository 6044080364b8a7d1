"""Plan-shape checks: the physical plans keep the properties the design
relies on (no Python evaluation, pruned scans, pre-aggregation, exchange
reuse)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_DIR

QUERIES = entry_mod.queries()
BATCH = sorted(n for n in QUERIES if not n.endswith("_stream")
               and n not in ("trips_bfs_summary", "supply_bfs_summary", "trips_pagerank",
                             "trips_weighted_pagerank"))


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_evaluation(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in plan, f"{name} evaluates Python: {node}"


def test_share_of_total_reuses_the_grouped_shuffle(spark):
    df = QUERIES["tweets_day_share"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_ratings_aggregate_per_movie_before_join(spark):
    plan = plan_of(QUERIES["ratings_genre_counts"](spark, SF_DIR))
    join_at = plan.index("Join")
    # The per-movie aggregate sits below (after, in the printed tree) the join.
    assert re.search(r"HashAggregate\(keys=\[movieId#\d+L\], functions=\[count", plan[join_at:])


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["trips_fare_correlations"](spark, SF_DIR))
    lineitem = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert lineitem
    for unwanted in ("l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber"):
        assert unwanted not in lineitem[0]


def test_correlations_in_one_pass(spark):
    plan = plan_of(QUERIES["trips_fare_correlations"](spark, SF_DIR))
    assert plan.count("covar_pop") >= 3
    # One global aggregate: a single exchange to one partition.
    assert plan.count("Exchange SinglePartition") == 1


def test_top_k_is_take_ordered(spark):
    for name in ("tweets_top_locations", "ratings_top_movies", "ratings_top_raters"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))


def test_supply_pairs_equal_min_per_pair_of_line_item_edges(spark):
    from kestrel.operators import graph
    from kestrel.plans import fixtures
    _, edges = fixtures.supply_graph(spark, SF_DIR)
    expected = graph.min_per_pair(edges, "TripMiles")
    collapsed = fixtures.supply_pairs(spark, SF_DIR)
    assert collapsed.exceptAll(expected).count() == 0
    assert expected.exceptAll(collapsed).count() == 0
    # The collapse groups the numeric key pair, before any text id exists.
    plan = plan_of(collapsed)
    assert re.search(r"HashAggregate\(keys=\[l_suppkey#\d+L, l_partkey#\d+L\]", plan)


def test_out_weight_sums_reuse_the_pair_shuffle(spark):
    df = QUERIES["trips_weighted_edges"](spark, SF_DIR)
    df.collect()
    plan = plan_of(df)
    # Per-source sums joined back (no window holding a hub's pairs in one
    # task), computed from the pairs' shuffle output rather than a rescan.
    assert "Window" not in plan
    assert "ReusedExchange" in plan
