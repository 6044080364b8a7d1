"""Directed property graphs held as two DataFrames, and the graph
algorithms of the taxi analysis (G1-G13).

Vertices carry an ``id`` column, edges ``src`` and ``dst``. Iterative
algorithms run a short driver loop of DataFrame joins and aggregations,
one convergence check per round, and cut lineage with reliable checkpoints
(``spark.checkpoint.dir``) so a lost executor recomputes at most a few
rounds. Parallel edges are collapsed into weights once, before the loop,
so each round joins per-vertex state with distinct vertex pairs only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numeric import ratio_or_zero
from kestrel.operators.clean import drop_any_null, fill
from kestrel.session import discard, materialize

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for matching results.
# ---------------------------------------------------------------------------
# PageRank: reset probability and tolerance; damping and rounds of the weighted one.
RESET = 0.15
TOLERANCE = 0.01
DAMPING = 0.85
ROUNDS = 10
# ---------------------------------------------------------------------------


# --- tables ---------------------------------------------------------------

def endpoint_vertices(df: DataFrame, endpoints: Sequence[Mapping[str, str]]) -> DataFrame:
    """Vertex table from several endpoint column sets.

    Each mapping renames input columns to vertex columns (``id`` first, the
    same names in every mapping). Every input row yields one candidate per
    endpoint in a single scan (an exploded array, where a union would scan
    the input once per endpoint); candidates with a null are dropped and the
    rest made distinct, with duplicates combined map-side. Distinct is on
    all vertex columns, so one ``id`` may have several rows, exactly as in
    the reference."""
    candidates = F.array(*[F.struct(*[F.col(src).alias(dst) for dst, src in mapping.items()])
                           for mapping in endpoints])
    return (df.select(F.explode(candidates).alias("_v")).select("_v.*")
            .dropna(how="any").distinct())


def edge_table(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Edge table ``(src, dst, attrs...)`` keeping rows without nulls."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()]).dropna(how="any")


def triplets(edges: DataFrame, vertices: DataFrame,
             src_names: Mapping[str, str], dst_names: Mapping[str, str]) -> DataFrame:
    """Each edge with both end vertices' attributes, by two left joins.

    ``src_names``/``dst_names`` rename vertex attribute columns. An id with
    several vertex rows multiplies the edge (rows(src) x rows(dst)), as in
    the reference; pass a one-row-per-id vertex table to avoid that. A hot
    vertex id is handled by AQE's skew-join split of the edge side."""
    src_v = vertices.select(F.col("id").alias("src"),
                            *[F.col(a).alias(n) for a, n in src_names.items()])
    dst_v = vertices.select(F.col("id").alias("dst"),
                            *[F.col(a).alias(n) for a, n in dst_names.items()])
    return edges.join(src_v, "src", "left").join(dst_v, "dst", "left")


def self_loops(edges: DataFrame) -> DataFrame:
    """Edges whose two ends are the same vertex."""
    return edges.filter(F.col("src") == F.col("dst"))


def one_row_per_vertex(vertices: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """One row per non-null id (G8). Where the reference takes ``first`` of
    each column (order-dependent, and columns may come from different rows),
    this keeps the whole smallest row by (attrs...) order."""
    best = F.min(F.struct(*[F.col(a) for a in attrs])).alias("_best")
    return (vertices.filter(F.col("id").isNotNull()).groupBy("id").agg(best)
            .select("id", *[F.col(f"_best.{a}").alias(a) for a in attrs]))


def parallel_edge_weights(df: DataFrame, src: Column, dst: Column, weight: Column) -> DataFrame:
    """Sum a weight over parallel edges; drop pairs with a null."""
    return drop_any_null(df.groupBy(src.alias("src"), dst.alias("dst"))
                         .agg(F.sum(weight).alias("weight")))


def normalize_out_weights(weighted: DataFrame) -> DataFrame:
    """``norm_weight = weight / sum of the source's out-weights``, 0 when that
    sum is 0 (G12, J3, F18). The per-source sums are aggregated (combined
    map-side) and left-joined back on ``src``, as the reference does, rather
    than taken over a window: a window puts all of a hub source's pairs in
    one task, while the join lets AQE broadcast the sums when they are small
    or split the hub's partition (skew join) when they are not. The join is
    inner, so both sides are the same plan and the sums read the pairs'
    shuffle output again (exchange reuse) instead of rescanning the input;
    edges with a null ``src`` have no out-weights and are dropped
    (``parallel_edge_weights`` never yields them)."""
    sum_out = weighted.groupBy("src").agg(F.sum("weight").alias("sumOut"))
    return (weighted.join(sum_out, "src", "inner")
            .withColumn("norm_weight", ratio_or_zero("weight", "sumOut")))


# --- helpers for the loops --------------------------------------------------

def _restrict_to(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges whose two ends are both known vertex ids."""
    return (edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
            .join(ids.select(F.col("id").alias("dst")), "dst", "left_semi"))


def _cut(df: DataFrame, name: str, metrics=None):
    """Materialise a round's result as a table in the shared checkpoint
    folder; the loop continues from a plain file scan. With ``metrics``,
    also returns their values, computed by the same job."""
    return materialize(df, name, metrics)


def _along(pairs: DataFrame, state: DataFrame, end: str) -> DataFrame:
    """Edges joined to the state of their ``end`` vertex.

    Both sides are written tables, not cached or pre-partitioned frames: Spark
    broadcasts a small state, and otherwise may split the shuffle partition of
    a vertex that most edges share (skew join)."""
    return pairs.join(state, end)


# --- PageRank ----------------------------------------------------------------

def weighted_pagerank(vertex_ids: DataFrame, norm_edges: DataFrame, damping: float = DAMPING,
                      iterations: int = ROUNDS, checkpoint_every: int = 3,
                      dangling: str = "leak") -> DataFrame:
    """Fixed-round weighted PageRank.

    Start at 1/n per vertex; each round
    ``rank(v) = (1 - d) / n + d * sum(rank(u) * norm_weight(u, v))`` over
    in-edges from known vertices. With ``dangling="leak"`` (the reference)
    there is no dangling-mass term, so rank held by vertices without
    out-weight, or sent to ids outside the vertex table, is lost and ranks
    may sum below 1. ``dangling="redistribute"`` spreads that lost mass
    evenly over all vertices each round, so ranks keep summing to 1.
    Returns (id, pagerank)."""
    if dangling not in ("leak", "redistribute"):
        raise ValueError("dangling must be 'leak' or 'redistribute'")
    ids, seen = _cut(vertex_ids.select("id").distinct(), "wpagerank-ids",
                     [F.count(F.lit(1)).alias("n")])
    n = seen["n"]
    if n == 0:
        return ids.withColumn("pagerank", F.lit(None).cast("double"))
    edges = _cut(norm_edges.select("src", "dst", "norm_weight"), "wpagerank-edges")
    base = (1.0 - damping) / n
    members = ids.select("id", F.lit(True).alias("_member"), F.lit(None).cast("double").alias("contrib"))
    rank = ids.withColumn("pagerank", F.lit(1.0 / n))
    # The redistributed mass reads the rank twice more, so an uncut plan would
    # multiply from round to round.
    every = 1 if dangling == "redistribute" else checkpoint_every
    written = None
    for i in range(iterations):
        contrib = (_along(edges, rank.withColumnRenamed("id", "src"), "src")
                   .select(F.col("dst").alias("id"), F.lit(None).cast("boolean").alias("_member"),
                           (F.col("pagerank") * F.col("norm_weight")).alias("contrib")))
        # One shuffle: vertex rows and contributions meet in one aggregation;
        # contributions to ids outside the vertex table fall away.
        summed = (members.unionByName(contrib).groupBy("id")
                  .agg(F.max("_member").alias("_member"), F.sum("contrib").alias("total_contrib"))
                  .filter(F.col("_member")))
        summed = fill(summed, {"total_contrib": 0.0})
        received = F.col("total_contrib")
        if dangling == "redistribute":
            # Mass held before the round minus mass delivered to vertices:
            # one-row scalars inside the plan.
            held = rank.agg(F.sum("pagerank")).scalar()
            delivered = summed.agg(F.coalesce(F.sum("total_contrib"), F.lit(0.0))).scalar()
            received = received + (held - delivered) / F.lit(float(n))
        rank = summed.select("id", (F.lit(base) + F.lit(damping) * received).alias("pagerank"))
        if (i + 1) % every == 0 or i + 1 == iterations:
            rank, before = _cut(rank, "wpagerank"), written
            if before is not None:
                discard(before)
            written = rank
    if iterations:
        discard(ids, edges)
    return rank


def pagerank(vertex_ids: DataFrame, edges: DataFrame, reset: float = RESET, tol: float = TOLERANCE,
             max_rounds: int | None = None) -> DataFrame:
    """PageRank to a tolerance (G9), with the dynamic (delta-propagating)
    semantics of the GraphX implementation behind the reference's call.

    Every vertex starts with rank ``reset`` and pending change ``reset``.
    Each round, vertices that changed in the previous round by more than
    ``tol`` send ``change / out_degree`` along each out-edge (parallel edges
    each count); a vertex that receives ``m`` adds ``(1 - reset) * m`` to its
    rank and that becomes its change. Rounds stop when nothing is sent; ranks
    are then scaled to sum to the number of vertices. Edges with an end
    outside the vertex table are ignored. Returns (id, pagerank).

    The loop has no round limit: what is sent shrinks by ``1 - reset`` each
    round. With ``max_rounds``, reaching it before convergence raises."""
    keep = 1.0 - reset
    first = keep * (reset / keep)
    sending = F.col("active") & (F.col("delta") > tol)
    senders_metric = [F.count(F.when(sending, 1)).alias("senders")]
    # The state feeds each round twice (as senders and as the base), so each
    # round is written out: the plan stays a file scan instead of doubling.
    # The same write job counts next round's senders.
    state, seen = _cut(vertex_ids.select("id").distinct()
                       .select("id", F.lit(first).alias("pr"), F.lit(first).alias("delta"),
                               F.lit(True).alias("active")), "pagerank", senders_metric)
    # Parallel edges are counted first (combined map-side, so raw edges are
    # shuffled once, already collapsed per task); only distinct pairs meet the
    # vertex table and their out-degrees.
    mult = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_mult"))
    known = _cut(_restrict_to(mult, state.select("id")), "pagerank-pairs")
    out_deg = known.groupBy("src").agg(F.sum("_mult").alias("_deg"))
    weights = _cut(known.join(out_deg, "src")
                   .select("src", "dst", (F.col("_mult") / F.col("_deg")).alias("w")), "pagerank-weights")
    discard(known)
    null_d = F.lit(None).cast("double")
    round_no = 0
    while seen["senders"]:
        if round_no == max_rounds:
            raise RuntimeError(f"PageRank has not converged after {max_rounds} rounds")
        round_no += 1
        senders = state.filter(sending).select(F.col("id").alias("src"), "delta")
        msgs = (_along(weights, senders, "src")
                .select(F.col("dst").alias("id"), null_d.alias("pr"), null_d.alias("delta"),
                        (F.col("delta") * F.col("w")).alias("msg")))
        merged = (state.select("id", "pr", "delta", null_d.alias("msg")).unionByName(msgs)
                  .groupBy("id").agg(F.max("pr").alias("pr"), F.max("delta").alias("delta"),
                                     F.sum("msg").alias("msg")))
        new_pr = F.col("pr") + F.lit(keep) * F.col("msg")
        got = F.col("msg").isNotNull()
        before = state
        state, seen = _cut(merged.select(
            "id",
            F.when(got, new_pr).otherwise(F.col("pr")).alias("pr"),
            F.when(got, new_pr - F.col("pr")).otherwise(F.col("delta")).alias("delta"),
            got.alias("active")), "pagerank", senders_metric)
        discard(before)
    discard(weights)
    total = state.agg(F.sum("pr")).scalar()
    count = state.agg(F.count(F.lit(1))).scalar()
    return state.select("id", (F.col("pr") * count / total).alias("pagerank"))


# --- breadth-first search ------------------------------------------------------

def _levels(flags: DataFrame, pairs: DataFrame, max_path_length: int) -> tuple[list[DataFrame], int | None]:
    """Vertices by hop distance to the nearest target, as one written table
    (id, _is_start) per distance, and the smallest distance of a start (None
    if none is within ``max_path_length``). ``flags``: id, _from, _to."""
    start_flags = flags.select("id", F.col("_from").alias("_is_start"))
    # Each level is written out once; `visited` is the union of the level
    # tables, so the plan grows by one file scan per level.
    levels = [_cut(flags.filter("_to").select("id", F.lit(False).alias("_is_start")), "bfs-level")]
    for k in range(1, max_path_length + 1):
        visited = levels[0].select("id")
        for level in levels[1:]:
            visited = visited.unionByName(level.select("id"))
        step = (_along(pairs, levels[-1].select(F.col("id").alias("dst")), "dst")
                .select(F.col("src").alias("id")).distinct()
                .join(visited, "id", "left_anti")
                .join(start_flags, "id", "left")
                .select("id", F.coalesce("_is_start", F.lit(False)).alias("_is_start")))
        step, stats = _cut(step, "bfs-level", [F.count(F.lit(1)).alias("n"),
                                               F.max("_is_start").alias("hit")])
        if not stats["n"]:
            return levels, None
        levels.append(step)
        if stats["hit"]:
            return levels, k
    return levels, None


def _on_shortest(levels: list[DataFrame], depth: int, pairs: DataFrame) -> list[DataFrame]:
    """The vertices of each level that a shortest path runs through, found
    forwards: starts (distance ``depth``) first, distance 1 last."""
    on_path = [levels[depth].filter("_is_start").select("id")]
    for k in range(depth - 1, 0, -1):
        nexts = (_along(pairs, on_path[-1].select(F.col("id").alias("src")), "src")
                 .select(F.col("dst").alias("id")).distinct().join(levels[k].select("id"), "id", "left_semi"))
        on_path.append(_cut(nexts, "bfs-path"))
    return on_path


def _flags(vertices: DataFrame, from_cond: Column, to_cond: Column) -> DataFrame:
    """One small table of per-vertex flags, written once, so the loop never
    goes back to the (possibly huge) input the vertices came from."""
    return _cut(vertices.groupBy("id").agg(
        F.max(F.coalesce(from_cond, F.lit(False))).alias("_from"),
        F.max(F.coalesce(to_cond, F.lit(False))).alias("_to")), "bfs-vertices")


def bfs_first_hops(vertices: DataFrame, edges: DataFrame, from_cond: Column, to_cond: Column,
                   max_path_length: int = 10, distinct_pairs: bool = False) -> DataFrame:
    """Shortest paths from vertices matching ``from_cond`` to vertices
    matching ``to_cond`` (G6), reported by their first edge.

    As in GraphFrames' BFS, only paths of the single shortest length D
    (over all start/end pairs, D <= ``max_path_length``) count, paths move
    through vertices of the vertex table only, and parallel edges are
    separate paths. Rather than listing every path (their number grows
    exponentially with D), the result holds one row per (start, end, first
    edge) on some shortest path: ``start, end, hops, next_id`` plus the
    first edge's attribute columns. Empty when no path exists.

    ``distinct_pairs=True`` declares that ``edges`` already has one row per
    (src, dst) (as ``min_per_pair`` returns), which saves a deduplication.

    Method: hop distances to the nearest target are found by expanding a
    frontier backwards from all targets at once; the state is one row per
    vertex. D is the smallest distance of a start, so every shortest path
    steps from distance to distance - 1. Targets are carried only along those
    paths: the vertices on them are found forwards from the starts, then the
    targets travel back over them."""
    flags = _flags(vertices, from_cond, to_cond)
    ids = flags.select("id")
    # Used by the search (as distinct pairs) and by the final first-hop join.
    known = _cut(_restrict_to(edges, ids), "bfs-edges")
    attrs = [c for c in known.columns if c not in ("src", "dst")]
    starts = flags.filter("_from").select("id")
    targets = flags.filter("_to").select("id")

    zero = targets.join(starts, "id", "left_semi")
    if not zero.isEmpty():
        return zero.select(F.col("id").alias("start"), F.col("id").alias("end"),
                           F.lit(0).alias("hops"), F.lit(None).cast(ids.schema["id"].dataType).alias("next_id"),
                           *[F.lit(None).cast(known.schema[a].dataType).alias(a) for a in attrs])

    pairs = known if distinct_pairs else _cut(known.select("src", "dst").distinct(), "bfs-pairs")
    pairs, collapsed = pairs.select("src", "dst"), pairs
    levels, depth = _levels(flags, pairs, max_path_length)
    if depth is None:
        empty = (known.select(F.col("src").alias("start"), F.col("dst").alias("end"), F.lit(0).alias("hops"),
                              F.col("dst").alias("next_id"), *attrs).schema)
        discard(flags, known, *levels)
        if collapsed is not known:
            discard(collapsed)
        return vertices.sparkSession.createDataFrame([], empty)

    on_path = _on_shortest(levels, depth, pairs)
    # Backwards: the targets each of them leads to.
    reach = levels[0].select("id", F.col("id").alias("target"))
    carried = []
    for k in range(1, depth):
        step = (_along(pairs, reach.withColumnRenamed("id", "dst"), "dst").select(F.col("src").alias("id"), "target")
                .join(on_path[depth - k], "id", "left_semi").distinct())
        reach = _cut(step, "bfs-reach")
        carried.append(reach)
    first = _cut(_along(known, on_path[0].select(F.col("id").alias("src")), "src")
                 .join(reach.withColumnRenamed("id", "dst"), "dst")
                 .select(F.col("src").alias("start"), F.col("target").alias("end"),
                         F.lit(depth).alias("hops"), F.col("dst").alias("next_id"), *attrs), "bfs-first-hops")
    discard(flags, known, *levels, *on_path[1:], *carried)
    if collapsed is not known:
        discard(collapsed)
    return first


def bfs_paths(vertices: DataFrame, edges: DataFrame, from_cond: Column, to_cond: Column,
              max_path_length: int = 10, max_paths_per_pair: int = 100_000,
              distinct_pairs: bool = False) -> DataFrame:
    """Every shortest path from vertices matching ``from_cond`` to vertices
    matching ``to_cond`` (G6): ``start, end, hops, path`` with ``path`` the
    array of vertex ids, start and end included.

    As in ``bfs_first_hops`` only paths of the single shortest length count,
    through vertices of the vertex table; parallel edges are one path here,
    since they run through the same vertices. Empty when no path exists.

    The number of shortest paths of a pair can grow exponentially with their
    length. It is counted first, over the predecessor graph, and more than
    ``max_paths_per_pair`` of any (start, end) raise ``ValueError`` before a
    path is built; nothing is cut off.

    Method: the search finds the vertices of each distance that lie on a
    shortest path. The edges between consecutive distances are the predecessor
    graph, one small written table per level; counts, then arrays, are carried
    along it from the starts, level by level."""
    flags = _flags(vertices, from_cond, to_cond)
    id_type = flags.schema["id"].dataType
    columns = ("start", "end", "hops", "path")
    both = flags.filter("_from and _to")
    if not both.isEmpty():
        return both.select(F.col("id").alias("start"), F.col("id").alias("end"), F.lit(0).alias("hops"), F.array("id").alias("path"))
    known = _restrict_to(edges.select("src", "dst"), flags.select("id"))
    pairs = _cut(known if distinct_pairs else known.distinct(), "bfs-pairs")
    levels, depth = _levels(flags, pairs, max_path_length)
    if depth is None:
        discard(flags, pairs, *levels)
        return vertices.sparkSession.createDataFrame(
            [], f"start {id_type.simpleString()}, end {id_type.simpleString()}, hops int, path array<{id_type.simpleString()}>")
    on_path = _on_shortest(levels, depth, pairs)
    ahead = [*on_path[1:], levels[0].select("id")]
    steps = [_cut(_along(pairs, here.select(F.col("id").alias("src")), "src")
                  .join(there.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst"), "bfs-steps")
             for here, there in zip(on_path, ahead)]
    starts = on_path[0].select(F.col("id").alias("start"), F.col("id").alias("src"))

    # Doubles: exact far beyond any usable limit, and they do not overflow.
    counts, seen = starts.withColumn("n", F.lit(1.0)), {"most": 0}
    for step in steps:
        counts, seen = _cut(_along(step, counts, "src").groupBy("start", F.col("dst").alias("src")).agg(F.sum("n").alias("n")),
                            "bfs-counts", [F.max("n").alias("most")])
    if seen["most"] > max_paths_per_pair:
        raise ValueError(f"a pair has {seen['most']:.0f} shortest paths, more than max_paths_per_pair = {max_paths_per_pair}")

    paths = starts.withColumn("path", F.array("src"))
    for step in steps:
        paths = _cut(_along(step, paths, "src").select("start", F.col("dst").alias("src"), F.array_append("path", F.col("dst")).alias("path")),
                     "bfs-paths")
    discard(flags, pairs, *levels, *on_path[1:], *steps)
    return paths.select("start", F.col("src").alias("end"), F.lit(depth).alias("hops"), "path").select(*columns)


def min_per_pair(edges: DataFrame, attr: str) -> DataFrame:
    """One edge per (src, dst) carrying the smallest ``attr`` of its parallel
    edges. Feeding this to ``bfs_first_hops`` leaves ``bfs_summary`` unchanged
    (the smallest first leg over shortest paths is the smallest over the
    pair's edges) while the search and the first-hop join read distinct
    pairs instead of every edge; the collapse combines map-side."""
    return edges.groupBy("src", "dst").agg(F.min(attr).alias(attr))


def bfs_summary(first_hops: DataFrame, end: object | None = None, attr: str = "TripMiles",
                start_name: str = "startComm", end_name: str = "landmark",
                value_name: str = "shortestMiles") -> DataFrame:
    """Per start: the end reached and the smallest first-edge ``attr`` among
    its shortest paths (G7, A6, A7). ``end`` keeps paths to that end only."""
    hops = first_hops if end is None else first_hops.filter(F.col("end") == F.lit(end))
    return hops.groupBy(F.col("start").alias(start_name)).agg(
        F.min("end").alias(end_name), F.min(attr).alias(value_name))


# --- a graph value with the calls the taxi analysis makes -------------------

class PropertyGraph:
    """Vertices ``(id, ...)`` and edges ``(src, dst, ...)`` as one value
    (G3), with the GraphFrames-style calls the reference uses. Conditions
    may be SQL text (``"id != '49'"``) or Columns."""

    def __init__(self, vertices: DataFrame, edges: DataFrame):
        self.vertices = vertices
        self.edges = edges

    @staticmethod
    def _cond(expr: str | Column) -> Column:
        return F.expr(expr) if isinstance(expr, str) else expr

    def triplets(self) -> DataFrame:
        """Edges with ``src_*`` / ``dst_*`` vertex attributes."""
        attrs = [c for c in self.vertices.columns if c != "id"]
        return triplets(self.edges, self.vertices,
                        {a: f"src_{a}" for a in attrs}, {a: f"dst_{a}" for a in attrs})

    def self_loops(self) -> DataFrame:
        return self_loops(self.edges)

    def bfs(self, fromExpr: str | Column, toExpr: str | Column,  # noqa: N803 - GraphFrames names
            maxPathLength: int = 10, distinct_pairs: bool = False) -> DataFrame:  # noqa: N803
        """First legs of the shortest paths (see ``bfs_first_hops``)."""
        return bfs_first_hops(self.vertices, self.edges, self._cond(fromExpr), self._cond(toExpr),
                              maxPathLength, distinct_pairs)

    def bfsPaths(self, fromExpr: str | Column, toExpr: str | Column,  # noqa: N802,N803
                 maxPathLength: int = 10, maxPathsPerPair: int = 100_000) -> DataFrame:  # noqa: N803
        """The shortest paths themselves (see ``bfs_paths``)."""
        return bfs_paths(self.vertices, self.edges, self._cond(fromExpr), self._cond(toExpr), maxPathLength, maxPathsPerPair)

    def pageRank(self, resetProbability: float = RESET, tol: float = TOLERANCE) -> DataFrame:  # noqa: N802,N803
        """``(id, pagerank)`` to a tolerance (see ``pagerank``)."""
        return pagerank(self.vertices, self.edges, reset=resetProbability, tol=tol)
