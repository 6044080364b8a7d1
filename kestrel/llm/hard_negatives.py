"""Hard-negative mining over a GNAT-style hyperplane tree (operator 11).

Vectors become integers floor(256 x); a score is an integer inner product.
With one more component, sqrt(M - x.x) where M is the largest squared length
of all rows, every vector has length sqrt(M) and its distance from a query
(whose extra component is 0) falls strictly as their score rises, so a window
of scores is an annulus of distances around the query.

The tree. Each inner node has up to ``FAN_OUT`` split points; a vector belongs
to the subtree of its nearest one (the cells of the hyperplanes between them),
down to leaf cells. The split points are fitted on the ``SAMPLE_ROWS`` vectors
with the smallest hash of their content, whose number is a parameter and
bounds the tree. Then every row is routed to its leaf cell, and an aggregate
over all rows finds for every split point the smallest and largest distance to
the members of each sibling subtree. A query leaves out a sibling if the range
the sibling's members have from a split point misses the distances that the
window's annulus allows there (the query's distance to the split point, plus
or minus the annulus). Leaf cells are stored as blocks of ``BLOCK_ROWS`` rows
in order of distance to their split point, each with its own range, and are
scored exactly with integer arithmetic.

Two searches use it: the positives of an anchor (same label, scores from the
fifth best that the sample holds upwards), then the negatives of every positive
(other labels, scores in 50 to 95 percent of the positive's, from the third
best that the sample holds upwards). The sample only narrows the windows: it
is part of the rows, so what it holds is a proven lower bar, and without
enough of it the window stays whole. Anchors travel in blocks of
``QUERY_ROWS`` that are neighbours in the order of cells; a block meets a leaf block once, by equi-join
on the cell, if any window of any of its anchors may reach it.

Copies: rows equal in vector and label answer alike but for their vec_id. At
most ``POSITIVES`` + 1 of them, those with the smallest vec_id, can be in any
answer (one may be the anchor itself, ties go to the smaller vec_id), so the
others are dropped before the shuffle, however many there are.

Defined results
    null label, null vector, null or non-finite component, null vec_id
                          take no part
    components whose integer is ``LARGEST`` or more in size
                          take no part: scores would leave the range of a long
    vectors of different lengths
                          missing components count as 0
    repeated rows         rows equal in vec_id, vector and label stand once
    repeated vec_id       rows with the anchor's vec_id are never its positives
                          or negatives; as an anchor a repeated vec_id stands
                          once (its smallest vector, then label)
    ties                  by smaller vec_id (then smaller vector, label)
    no positives, or no row in a window
                          no rows for that anchor or positive
    negative positive scores
                          their window is empty
    empty table           empty result
    extra columns         ignored
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.textcols import small_batches
from kestrel.session import discard, materialize

SCALE = 256
ANCHOR_STEP = 50
POSITIVES = 5
NEGATIVES = 3
LEAST_PERCENT = 50
MOST_PERCENT = 95
LARGEST = 1 << 22
SAMPLE_ROWS = 8192
FAN_OUT = 8
LEAF_SAMPLE = 64  # a subtree of so few sample rows, or expected
LEAF_ROWS = 2048  # to hold so few rows of all, is a leaf
BLOCK_ROWS = 4096
PART_BLOCKS = 16
QUERY_ROWS = 256
SLACK = 1e-6  # relative; rounding of distances is near 1e-14
NO_LEAST, NO_MOST = -(1 << 62), 1 << 62
EXACT_FLOAT = 1 << 53

BLOCKS = "cell int, count long, near double, far double, ids binary, labels binary, vectors binary"
GROUPS = "cells array<int>, queries binary, ids binary, labels binary, windows binary"
FOUND = "anchor_id long, slot int, vec_id long, score long"


# --- rows ---------------------------------------------------------------------------

def usable_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and integer vector of the rows that take part, equal rows once."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) < LARGEST))
    return (embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int")).alias("vector")))


def shifted_label(vec_id: Column, label: Column) -> Column:
    """The contract's labels: rows whose vec_id 7 divides take the next of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, padded with zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    # int32 holds LARGEST, so no absolute value leaves it.
    largest = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if largest < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


# --- the tree -------------------------------------------------------------------------

@dataclass
class Node:
    """Split points with, for each, the subtree that holds what is nearest to
    it: another node's number, or ~cell. ``near`` and ``far`` [i, j] are the
    least and greatest distance from split point i to the members of j."""
    points: np.ndarray
    children: list[int] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


class Tree:
    """Routing part of the tree: what is fitted on the sample."""

    def __init__(self, sample: np.ndarray, longest: int, rows: int):
        self.width, self.longest = sample.shape[1], longest
        self._leaf = max(LEAF_SAMPLE, LEAF_ROWS * len(sample) // max(1, rows))
        self.nodes: list[Node] = []
        self.cells = 0
        self._grow(sample)

    def _grow(self, x: np.ndarray) -> int:
        points = self._spread(x) if len(x) > self._leaf else x[:0]
        if len(points) < 2:
            self.cells += 1
            return ~(self.cells - 1)
        at = len(self.nodes)
        node = Node(points)
        self.nodes.append(node)
        nearest = self._distances(x, points).argmin(axis=1)
        node.children = [self._grow(x[nearest == i]) for i in range(len(points))]
        return at

    def _spread(self, x: np.ndarray) -> np.ndarray:
        """Split points far from each other, out of three times as many rows:
        each next one is the row that is farthest from those before it."""
        x = x[:: max(1, len(x) // (3 * FAN_OUT))][:3 * FAN_OUT]
        chosen = [0]
        least = self._distances(x, x[:1])[:, 0] if len(x) else np.zeros(0)
        while len(x) and len(chosen) < FAN_OUT and least.max() > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, self._distances(x, x[chosen[-1:]])[:, 0])
        return x[chosen] if len(x) else x

    def cell_points(self) -> dict[int, np.ndarray]:
        """The split point of each leaf cell."""
        return {~child: node.points[i] for node in self.nodes for i, child in enumerate(node.children) if child < 0}

    def extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.longest - (x.astype(np.float64) ** 2).sum(axis=1)))

    def _distances(self, x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances between rows with the extra component."""
        apart = 2.0 * self.longest - 2.0 * (scores(x, points) + self.extra(x)[:, None] * self.extra(points)[None, :])
        apart = np.sqrt(np.maximum(0.0, apart))
        # Rows at no distance come out as the root of a rounding error.
        apart[apart < SLACK * math.sqrt(self.longest + 1.0)] = 0.0
        return apart

    def of_score(self, q: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Distance from query rows (extra component 0) at which scores lie."""
        squared = (q.astype(np.float64) ** 2).sum(axis=1)
        return np.sqrt(np.maximum(0.0, self.longest + squared.reshape(-1, *[1] * (s.ndim - 1)) - 2.0 * s))

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """Leaf cell of each row, its distance to the cell's split point, and
        per node passed: its number, the rows, their branch, and their
        distances to all its split points."""
        cell, own, steps = np.zeros(len(x), np.int32), np.zeros(len(x)), []
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            apart = self._distances(x[rows], node.points)
            branch = apart.argmin(axis=1)
            steps.append((at, rows, branch, apart))
            for i, child in enumerate(node.children):
                mine = rows[branch == i]
                if child >= 0:
                    todo.append((child, mine))
                else:
                    cell[mine], own[mine] = ~child, apart[branch == i, i]
        return cell, own, steps

    def reachable(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """[row, cell]: may the cell hold a score in the row's windows? ``low``
        and ``high`` [row, window] are scores; low > high is no window."""
        out = np.zeros((len(q), max(1, self.cells)), bool)
        none = low > high
        inner = np.where(none, np.inf, self.of_score(q, np.minimum(high, self.longest * 4.0)))
        outer = np.where(none, -np.inf, self.of_score(q, np.maximum(low, -self.longest * 4.0)))
        if not self.nodes:
            out[:] = (~none).any(axis=1)[:, None]
            return out
        slack = SLACK * math.sqrt(self.longest + 1.0)
        todo = [(0, np.flatnonzero((~none).any(axis=1)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            apart = self.of_score(q[rows], scores(q[rows], node.points))[:, :, None]
            # Distances from each split point that a row in the window may have.
            least = np.maximum(inner[rows][:, None, :] - apart, apart - outer[rows][:, None, :])
            most = apart + outer[rows][:, None, :]
            for j, child in enumerate(node.children):
                meets = (node.near[None, :, j, None] <= most + slack) & (node.far[None, :, j, None] >= least - slack)
                stay = rows[meets.all(axis=1).any(axis=1)]
                if child >= 0:
                    todo.append((child, stay))
                else:
                    out[stay, ~child] = True
        return out


def _extent(rows: DataFrame) -> tuple[int, int, int]:
    """Largest squared length, largest number of components, number of rows."""
    squared = F.aggregate("vector", F.lit(0).cast("long"), lambda s, v: s + v.cast("long") * v.cast("long"))
    found = rows.agg(F.max(squared), F.max(F.size("vector")), F.count("*")).first()
    return found[0] or 0, found[1] or 0, found[2]


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Tree, list]:
    """The routing tree and the sample it is fitted on (at most
    ``sample_rows`` rows, in the driver): the only bounded part of the index."""
    longest, width, n = _extent(rows)
    sample = rows.orderBy(F.xxhash64("vector", "vec_id"), "vec_id", "label").limit(sample_rows).collect()
    x = np.zeros((len(sample), width), np.int32)
    for k, row in enumerate(sample):
        x[k, :len(row["vector"])] = row["vector"]
    return Tree(x, longest, n), [np.asarray([r["vec_id"] for r in sample], np.int64),
                              np.asarray([r["label"] for r in sample], np.int64), x]


def _route(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell, own, _ = tree.route(_matrix(batch.column("vector"), tree.width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(own)],
                                                 names=[*batch.schema.names, "cell", "own"])
    return run


def _spans(tree: Tree):
    """Per task and pair (split point, sibling subtree): the range of distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [np.full((len(n.points),) * 2, np.inf) for n in tree.nodes]
        far = [np.full((len(n.points),) * 2, -np.inf) for n in tree.nodes]
        for batch in batches:
            for at, _, branch, apart in tree.route(_matrix(batch.column("vector"), tree.width))[2]:
                for j in np.unique(branch):
                    near[at][:, j] = np.minimum(near[at][:, j], apart[branch == j].min(axis=0))
                    far[at][:, j] = np.maximum(far[at][:, j], apart[branch == j].max(axis=0))
        rows = [(at, i, j, near[at][i, j], far[at][i, j]) for at in range(len(near)) for i, j in np.argwhere(far[at] >= near[at]).tolist()]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("node", "point", "branch", "near", "far"), map(list, zip(*rows)))),
                                             schema=pa.schema([("node", pa.int32()), ("point", pa.int32()), ("branch", pa.int32()),
                                                               ("near", pa.float64()), ("far", pa.float64())]))
    return run


def measure(tree: Tree, rows: DataFrame) -> Tree:
    """Fill the tree's distance ranges from all rows. The result has one row
    per pair of split points of a node: bounded by the sample, not the table."""
    ranges = (rows.select("vector").mapInArrow(_spans(tree), "node int, point int, branch int, near double, far double")
              .groupBy("node", "point", "branch").agg(F.min("near").alias("near"), F.max("far").alias("far"))).collect()
    for node in tree.nodes:
        node.near = np.full((len(node.points),) * 2, np.inf)
        node.far = np.full((len(node.points),) * 2, -np.inf)
    for r in ranges:
        tree.nodes[r["node"]].near[r["point"], r["branch"]] = r["near"]
        tree.nodes[r["node"]].far[r["point"], r["branch"]] = r["far"]
    return tree


# --- leaves -----------------------------------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch], rows: int, one_cell: bool) -> Iterator[pa.Table]:
    """Tables of at most ``rows`` rows, of one cell if so asked, from rows sorted by cell."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        cells = table["cell"].to_numpy() if one_cell else np.zeros(len(table), np.int32)
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)]
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                if held and (one_cell and held[0]["cell"][0].as_py() != cells[a] or sum(map(len, held)) >= rows):
                    yield pa.concat_tables(held).combine_chunks()
                    held = []
                take = min(b - a, rows - sum(map(len, held)))
                held.append(table.slice(a, take))
                a += take
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _array(table: pa.Table, name: str) -> pa.Array:
    column = table[name]
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _leaf_blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches, BLOCK_ROWS, True):
            own = part["own"].to_numpy()
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array([part["cell"][0].as_py()], pa.int32()), "count": pa.array([len(part)], pa.int64()), "near": [float(own.min())], "far": [float(own.max())],
                "ids": pa.array([part["vec_id"].to_numpy().tobytes()], pa.binary()),
                "labels": pa.array([part["label"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([_matrix(_array(part, "vector"), width).astype(np.int32).tobytes()], pa.binary())})
    return run


def build_leaves(tree: Tree, rows: DataFrame) -> DataFrame:
    """All rows as blocks of leaf cells. A cell of any size is spread: rows are
    range-partitioned by cell and distance to the cell's split point."""
    routed = rows.mapInArrow(_route(tree), "vec_id long, label int, vector array<int>, cell int, own double")
    order = ["cell", "own", "vec_id"]
    return (materialize(routed, "gnat-routed").repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(_leaf_blocks(tree.width), BLOCKS))


# --- queries --------------------------------------------------------------------------------

def best(owner: np.ndarray, ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Indices of each owner's k best by score, then smaller id."""
    order = np.lexsort((ids, -found, owner))
    owner = owner[order]
    return order[np.arange(len(order)) - np.searchsorted(owner, owner) < k]


def in_window(s: np.ndarray, own: np.ndarray, same: np.ndarray, windows: np.ndarray, want_same: bool) -> np.ndarray:
    """[row, window, candidate]: does the candidate count for the window?"""
    allowed = ~own & (same if want_same else ~same)
    return allowed[:, None, :] & (s[:, None, :] >= windows[:, :, :1]) & (s[:, None, :] <= windows[:, :, 1:])


def raised(sample: list, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, windows: np.ndarray, want_same: bool, k: int) -> np.ndarray:
    """``windows`` [row, window, 2] with the lower end at the k-th best score
    that the sample holds in the window, where it holds k."""
    at, of, x = sample
    out = windows.copy()
    if len(at) < k:
        return out
    s = scores(q, x)
    own, same = ids[:, None] == at[None, :], labels[:, None] == of[None, :]
    for w in range(windows.shape[1]):
        fits = in_window(s, own, same, windows[:, w:w + 1], want_same)[:, 0]
        kth = np.partition(np.where(fits, s, NO_LEAST), len(at) - k, axis=1)[:, len(at) - k]
        out[:, w, 0] = np.maximum(out[:, w, 0], kth)
    return out


def _query_groups(tree: Tree, sample: list, want_same: bool, k: int):
    """Blocks of anchors with the cells that their windows may reach.
    Rows: vec_id, label, vector, cell, lows and highs (scores)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches, QUERY_ROWS, False):
            ids, labels = part["vec_id"].to_numpy(), part["label"].to_numpy().astype(np.int64)
            q = _matrix(_array(part, "vector"), tree.width)
            most = max(map(len, part["lows"].to_pylist()))
            # Rows with fewer windows are filled up with empty ones.
            windows = np.stack([np.full((len(ids), most), NO_MOST), np.full((len(ids), most), NO_LEAST)], axis=2)
            for side, name in enumerate(("lows", "highs")):
                for row, values in enumerate(part[name].to_pylist()):
                    windows[row, :len(values), side] = values
            windows = raised(sample, ids, labels, q, windows, want_same, k)
            cells = np.flatnonzero(tree.reachable(q, windows[:, :, 0], windows[:, :, 1]).any(axis=0))
            yield pa.RecordBatch.from_pydict({
                "cells": pa.array([cells.tolist()], pa.list_(pa.int32())), "queries": pa.array([q.astype(np.int32).tobytes()], pa.binary()),
                "ids": pa.array([ids.tobytes()], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary()),
                "windows": pa.array([windows.tobytes()], pa.binary())})
    return run


def search_block(tree: Tree, row: dict, want_same: bool, k: int) -> tuple[np.ndarray, ...]:
    """Anchor ids, windows, ids and scores: the k best of one leaf block for
    every window of one block of anchors."""
    read = lambda name, kind=np.int64: np.frombuffer(row[name], kind)
    q_ids, q_labels = read("q_ids"), read("q_labels")
    q, windows = read("queries", np.int32).reshape(len(q_ids), -1), read("windows").reshape(len(q_ids), -1, 2)
    at, of = read("ids"), read("labels")
    x = read("vectors", np.int32).reshape(len(at), tree.width)
    s = scores(q, x)
    own, same = q_ids[:, None] == at[None, :], q_labels[:, None] == of[None, :]
    parts = []
    for w in range(windows.shape[1]):
        fits = in_window(s, own, same, windows[:, w:w + 1], want_same)[:, 0]
        qi, xi = np.nonzero(fits)
        keep = best(qi, at[xi], s[qi, xi], k)
        qi, xi = qi[keep], xi[keep]
        parts.append((q_ids[qi], np.full(len(qi), w, np.int32), at[xi], s[qi, xi]))
    return tuple(map(np.concatenate, zip(*parts)))


def _near_enough(tree: Tree, row: dict) -> bool:
    """Does any anchor's annulus meet the block's range around its split point?"""
    point = tree.cell_points().get(row["cell"])
    if point is None:
        return True
    q = np.frombuffer(row["queries"], np.int32).reshape(-1, tree.width)
    windows = np.frombuffer(row["windows"], np.int64).reshape(len(q), -1, 2)
    apart = tree.of_score(q, scores(q, point[None, :]))
    inner = tree.of_score(q, np.minimum(windows[:, :, 1], tree.longest * 4.0))
    outer = tree.of_score(q, np.maximum(windows[:, :, 0], -tree.longest * 4.0))
    slack = SLACK * math.sqrt(tree.longest + 1.0)
    meets = ((windows[:, :, 0] <= windows[:, :, 1]) & (row["near"] <= apart + outer + slack)
             & (row["far"] >= np.maximum(inner - apart, apart - outer) - slack))
    return bool(meets.any())


def _search(tree: Tree, want_same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if _near_enough(tree, row):
                    found = search_block(tree, row, want_same, k)
                    yield pa.RecordBatch.from_pydict(dict(zip(("anchor_id", "slot", "vec_id", "score"), map(pa.array, found))))
    return run


def _parts_by_cell(cells: list) -> list[int]:
    """Parts of each cell number from 0; a cell without rows has none to meet."""
    blocks = {r["cell"]: r["n"] for r in cells}
    return [max(1, -(-blocks.get(c, 0) // PART_BLOCKS)) for c in range(max(blocks, default=0) + 1)]


def range_search(tree: Tree, sample: list, leaves: DataFrame, queries: DataFrame, want_same: bool, k: int) -> DataFrame:
    """anchor_id, slot (number of the window), vec_id, score and rank of the k
    best rows in every window. ``queries``: vec_id, label, vector, lows, highs."""
    routed = queries.select("vec_id", "label", "vector", "lows", "highs").mapInArrow(
        _route(tree), "vec_id long, label int, vector array<int>, lows array<long>, highs array<long>, cell int, own double")
    groups = materialize(
        routed.repartitionByRange("cell", "own", "vec_id").sortWithinPartitions("cell", "own", "vec_id")
        .mapInArrow(_query_groups(tree, sample, want_same, k), GROUPS), "gnat-queries")
    # Number of parts by cell: as many entries as the routing tree has leaves.
    cells = leaves.groupBy("cell").agg(F.count("*").alias("n")).collect()
    parts = F.array(*[F.lit(n) for n in _parts_by_cell(cells)])
    asked = groups.select(F.explode("cells").alias("cell"), "queries", F.col("ids").alias("q_ids"), F.col("labels").alias("q_labels"), "windows")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("cell")) - 1)))
    held = leaves.withColumn("part", F.pmod(F.xxhash64("ids"), F.get(parts, F.col("cell"))).cast("int"))
    # Both sides carry blocks of vectors: a shuffled join at every size.
    pairs = asked.hint("merge").join(held, ["cell", "part"])
    found = pairs.mapInArrow(_search(tree, want_same, k), FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_step: int = ANCHOR_STEP,
         least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score for ``embeddings`` (vec_id, label, embedding)."""
    small_batches(embeddings.sparkSession)
    copies = Window.partitionBy("vector", "label").orderBy("vec_id")
    # Equal rows once, then the copies that can be in an answer.
    distinct = usable_rows(embeddings).dropDuplicates(["vec_id", "label", "vector"])
    rows = materialize(distinct, "gnat-rows")
    candidates = materialize(rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= max(positives + 1, negatives))
                             .drop("_copy"), "gnat-candidates")
    tree, sample = fit(candidates, sample_rows)
    tree = measure(tree, candidates)
    leaves = materialize(build_leaves(tree, candidates), "gnat-leaves")
    anchors = (rows.filter(F.col("vec_id") % anchor_step == 0).groupBy("vec_id")
               .agg(F.min(F.struct("vector", "label")).alias("a")).select("vec_id", "a.label", "a.vector"))
    anchors = materialize(anchors.withColumns({"lows": F.array(F.lit(NO_LEAST)), "highs": F.array(F.lit(NO_MOST))}), "gnat-anchors")
    liked = materialize(range_search(tree, sample, leaves, anchors, True, positives)
                        .select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score")), "gnat-positives")
    discard(rows, candidates)
    # 100 n >= least * p and 100 n <= most * p, in whole numbers: floor divisions.
    floor = lambda a: f"({a} - pmod({a}, 100L)) div 100"
    windows = (liked.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("p"))
               .select("anchor_id", F.expr(f"transform(p, w -> -({floor(f'(-{least_percent} * w.positive_score)')}))").alias("lows"),
                       F.expr(f"transform(p, w -> {floor(f'({most_percent} * w.positive_score)')})").alias("highs")))
    asked = anchors.drop("lows", "highs").join(windows, F.col("vec_id") == F.col("anchor_id"))
    rejected = range_search(tree, sample, leaves, asked, False, negatives)
    return (rejected.join(liked, ["anchor_id", "slot"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def negatives_report(embeddings: DataFrame) -> DataFrame:
    """The registered query, on the contract's labels."""
    return mine(embeddings.withColumn("label", shifted_label(F.col("vec_id"), F.col("label"))))


def oracle_sql() -> str:
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x::DOUBLE * {SCALE}) >= {LARGEST})) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_STEP} = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
r AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND {LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {MOST_PERCENT} * p.score
  WHERE p.place <= {POSITIVES})
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= {NEGATIVES}"""
