"""Hard negatives against brute force, and what the tree leaves out."""

import math
import random

import numpy as np
import pytest

from kestrel.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3, step=50):
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        x = tuple(math.floor(float(np.float32(v)) * 256) for v in vector)
        if all(abs(v) < hn.LARGEST for v in x):
            usable[vec_id, x, label] = None
    usable = list(usable)
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    anchors = {}
    for vec_id, x, label in usable:
        if vec_id % step == 0:
            anchors[vec_id] = min(anchors.get(vec_id, (x, label)), (x, label))
    out = []
    for vec_id, (x, label) in anchors.items():
        order = sorted((-score(x, y), i, l) for i, y, l in usable if i != vec_id)
        for p, i, _ in [o for o in order if o[2] == label][:positives]:
            hits = [(n, j) for n, j, l in order if l != label and 50 * -p <= 100 * -n <= 95 * -p][:negatives]
            out += [(vec_id, i, k, j, -p, -n) for k, (n, j) in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df, **more).collect())


def clustered(seed, n, centres, spread, dims=8, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    which = rng.integers(0, centres, n)
    x = middle[which] + spread * rng.normal(size=(n, dims))
    return [(k, x[k].astype(np.float32).tolist(), int(which[k] + (k % 5 == 0)) % labels) for k in range(n)]


@pytest.mark.parametrize("sample", [40, 700])
def test_equals_brute_force(spark, monkeypatch, sample):
    monkeypatch.setattr(hn, "LEAF_ROWS", 40)
    monkeypatch.setattr(hn, "LEAF_SAMPLE", 4)
    monkeypatch.setattr(hn, "FAN_OUT", 5)
    rows = clustered(1, 700, 12, 0.2)
    # Copies of an anchor and of others, a hot vector, ties.
    rows += [(1000 + k, rows[k % 3 * 50][1], rows[k % 3 * 50][2]) for k in range(200)]
    rows += [(2000 + k, rows[7][1], k % 4) for k in range(60)]
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows, sample_rows=sample) == want


def test_blocks_of_leaves_and_queries(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "PART_BLOCKS", 2)
    monkeypatch.setattr(hn, "QUERY_ROWS", 3)
    rows = clustered(2, 500, 5, 0.3)
    assert mined(spark, rows) == brute(rows)


def test_rows_that_take_no_part_and_odd_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.7, 0.5], 2), (2, [0.7, 0.5], 2), (3, [0.7, 0.5], 3), (4, None, 1), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (8, [None, 1.0], 2), (None, [1.0, 0.5], 1), (9, [1.0, 0.5], None), (10, [], 2), (11, [0.9], 2),
            (12, [1e30, 0.0], 2), (50, [0.0, 0.0], 1), (100, [-1.0, 0.0], 1), (0, [1.0, 0.5], 1), (150, [0.5, 0.5], 7), (1, [0.9, 0.2], 1), (0, [2.0, 0.5], 2)]
    want = brute(rows)
    assert want and mined(spark, rows) == want
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cell", "2 as score", "3 as rank", "4 as vector", "5 as slot")
    assert sorted(tuple(r) for r in hn.mine(df).collect()) == want
    assert hn.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.mine(spark.createDataFrame([(50, [1.0], 1)], SCHEMA)).collect() == []


def test_contract_labels(spark):
    df = spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], None)], SCHEMA)
    got = df.select("vec_id", hn.shifted_label(df.vec_id, df.label).alias("label")).collect()
    assert [tuple(r) for r in got] == [(7, 0), (8, 9), (14, None)]


def test_scores_beyond_exact_floats():
    a = np.array([[(1 << 22) - 1] * 3, [-(1 << 21)] * 3])
    b = np.array([[(1 << 22) - 3] * 3])
    wide = np.concatenate([np.tile(a, 100), np.ones((2, 1), np.int64)], axis=1), np.concatenate([np.tile(b, 100), np.ones((1, 1), np.int64)], axis=1)
    want = [[sum(int(p) * int(q) for p, q in zip(x, y)) for y in wide[1]] for x in wide[0]]
    assert hn.scores(*wide).tolist() == want


def test_tree_leaves_out_most_cells_of_clustered_rows(spark, monkeypatch):
    """Ranges prune where the data have structure: scored pairs are reported."""
    monkeypatch.setattr(hn, "LEAF_ROWS", 50)
    monkeypatch.setattr(hn, "LEAF_SAMPLE", 8)
    rows = clustered(3, 3000, 12, 0.02, dims=6)
    df = hn.usable_rows(spark.createDataFrame(rows, SCHEMA))
    tree, sample = hn.fit(df)
    hn.measure(tree, df)
    ids, labels, x = sample
    windows = np.stack([np.full((len(ids), 1), hn.NO_LEAST), np.full((len(ids), 1), hn.NO_MOST)], axis=2)
    windows = hn.raised(sample, ids, labels, x, windows, True, 5)
    reach = tree.reachable(x, windows[:, :, 0], windows[:, :, 1])
    print("share of cells reached:", reach.mean())
    assert tree.cells >= 12 and reach.mean() < 0.35
    # No row in a window lies in a cell that was left out.
    cell = tree.route(x)[0]
    fits = hn.in_window(hn.scores(x, x), ids[:, None] == ids, labels[:, None] == labels, windows, True)[:, 0]
    assert all(reach[i, cell[j]] for i, j in np.argwhere(fits).tolist())


def test_random_windows_are_never_cut(spark):
    rng = random.Random(9)
    rows = clustered(4, 600, 6, 0.5, dims=5)
    df = hn.usable_rows(spark.createDataFrame(rows, SCHEMA))
    tree, (ids, labels, x) = hn.fit(df, 300)
    hn.measure(tree, df)
    every = hn.np.array([r.vector for r in df.collect()])
    cell = tree.route(every)[0]
    s = hn.scores(x, every)
    low = np.array([[rng.randint(int(s.min()), int(s.max()))] for _ in ids])
    high = low + np.array([[rng.randint(-5, 40000)] for _ in ids])
    reach = tree.reachable(x, low, high)
    assert all(reach[i, cell[j]] for i, j in np.argwhere((s >= low) & (s <= high)).tolist())
