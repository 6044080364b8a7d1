"""Exact search over clustered shards: brute force, and the work that the
bars and bounds save."""

import numpy as np
import pytest

from kestrel.llm import exact_search
from kestrel.llm.exact_search import search_pair, shard_row


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, vectors)],
                                 "vec_id long, embedding array<double>")


def _brute(vectors, k=5, step=50):
    q = np.floor(np.asarray(vectors, np.float64) * 256).astype(np.int64)
    out = set()
    for i in range(0, len(q), step):
        scores = q @ q[i]
        order = sorted((j for j in range(len(q)) if j != i), key=lambda j: (-scores[j], j))[:k]
        out |= {(i, r + 1, j, int(scores[j])) for r, j in enumerate(order)}
    return out


def _clustered(rng, n, d=16, clusters=12):
    centres = rng.normal(0, 1, (clusters, d))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return centres[rng.integers(0, clusters, n)] + rng.normal(0, 0.02, (n, d))


def _parts(spark, df):
    usable = df.selectExpr("vec_id", "embedding").select("vec_id", exact_search.quantised(df.embedding).alias("vector"))
    n_shards, centres, parts, query_parts = exact_search._plan(usable, 50)
    dealt = usable.mapInArrow(exact_search._deal(centres), "vec_id long, vector array<long>, cell int")
    index = exact_search.build_index(dealt, parts).cache()
    blocks = exact_search.query_blocks(dealt.filter("vec_id % 50 = 0"), index, parts, query_parts, 5).cache()
    return n_shards, index, blocks


def test_many_shards_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "SHARD_ROWS", 64)
    monkeypatch.setattr(exact_search, "SUMMARIES", 4)
    rng = np.random.default_rng(11)
    vectors = _clustered(rng, 1500)
    vectors[200:700] = vectors[200]  # a third are one vector
    vectors[900:1000] *= -3
    got = {tuple(r) for r in exact_search.top_k(_frame(spark, vectors)).collect()}
    assert got == _brute(vectors)


def test_bounds_rule_out_most_pairs_of_clustered_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "SHARD_ROWS", 64)
    df = _frame(spark, _clustered(np.random.default_rng(12), 1500))
    n_shards, index, blocks = _parts(spark, df)
    kept = exact_search.pairs_to_search(blocks, index, n_shards).selectExpr("length(query_ids) div 8 as n").agg({"n": "sum"}).first()[0]
    assert kept < 0.35 * 30 * index.count()
    assert sum(r.n for r in index.selectExpr("length(ids) div 8 as n").collect()) == 1500


def test_a_bar_saves_levels_without_changing_the_answer():
    rng = np.random.default_rng(13)
    x, q = (rng.normal(0, 32, (n, 64)).astype(np.int64) for n in (4000, 40))
    scores = q @ x.T
    bars = np.sort(scores, axis=1)[:, -5]
    row = shard_row(x)
    own, ids = np.arange(40) + 10**6, np.arange(4000)
    read = {}
    for name, bar in (("own", None), ("equal", bars), ("above", 6 * scores.std(axis=1).astype(int)), ("far above", np.full(40, 10**6))):
        work = {}
        found = list(zip(*(f.tolist() for f in search_pair(own, q, ids, row["base"], row["segments"], 5, row["gains"], bar, work))))
        read[name] = work.get("read", 0) / work["all"]
        if name in ("own", "equal"):
            assert found == [(10**6 + i, j, int(scores[i, j])) for i in range(40)
                             for j in sorted(range(4000), key=lambda j: (-scores[i, j], j))[:5]]
    # 6 standard deviations: the bar that a billion such rows would set.
    assert read["far above"] == 0 and read["above"] <= read["equal"] < 0.7 < read["own"] < 1, read


def test_no_shard_holds_more_than_its_bound():
    rng = np.random.default_rng(14)
    for top in (10, 300, 1 << 40):
        x, q = rng.integers(-top, top, (50, 9)), rng.integers(-300, 300, (20, 9))
        row = shard_row(x)
        bound = exact_search.most_a_shard_holds(q, row["base"], row["gains"][0], row["middle"], row["radius"])
        assert (bound >= (q @ x.T).max(axis=1)).all()


def test_vectors_without_components_and_too_large_ones(spark):
    df = spark.createDataFrame([(0, []), (1, []), (50, [])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in exact_search.top_k(df, k=1).collect()) == [(0, 1, 1, 0), (50, 1, 0, 0)]
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0 ** 53]), (2, [2.0 ** 40])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_search.top_k(df).collect()] == [(0, 1, 2, 2 ** 56)]
    df = spark.createDataFrame([(0, [2.0 ** 40]), (2, [2.0 ** 40])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        exact_search.top_k(df).collect()
