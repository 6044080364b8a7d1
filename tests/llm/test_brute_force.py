"""Operators without an SQL form against brute force on whole fixtures."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.llm import (exact_search, language_id, line_dedup, near_dedup, packing, queries, substring_dedup,
                         token_records)
from tests.conftest import SF_DIR, SMALL_DIR
from tests.llm import data, reference


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL_DIR}/documents.parquet")


def collected(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_near_duplicates_match_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = collected(docs)
    ids = [i for i, _ in rows]
    want = {i: (len(reference.shingles(t, 4)), ids[c], i == ids[c])
            for (i, t), c in zip(rows, reference.near_components([t for _, t in rows], 4))}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.queries()["op3_near_dedup"](spark, SF_DIR).collect()}
    assert got == want
    assert sum(kept for _, _, kept in want.values()) < len(want)


def test_near_family_around_the_threshold(spark):
    """Copies whose mutual similarity straddles the bound: links must not be
    lost, whichever copy is the centre of a bucket."""
    rng = random.Random(3)
    base = data.words(rng, 160)
    texts = []
    for _ in range(70):
        own = list(base)
        for k in rng.sample(range(160), rng.randint(2, 5)):
            own[k] = "".join(rng.choices("qwxyz", k=6))
        texts.append(" ".join(own))
    texts += [data.prose(rng, 30) for _ in range(20)]
    docs = data.documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    want = reference.near_components(texts, 4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, size=4).collect()}
    assert got == dict(enumerate(want))


@pytest.mark.parametrize("percent", [50, 95])
def test_near_duplicates_at_other_thresholds(spark, monkeypatch, percent):
    """Families on both sides of the threshold, in whole buckets and in dealt
    ones."""
    rng = random.Random(percent)
    texts = []
    for _ in range(4):
        base = data.words(rng, 150)
        for _ in range(30):
            own = list(base)
            for k in rng.sample(range(150), rng.randint(0, 3) if percent == 95 else rng.randint(5, 18)):
                own[k] = "".join(rng.choices("qwxyz", k=6))
            texts.append(" ".join(own))
    want = reference.near_components(texts, 4, percent)
    assert 10 < len(set(want)) < 110
    docs = data.documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    for chunk in (1024, 8):
        monkeypatch.setattr(near_dedup, "CHUNK", chunk)
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, size=4, percent=percent).collect()}
        assert got == dict(enumerate(want))


@pytest.mark.parametrize("shape", ["one shared shingle", "family around the threshold"])
def test_crowded_bucket_is_dealt(spark, monkeypatch, shape):
    """Many classes outside the centre's component in one bucket: no group
    may hold them all, and no link may be lost."""
    rng, chunk = random.Random(7), 32
    word = lambda: "".join(rng.choices("abcdefgh", k=8))
    if shape == "one shared shingle":
        shared = " ".join(word() for _ in range(4))
        texts = [shared + " " + " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(300)]
        texts += [" ".join(t.split()[:-1]) for t in texts[:40]] + [t + " " + word() for t in texts[20:60]]
    else:
        base, texts = [word() for _ in range(160)], []
        for _ in range(300):
            own = list(base)
            for k in rng.sample(range(160), rng.randint(3, 7)):
                own[k] = word()
            texts.append(" ".join(own))
    limit = 5 * chunk

    def bounded(make):
        def outer(percent):
            run = make(percent)

            def inner(table):
                if table.num_rows > limit:
                    raise ValueError(f"a group of {table.num_rows} rows")
                return run(table)
            return inner
        return outer
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    for name in ("_chunk_pairs", "_block_pairs"):
        if hasattr(near_dedup, name):
            monkeypatch.setattr(near_dedup, name, bounded(getattr(near_dedup, name)))
    docs = data.documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, size=4).collect()}
    want = reference.near_components(texts, 4)
    assert got == dict(enumerate(want))
    assert len(set(want)) > 3 * chunk


def test_substrings_match_all_windows(spark, small, monkeypatch):
    rows = collected(small)
    want = dict(zip((i for i, _ in rows), reference.removed_substrings([t for _, t in rows], 400)))
    for bucket in (256, 4, 1):
        monkeypatch.setattr(substring_dedup, "BUCKET_RUNS", bucket)
        got = {r.doc_id: r for r in substring_dedup.substring_report(small).collect()}
        assert {i: tuple(r)[1:5] for i, r in got.items()} == want
        for i, text in rows:
            assert (got[i].kept_text == (text or "")) == (got[i].n_removed == 0)
            if "\ufffd" not in got[i].kept_text:
                assert len(got[i].kept_text.encode()) == got[i].n_bytes - got[i].n_removed
    assert sum(n > 0 for _, n, _, _ in want.values()) > 10


def passages(n, words=120):
    """One passage in ``n`` texts that share nothing else."""
    rng = random.Random(12)
    shared = " ".join(data.words(rng, words))
    return [" ".join(data.words(rng, 90)) + f" {k} " + shared + f" {k} " + " ".join(data.words(rng, 90)) for k in range(n)]


def test_a_passage_of_many_texts_fills_no_bucket(spark, monkeypatch):
    """Buckets stay bounded as the passage spreads, and nothing is lost."""
    for n in (1000, 2000):
        largest = []
        dealt = substring_dedup._dealt

        def counted(runs):
            largest.append(runs.groupBy("anchor", "salt").count().agg(F.max("count")).first()[0] or 0)
            return dealt(runs)
        monkeypatch.setattr(substring_dedup, "_dealt", counted)
        texts = passages(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: tuple(r)[1:5] for r in substring_dedup.substring_report(docs).collect()}
        monkeypatch.setattr(substring_dedup, "_dealt", dealt)
        assert len(largest) >= 3 and max(largest) <= 2 * substring_dedup.BUCKET_RUNS
        assert got == dict(enumerate(reference.removed_substrings(texts, 400)))


@pytest.mark.parametrize("min_chars, equal_chars", [(line_dedup.MIN_CHARS, line_dedup.EQUAL_CHARS), (20, 20), (6, 0)])
def test_lines_match_edit_distance(spark, min_chars, equal_chars):
    rng = random.Random(8)
    lines = [data.prose(rng, rng.randint(4, 14)) for _ in range(12)] + [data.prose(rng, k)[:n] for k, n in ((3, 9), (3, 10), (5, 19), (5, 20), (2, 6))] + ["x" * 150 + data.prose(rng, 5) + "y" * 90]

    def edited(line):
        k = rng.randrange(len(line) + 1)
        return rng.choice([line[:k] + "z" + line[k:], line[:k] + line[k + 1:], line[:k] + "z" + line[k + 1:], line,
                           line[:k] + "zz" + line[k:], line[k:] + line[:k]])

    texts = ["\n".join(rng.choice(["", "  "]) + edited(rng.choice(lines)) for _ in range(rng.randint(1, 8))) for _ in range(50)]
    docs = data.documents(spark, [(i, t, None, None, len(t)) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_lines(docs, min_chars, equal_chars).collect()}
    want = reference.kept_lines(texts, min_chars, equal_chars)
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}
    report = {r.doc_id: r for r in line_dedup.line_report(docs, min_chars, equal_chars).collect()}
    assert sum(r.n_near for r in report.values()) > 5


def test_tokens_round_trip(spark, small):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_records.default_tokenizer())
    rows = [(-3, "first"), (-2, "end of text <|endoftext|> next<|endoftext|>"), (-1, "third")]
    small = small.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    start, want = 0, {}
    for doc_id, text in collected(small):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want[doc_id] = (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)
    manifest = token_records.write_records(small)
    got = {r.doc_id: tuple(r)[1:] for r in token_records.read_records(spark, manifest).collect()}
    assert got == want
    shard = manifest.orderBy(F.desc("docs")).first()
    numbers = list(range(shard["docs"]))
    random.Random(1).shuffle(numbers)
    for doc_id, ids in token_records.read_at(shard["path"], numbers):
        assert zlib.crc32(ids.tobytes()) == want[doc_id][2]


def test_documents_without_an_id_spread_over_shards(spark):
    """Null ids in bulk: every text is there, starts follow one another, and no
    shard holds them all."""
    rng = random.Random(8)
    texts = [" ".join(data.words(rng, 1 + k % 40)) for k in range(4000)]
    docs = spark.createDataFrame([(None if k % 10 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        manifest = token_records.write_records(docs)
    finally:
        spark.conf.unset(key)
    shards = [r["docs"] for r in manifest.collect()]
    assert len(shards) > 1 and max(shards) < 0.6 * len(texts)
    got = sorted(token_records.read_records(spark, manifest).collect(), key=lambda r: r.start)
    assert len(got) == len(texts) and [r.doc_id for r in got[:3600]] == [None] * 3600
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_records.default_tokenizer())
    want = [zlib.crc32(np.asarray([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for t in texts]
    assert sorted(r.ids_crc32 for r in got) == sorted(want)


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = docs.select("doc_id", "lang").join(language_id.identify(docs), "doc_id").filter("held_out").collect()
    by_lang = defaultdict(list)
    for r in got:
        by_lang[r.lang].append(r.lang == r.lang_pred)
        assert 0 <= r.score <= 1
    assert set(by_lang) == {"de", "en", "es", "fr"}
    assert all(np.mean(v) > 0.95 for v in by_lang.values())


def test_language_separates_families_first(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language_id.train(docs)
    assert model.families.classes == ["germanic", "romance"]
    assert model.languages["germanic"].classes == ["de", "en"]
    assert model.languages["romance"].classes == ["es", "fr"]


def test_svm_reaches_the_least_loss():
    """Dual coordinate descent against plain gradient descent on the primal."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 12))
    y = np.where(x @ rng.normal(size=12) + 0.8 * rng.normal(size=120) > 0.3, 1.0, -1.0)
    full, cost = np.hstack([x, np.ones((120, 1))]), 10.0
    loss = lambda w: 0.5 * w @ w + cost * (np.maximum(0, 1 - y * (full @ w)) ** 2).sum()
    plain = np.zeros(13)
    step = 1 / (1 + 2 * cost * np.linalg.norm(full, 2) ** 2)
    for _ in range(20000):
        plain -= step * (plain - 2 * cost * full.T @ (y * np.maximum(0, 1 - y * (full @ plain))))
    got = language_id.train_svm(x, y, cost, rounds=4000).astype(float)
    assert loss(got) <= 1.001 * loss(plain)
    assert np.abs(got - plain).max() < 0.02


def test_many_languages(spark, monkeypatch):
    """The sample shrinks with the number of languages; too many raise."""
    rng = random.Random(9)
    rows = [(k, data.prose(rng, 12), f"x{k % 20}", "s", 0) for k in range(2000)]
    docs = data.documents(spark, rows)
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 400)
    seen = []
    fit = language_id.OneVersusOne.fit.__func__
    monkeypatch.setattr(language_id.OneVersusOne, "fit", classmethod(lambda cls, x, labels: (seen.append(len(x)), fit(cls, x, labels))[1]))
    assert len(language_id.train(docs).languages["other"].classes) == 20 and max(seen) <= 400
    monkeypatch.setattr(language_id, "MACHINES", 189)
    with pytest.raises(ValueError):
        language_id.train(docs)


def test_packing_equals_plain_best_fit(spark, monkeypatch):
    rng = random.Random(4)
    for capacities in ((256, 512, 1024, 2048, 4096), (64,), (10, 25, 40)):
        for _ in range(6):
            sizes = sorted((rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 150))), reverse=True)
            cost, at = reference.best_fit(sizes, list(capacities), packing.OVERHEAD)
            bins, offsets, final = packing.pack(np.asarray(sizes), capacities)
            assert list(zip(bins.tolist(), offsets.tolist())) == at
            assert int(final.sum()) + packing.OVERHEAD * len(final) == cost
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = {i: len(reference.WORD.findall(t or "")) for i, t in collected(docs)}
    largest = packing.CAPACITIES[-1]
    pieces = sorted((-min(largest, n - at), -n, i, at) for i, n in words.items() for at in range(0, n, largest))
    cost, at = reference.best_fit([-n for n, *_ in pieces], list(packing.CAPACITIES), packing.OVERHEAD)
    got = {(r.doc_id, r.start): (r.bin, r.bin_offset, r.capacity) for r in packing.pack_documents(docs).collect() if r.length}
    assert {key: value[:2] for key, value in got.items()} == {(i, start): place for (_, _, i, start), place in zip(pieces, at)}
    assert sum(c + packing.OVERHEAD for _, c in {(b, c) for b, _, c in got.values()}) == cost


def test_long_documents_and_rows_without_an_id_fill_no_block(spark, monkeypatch):
    """Blocks count the pieces of long documents, and equal sizes without an
    id are dealt to many blocks."""
    held = []
    pack_block = packing._pack_block
    monkeypatch.setattr(packing, "_pack_block", lambda frame, *rest: (held.append(int(np.maximum(1, -(-frame["size"] // 8)).sum())),
                                                                      pack_block(frame, *rest))[1])
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([None] * 40, pa.int64()), "size": pa.array([160] * 40, pa.int64()),
                                        "block": pa.array([0] * 40, pa.int64())})
    out = list(packing._pack_blocks((4, 8), 100)(batch.slice(k, 4) for k in range(0, 40, 4)))
    assert max(held) <= 100 + 80 and sum(b.num_rows for b in out) == 800
    assert len({x for b in out for x in b.column("bin").to_pylist()}) == 800
    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    docs = spark.createDataFrame([(None, f"word{k} and") for k in range(1000)], "doc_id long, text string")
    blocks = Counter(r.bin >> 40 for r in packing.pack_documents(docs).collect())
    assert len(blocks) == 20 and max(blocks.values()) < 120


def test_packing_places_every_word_once(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = {i: len(reference.WORD.findall(t or "")) for i, t in collected(docs)}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs).collect():
        pieces[r.doc_id].append((r.start, r.length))
        if r.length:
            bins[r.bin].append((r.bin_offset, r.length, r.capacity))
    for doc_id, own in pieces.items():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert sum(n for _, n in own) == sizes[doc_id]
    assert set(pieces) == set(sizes)
    used = 0
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:]))
        filled, capacity = sum(n for _, n, _ in own), own[0][2]
        fits = [c for c in packing.CAPACITIES if c >= filled]
        assert capacity == min(fits)
        used += capacity
    assert sum(sizes.values()) > 0.97 * used


def test_search_matches_all_pairs_with_hot_vector(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(0, 0.2, (700, 16)).astype(np.float32)
    vectors[100:400] = vectors[100]  # one very common vector: ties everywhere
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in exact_search.top_k(df).collect()}
    q = np.floor(vectors.astype(np.float64) * 256).astype(np.int64)
    want = {}
    for i in range(0, 700, 50):
        scores = q @ q[i]
        order = sorted((j for j in range(700) if j != i), key=lambda j: (-scores[j], j))[:5]
        want |= {(i, k + 1): (j, int(scores[j])) for k, j in enumerate(order)}
    assert got == want
