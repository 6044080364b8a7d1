"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns
with clashing names, for every operator and every pipeline stage."""

import hashlib
import random

import pytest

import corpus_pipeline
from kestrel.llm import (exact_search, language_id, license_scan, line_dedup, mixing, near_dedup, packing, quality_rules,
                         substring_dedup, token_records)
from tests.llm import data, reference

REPORTS = {
    "op2": language_id.identify,
    "op3": near_dedup.near_duplicates,
    "op4": substring_dedup.substring_report,
    "op5": mixing.mix_report,
    "op6": line_dedup.line_report,
    "op7": token_records.token_report,
    "op8": license_scan.scan,
    "op9": packing.pack_documents,
    "op10": quality_rules.quality_report,
}
PER_DOCUMENT = sorted(set(REPORTS) - {"op9"})


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def results(spark):
    docs = data.documents(spark)
    return {name: by_id(fn(docs)) for name, fn in REPORTS.items()}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(results, name):
    assert set(results[name]) == {r[0] for r in data.rows()}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_empty_table(spark, name):
    assert REPORTS[name](data.documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_extra_columns_with_clashing_names(spark, results, name):
    got = by_id(REPORTS[name](data.clashing(data.documents(spark))))
    assert set(got) == set(results[name])
    if name in ("op3", "op4", "op5", "op6", "op8", "op10"):
        assert got == results[name]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_nulls_in_any_column_and_repeated_rows(spark, name):
    rows = data.rows()
    rows += [rows[0], rows[0], rows[18], (None, "the and of", None, None, None), (None, None, None, None, None), (3, "another text", "en", "s0", 1)]
    got = REPORTS[name](data.documents(spark, rows)).collect()
    assert len(got) >= len(rows) if name == "op9" else len(got) == len(rows)


def test_null_and_blank_texts(results):
    rows = data.rows()
    blank = [r[0] for r in rows if not (r[1] or "").strip()]
    assert len(blank) == 3
    for i in blank:
        assert results["op2"][i].lang_pred == "und" and results["op2"][i].score == 0
        assert (results["op3"][i].n_shingles, results["op3"][i].component_id, results["op3"][i].kept) == (0, i, True)
        assert results["op4"][i].n_removed == 0
        assert (results["op5"][i].size, results["op5"][i].taken) == (0, 0)
        assert (results["op8"][i].n_words, results["op8"][i].first_word, results["op8"][i].labels) == (0, None, "")
        assert (results["op9"][i].length, results["op9"][i].bin) == (0, None)
        assert (results["op10"][i].n_words, results["op10"][i].base_failed, results["op10"][i].kept) == (0, True, False)
    null = next(r[0] for r in rows if r[1] is None)
    assert results["op4"][null].n_bytes == 0 and results["op4"][null].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert results["op7"][null].n_tokens == 1
    assert (results["op6"][null].n_lines, results["op6"][null].kept_sha256) == (0, None)


def test_near_duplicates_and_substrings_of_the_rows(spark, results):
    texts = [r[1] for r in data.rows()]
    want = reference.near_components(texts, near_dedup.SHINGLE_WORDS)
    assert {i: r.component_id for i, r in results["op3"].items()} == dict(enumerate(want))
    assert {i: tuple(r)[1:5] for i, r in results["op4"].items()} == dict(enumerate(reference.removed_substrings(texts, 400)))


def test_repeated_rows_of_near_duplicates(spark):
    rows = [(1, "a b c d e f", None, None, None)] * 3 + [(2, "a b c d e f", None, None, None), (1, "other words here now and so", None, None, None)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(data.documents(spark, rows)).collect())
    assert got == [(1, 1, True)] * 4 + [(2, 1, False)]
    kept = near_dedup.drop_near_duplicates(data.documents(spark, rows)).collect()
    assert sorted(r.text for r in kept) == ["a b c d e f", "other words here now and so"]


def test_texts_of_a_shared_doc_id_are_fetched_once(spark, monkeypatch):
    """Different texts under one doc_id, or under none: one text a class."""
    rng, texts = random.Random(5), []
    for k in range(60):
        words = data.words(rng, 40)
        texts += [" ".join(words), " ".join(words + ["more"])]
    rows = [(None if i % 4 < 2 else 7, t, "en", "s", 0) for i, t in enumerate(texts)]
    fetched = {}

    def counted(df, name, metrics=None):
        out = materialize(df, name, metrics)
        if name.startswith("near-texts"):
            fetched[name] = out.count()
        return out
    materialize = near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", counted)
    got = near_dedup.near_duplicates(data.documents(spark, rows + rows[:8]), size=4).collect()
    assert min(fetched.values()) == len(texts)
    assert sorted((r.component_id is None, r.component_id or 0) for r in got) == [(False, 7)] * 64 + [(True, 0)] * 64


def test_mix_targets_and_caps(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), None, "abc"[i % 3] if i % 10 else None, None) for i in range(3000)]
    got = mixing.mix_report(data.documents(spark, rows)).collect()
    by_source = {}
    for r in got:
        assert r.taken <= 2 * r.size
        own = by_source.setdefault(r.source, [r.source_size, r.target, 0])
        own[2] += r.taken
    total = sum(s for s, _, _ in by_source.values())
    assert abs(sum(t for _, t, _ in by_source.values()) - 1.5 * total) < 1e-6 * total
    assert all(t <= 2 * s + 1e-9 and abs(n - t) <= 7 for s, t, n in by_source.values())
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in mixing.mix_report(data.documents(spark, rows[::-1])).collect()}


def test_clean_prose_in_capitals_or_another_language_is_kept(spark):
    rng = random.Random(3)
    prose = data.prose(rng, 200)
    foreign = " ".join("x" + w for w in data.words(rng, 200))
    rows = [(1, prose, "en", "s", 0), (2, prose.upper(), "en", "s", 0), (3, foreign, "it", "s", 0), (4, foreign, "en", "s", 0), (5, foreign, None, "s", 0),
            (6, "# " * 200 + foreign, "it", "s", 0)]
    docs = data.documents(spark, rows)
    got = {r.doc_id: (r.kept, r.failed_rule) for r in quality_rules.quality_report(docs).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, "stop_word_ratio"), 5: (False, "stop_word_ratio"),
                   6: (False, "mean_word_chars" if got[6][1] == "mean_word_chars" else "symbol_ratio")}
    assert sorted(r.doc_id for r in quality_rules.filter_documents(docs).collect()) == [1, 2, 3]


def test_licenses_of_the_rows(results):
    row = next(r for i, r in results["op8"].items() if data.rows()[i][1] and "CC BY-NC" in data.rows()[i][1])
    assert (row.base_labels, row.labels, row.n_base, row.first_word, row.last_word, row.score) == (
        "cc-by,reserved", "cc-by,cc-by-nc,reserved", 2, 2, 7, 1.0)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (None, [9.0, 9.0]), (6, []), (7, [2.0]), (100, None), (1, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as `group`", "2 as score")
    got = [tuple(r) for r in exact_search.top_k(df, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 131072), (0, 2, 50, 65536), (0, 3, 1, 49152), (50, 1, 7, 131072), (50, 2, 0, 65536), (50, 3, 1, 32768)]
    assert exact_search.top_k(df.limit(0)).collect() == []


def test_languages_without_labels(spark):
    docs = data.documents(spark, [(1, "some text", None, None, None)])
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_every_case(spark, stage):
    fn = dict(corpus_pipeline.STAGES)[stage]
    docs = data.documents(spark)
    rows = data.rows() + [data.rows()[0], (None, "the and of", None, None, None), (None, None, None, None, None)]
    for df in (data.documents(spark, rows), data.clashing(docs), data.documents(spark, [])):
        out = fn(spark, df, "")
        got = out.collect()
        if stage != "packing":
            assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
        assert bool(got) == (not df.isEmpty())


def test_floor_of_equal_lines_above_that_of_near_ones(spark):
    with pytest.raises(ValueError):
        line_dedup.drop_lines(data.documents(spark), min_chars=20, equal_chars=21)
