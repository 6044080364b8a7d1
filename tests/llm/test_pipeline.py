"""The corpus pipeline against its stages computed by hand."""

from collections import Counter

import corpus_pipeline
from kestrel.llm import line_dedup, near_dedup, quality_rules
from kestrel.session import materialize
from tests.conftest import SMALL_DIR
from tests.llm import reference


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    steps = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = materialize(stage(spark, frame, SMALL_DIR), f"test-{name}")
        steps[name] = frame
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality_rules.quality_report(docs).collect() if r.kept}
    assert {r.doc_id for r in steps["quality_rules"].collect()} == good
    ids = sorted(good)
    lined = reference.kept_lines([rows[i] for i in ids], line_dedup.MIN_CHARS, line_dedup.EQUAL_CHARS)
    assert {r.doc_id: r.text for r in steps["line_dedup"].collect()} == dict(zip(ids, lined))
    near = reference.near_components(lined, near_dedup.SHINGLE_WORDS)
    kept = {i for k, i in enumerate(ids) if near[k] == k}
    assert {r.doc_id for r in steps["near_dedup"].collect()} == kept
    copies = Counter(r.doc_id for r in steps["mixing"].collect())
    assert set(copies) <= kept and max(copies.values()) <= 2
    pieces = steps["packing"].collect()
    text = dict(zip(ids, lined))
    words = sum(n * len(reference.WORD.findall(text[i])) for i, n in copies.items())
    assert sum(r.length for r in pieces) == words
    whole = corpus_pipeline.run(spark, SMALL_DIR).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, pieces))


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL_DIR}/labels.parquet").collect()}
    report = {r.doc_id: r for r in quality_rules.quality_report(docs).collect()}
    clean = [i for i, q in labels.items() if q == 1 and not report[i].base_failed]
    assert clean and all(report[i].kept for i in clean)
