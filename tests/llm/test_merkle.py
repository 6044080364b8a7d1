"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

from kestrel.llm import merkle
from tests.llm import data


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Top, and per leaf its (left, right) siblings by level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 3, len(nodes))) for a in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                pair = ("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k))
                for i in groups[k]:
                    paths[i].append(pair)
        groups = [sum((groups[k] for k in run), []) for run in runs]
        nodes = [sha(*(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    tops = {s: tree([leaf(r, r[1]) for r in by_source[s]]) for s in sources}
    root, upper = tree([tops[s][0] for s in sources])
    out = []
    for s, rest in zip(sources, upper):
        for row, path in zip(by_source[s], tops[s][1]):
            own = claimed = leaf(row, row[1])
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                claimed = leaf(row, row[1].replace("\n", ""))
            for left, right in path + rest:
                claimed = sha(left, claimed, right)
            out.append((row[0], own, tops[s][0], root, sha(*(p for pair in path + rest for p in pair)), claimed, claimed == root))
    return sorted(out, key=str)


def report(df):
    return sorted((tuple(r) for r in merkle.merkle_report(df).collect()), key=str)


def test_every_case_of_the_rows(spark):
    rows = data.rows()
    rows += [rows[0], (None, "a\nb", None, None, None), (None, "c", "en", "s0", 1), (None, None, None, None, None), (3, "other\ntext", "en", "s0", 1)]
    want = manifest(rows)
    assert report(data.documents(spark, rows)) == want
    assert report(data.clashing(data.documents(spark, rows)).withColumnRenamed("block", "tree")) == want
    assert report(data.documents(spark, [])) == []


def test_one_document_is_the_root(spark):
    rows = [(7, "a\nb", "en", None, 3)]
    got = report(data.documents(spark, rows))
    assert got == manifest(rows) and got[0][1] == got[0][3] and got[0][4] == sha()


def test_sources_of_several_blocks_and_all_run_lengths(spark, monkeypatch):
    """Small blocks, so that trees span three tiers; a hot source."""
    monkeypatch.setattr(merkle, "DEEP", 2)
    rows = []
    for source, n in [("hot", 173), ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 9), ("f", 10), ("g", 27), ("h", 28), (None, 82), ("é", 5), ("z", 81)]:
        rows += [(len(rows) + k, f"text {k}\nof {source}", "en", source, k) for k in range(n)]
    assert report(data.documents(spark, rows)) == manifest(rows)


def test_tampering_shows_at_any_field(spark):
    """Any changed text folds to another root; an unchanged one to the root."""
    from pyspark.sql import functions as F
    docs = data.documents(spark).filter("length(text) > 0")
    entries = merkle.verify(merkle.manifest(docs, F.lit(True), lambda text: F.concat(text, F.lit(" "))))
    assert not any(r.verified for r in entries.collect())
    assert all(r.verified for r in merkle.verify(merkle.manifest(docs)).collect())


def test_no_window_spans_more_than_a_block(spark):
    plan = merkle._climb(merkle._blocks(spark.createDataFrame([("a", 0, 5, "x")], "tree string, place long, nodes long, node string")), True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "tree#" in text and "block#" in text
