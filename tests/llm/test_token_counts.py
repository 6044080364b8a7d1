"""Token counts against the unmodified libraries, and the digest cache."""

import pytest
from pyspark.sql import functions as F

from kestrel.llm import token_counts
from tests.llm import data

public_tokenizers = pytest.importorskip("public_tokenizers")

HARD = ["<|endoftext|>", "a <|endoftext|> B", "<|ENDOFTEXT|> x", "a<|startoftext|>b<|endoftext|>", "J̌ ǰ H̱ T̈ İ I", "  A  b\t\tC\n", "don't DON'T I'LL we'Ve",
        "x y z", "K Å ﬁ", "a ́b", "日本 語１２", "é, É.", "\x1c a \x85 b", "12 345 6.7e8", "a" * 3000, "…!?" * 900, "ß ẞ ŉ"]


def counts(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def all_rows():
    rows = data.rows()
    rows += [(100 + k, t, "en", "s", 0) for k, t in enumerate(HARD)]
    return rows + [rows[0], (None, "some text", None, None, None), (None, "other text", None, None, None), (None, None, None, None, None), (3, "third", "en", "s0", 1)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, name):
    count = counts(name)
    rows = all_rows()
    want = sorted(((r[0], len((r[1] or "").encode()), n := count(r[1] or ""), n > 100) for r in rows), key=str)
    for df in (data.documents(spark, rows), data.clashing(data.documents(spark, rows)).withColumn("content", F.lit(1)).withColumn("n_tokens", F.lit(1))):
        got = token_counts.token_counts(df, public_tokenizers.path(name), limit=100).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_empty_table(spark):
    assert token_counts.token_counts(data.documents(spark, [])).collect() == []


def test_only_misses_are_encoded_and_appended(spark, tmp_path, monkeypatch):
    cache, path = str(tmp_path / "cache"), token_counts.default_tokenizer()
    first = [(k, f"Text  number {k % 20}", "en", "s", 0) for k in range(200)]
    again = [(k, f"text number {k % 25}\n", "fr", "t", 1) for k in range(300)]
    read = lambda: spark.read.schema(token_counts.CACHE_ROWS).parquet(cache).collect()
    misses = []
    fill = token_counts.fill_cache

    def counted(*args):
        out = fill(*args)
        misses.append(out.count())
        return out
    monkeypatch.setattr(token_counts, "fill_cache", counted)
    for rows in (first, again, again):
        got = token_counts.token_counts(data.documents(spark, rows), path, cache).collect()
        count = counts("word_bpe_49k.json")
        assert {r.doc_id: r.n_tokens for r in got} == {r[0]: count(r[1]) for r in rows}
    assert misses == [20, 5, 0] and len(read()) == 25
    # Another version of the tokenizer meets none of these counts.
    monkeypatch.setattr(token_counts, "version_digest", lambda p: "other")
    token_counts.token_counts(data.documents(spark, again), path, cache).collect()
    assert misses[-1] == 25 and len(read()) == 50


def test_stored_counts_are_used_and_repeats_tolerated(spark, tmp_path):
    """A count in the cache is taken as it is, also when two runs appended it."""
    cache, path = str(tmp_path / "cache"), token_counts.default_tokenizer()
    docs = data.documents(spark, [(1, "a b c", None, None, None), (2, "A  B c", None, None, None)])
    content = docs.select(token_counts.digest(token_counts.normalised(F.col("text"), path)).alias("content")).distinct()
    assert content.count() == 1
    stored = content.withColumns({"n_tokens": F.lit(77).cast("long"), "tokenizer": F.lit(token_counts.version_digest(path))})
    for _ in range(2):
        stored.write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert [r.n_tokens for r in token_counts.token_counts(docs, path, cache).collect()] == [77, 77]


def test_versions_and_kinds_of_tokenizers(tmp_path):
    paths = [public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")]
    assert len({token_counts.version_digest(p) for p in paths}) == 3
    assert [token_counts.drops_white_space(p) for p in paths] == [True, False, False]
    assert token_counts.lower_cases(paths[0]) and not token_counts.lower_cases(paths[1])


def test_pieces_are_remembered_in_two_generations(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 3)
    asked = []

    def count(texts):
        asked.extend(texts)
        return [len(t) for t in texts]
    counter = token_counts.PieceCounter(count)
    for texts in (["a bb", ""], ["ccc dddd"], ["a ccc a"], ["bb e"], ["", "zz zz"]):
        assert counter.count(pa.array(texts)).tolist() == [sum(map(len, t.split(" "))) for t in texts]
    assert asked.count("a") == 1 and asked.count("zz") == 1
