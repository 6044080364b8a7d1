"""Token counts through a digest cache (operator 13).

The cache is a Parquet table in shared storage: (tokenizer, content, n_tokens),
partitioned by tokenizer. ``tokenizer`` is the digest of the tokenizer's file
and its library's version, ``content`` the SHA-256 of a text's normalised
content, so a changed vocabulary or library never meets old counts. A run

1.  digests every text (built-in functions; the texts stay where they are),
2.  joins the distinct digests to the cache and picks one row of each miss,
3.  encodes those rows' texts, each content once however many copies it has,
4.  appends the counts to the cache and joins all documents to it.

Normalising only merges texts whose counts are bound to be equal. For a
tokenizer that drops white space, runs of it become one space; one that also
lower-cases has A-Z lowered in texts that are all ASCII (elsewhere a lowered
letter may join its combining mark) and hold no start of a special token.
Other tokenizers get the text as it is.

Inside a task a batch of texts is cut at its spaces, where such a tokenizer
always cuts, each distinct piece is encoded once and the counts are added up
by offset; pieces are remembered in two generations of ``KNOWN_PIECES``.

A lost task is run again by Spark; the cache is appended to by Spark's commit
protocol, so rows of a failed run are never seen. Two runs at once may both
append a content: equal rows, of which one is read.

Defined results
    null or empty text    0 bytes, 0 tokens
    white space only      its bytes, the tokenizer's count (0 if dropped)
    very long text        counted whole, in pieces; nothing is truncated
    repeated texts        encoded once, a count for every row
    null or repeated doc_id
                          passed on; rows are told apart by content
    empty table           empty result, nothing appended
    extra columns         ignored
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.textcols import WHITE_SPACE, WHITE_SPACE_RUN, small_batches, text_or_empty
from kestrel.session import discard, materialize, scratch_path

LIMIT = 2048
KNOWN_PIECES = 1_000_000
CACHE_ROWS = "content binary, n_tokens long, tokenizer string"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# --- what a tokenizer file says -----------------------------------------------------

def version_digest(tokenizer_path: str) -> str:
    """Digest of the vocabulary file, its library and the library's version."""
    library = "sentencepiece" if tokenizer_path.endswith(".model") else "tokenizers"
    with open(tokenizer_path, "rb") as f:
        content = hashlib.file_digest(f, "sha256").hexdigest()
    return hashlib.sha256(f"{library} {__import__(library).__version__} {content}".encode()).hexdigest()


def _parts(node: dict | None, inner: str) -> list[dict]:
    return [] if node is None else node[inner] if node["type"] == "Sequence" else [node]


def drops_white_space(tokenizer_path: str) -> bool:
    """Does the tokenizer keep nothing of white space, and cut at it?"""
    if not tokenizer_path.endswith(".json"):
        return False
    import regex
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    first = next(iter(_parts(spec["pre_tokenizer"], "pretokenizers")), {})
    if first.get("type") != "Split" or first["behavior"] != "Removed" or not first["invert"] or "Regex" not in first["pattern"]:
        return False
    # What the pattern matches is kept: nothing of it may be white space.
    probe = WHITE_SPACE.join(["", "word", "'s", "7", "?!", "é́", "日", ""])
    return not any(set(m) & set(WHITE_SPACE) for m in regex.findall(first["pattern"]["Regex"], probe))


def lower_cases(tokenizer_path: str) -> bool:
    with open(tokenizer_path, encoding="utf-8") as f:
        return any(n["type"] == "Lowercase" for n in _parts(json.load(f)["normalizer"], "normalizers"))


def normalised(text: Column, tokenizer_path: str) -> Column:
    """Content that texts of necessarily equal counts share; empty for null."""
    text = text_or_empty(text)
    if not drops_white_space(tokenizer_path):
        return text
    spaced = F.btrim(F.regexp_replace(text, WHITE_SPACE_RUN, " "))
    if not lower_cases(tokenizer_path):
        return spaced
    plain = (F.octet_length(text) == F.char_length(text)) & ~F.contains(text, F.lit("<|"))
    return F.when(plain, F.lower(spaced)).otherwise(spaced)


# --- counting in a task -----------------------------------------------------------

def _counter(tokenizer_path: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole strings by the library, special strings as it does by default."""
    if tokenizer_path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=tokenizer_path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceCounter:
    """Counts of texts that may be cut at spaces, each piece encoded once."""

    def __init__(self, count: Callable[[list[str]], list[int]]):
        self._count = count
        self._known: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def _counts(self, pieces: list[str]) -> np.ndarray:
        if len(self._known) > KNOWN_PIECES:
            self._known, self._old = {}, self._known
        new = [p for p in pieces if p not in self._known]
        again = [p for p in new if p in self._old]
        self._known.update((p, self._old[p]) for p in again)
        new = [p for p in new if p not in self._old] if again else new
        self._known.update(zip(new, self._count(new)))
        return np.fromiter(map(self._known.__getitem__, pieces), np.int64, len(pieces))

    def count(self, texts: pa.Array) -> np.ndarray:
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        pieces = split.flatten().dictionary_encode()
        counts = self._counts(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ends[at[1:]] - ends[at[:-1]]


_counters: dict[str, PieceCounter] = {}  # kept by a worker between its tasks


def _count_batches(tokenizer_path: str, by_piece: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _counters:
            _counters[tokenizer_path] = PieceCounter(_counter(tokenizer_path))
        counter = _counters[tokenizer_path]
        for batch in batches:
            texts = batch.column("normal")
            found = counter.count(texts) if by_piece else np.asarray(counter._count(texts.to_pylist()), np.int64)
            yield pa.RecordBatch.from_pydict({"content": batch.column("content"), "n_tokens": pa.array(found, pa.int64())})
    return run


# --- the cache ----------------------------------------------------------------------

def cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(content, n_tokens) that the cache holds for one tokenizer version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "content binary, n_tokens long")
    rows = spark.read.schema(CACHE_ROWS).parquet(cache_path).filter(F.col("tokenizer") == version)
    # Runs at the same time may both have appended a content.
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, keys: DataFrame, cache_path: str, tokenizer_path: str, version: str) -> DataFrame:
    """Encode the contents of ``keys`` that the cache lacks, append them and
    return the misses (content, row)."""
    spark = docs.sparkSession
    missing = materialize(
        keys.groupBy("content").agg(F.min("row").alias("row"))
        .join(cached(spark, cache_path, version), "content", "left_anti"), "count-misses")
    normal = normalised(F.col("text"), tokenizer_path)
    texts = (docs.select("text", F.xxhash64("doc_id").alias("row")).select("row", normal.alias("normal"))
             .select("row", "normal", digest(F.col("normal")).alias("content"))
             .join(missing, ["content", "row"])
             # Rows of one doc_id may share a text.
             .dropDuplicates(["content", "row"]).select("content", "normal"))
    by_piece = drops_white_space(tokenizer_path)
    (texts.mapInArrow(_count_batches(tokenizer_path, by_piece), "content binary, n_tokens long")
     .withColumn("tokenizer", F.lit(version))
     .write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    return missing


def digest(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, cache_path: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of
    every document. ``cache_path`` names the cache in shared storage, made by
    the first run and added to by later ones; without it a fresh one is used."""
    spark = docs.sparkSession
    small_batches(spark)
    tokenizer_path = tokenizer_path or default_tokenizer()
    cache_path = cache_path or scratch_path(spark, "token-counts")
    version = version_digest(tokenizer_path)
    keys = materialize(
        docs.select("doc_id", F.octet_length(text_or_empty(F.col("text"))).cast("long").alias("n_bytes"),
                    F.xxhash64("doc_id").alias("row"), digest(normalised(F.col("text"), tokenizer_path)).alias("content")), "count-keys")
    discard(fill_cache(docs, keys, cache_path, tokenizer_path, version))
    counted = keys.join(cached(spark, cache_path, version), "content")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
