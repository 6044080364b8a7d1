"""Token ids as length-delimited binary records (operator 7).

A shard file is a run of records, each framed as

    length   unsigned 64 bits      bytes of the payload
    check    unsigned 32 bits      masked CRC-32 of the length field
    payload  length bytes          one serialized sequence
    check    unsigned 32 bits      masked CRC-32 of the payload

(all little-endian; a mask rotates the checksum and adds a constant, so that
data holding its own checksum still verifies). A payload is a flag byte
(1: no doc_id, 2: ids of four bytes instead of two), the doc_id and the ids.
Beside every shard ``X`` stands ``X.idx``: the offset of each record and the
file's end, as unsigned 64-bit integers, for reads in any order.

Documents are range-partitioned and sorted by doc_id (ties by a hash), so shard number order
is ascending doc_id order; each task streams its partition into one shard and
holds a few batches of texts at a time. A shard's file name carries the task
attempt; the manifest table, committed by Spark, names the file of the attempt
that won, so lost or repeated tasks leave at most unread files. Files go to
the shared folder through pyarrow's file systems (local mounts, HDFS, object
stores).

Defined results
    null or empty text    one record that holds the end id alone
    null doc_id           first, before all others
    very long text        cut for the tokenizer at single separators, where
                          its pre-tokenizer always cuts; the ids are those of
                          the whole text
    ties, repeated rows   repeated doc_ids in order of a hash of their text;
                          they may lie in several shards
    special token's string
                          that token, as the library does by default
    empty table           no shard, empty result
    extra columns         ignored
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.textcols import small_batches
from kestrel.session import materialize, scratch_path

END_ID = 0
MASK = 0xA282EAD8
BATCH_BYTES = 1 << 21
BATCH_PIECES = 4096
CACHE_PIECES = 1_000_000
# Anything but single separators between characters that no tokenizer takes
# for white space; and one space between such characters.
ODD = "[^\n !-~\u00c0-\u024f]|[ \n][ \n]|\\A[ \n]|[ \n]\\z"
CUT = re.compile("(?<=[!-~\u00c0-\u024f]) (?=[!-~\u00c0-\u024f])")
MANIFEST = "shard int, path string, docs long, ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def serialize(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(ids.size) and int(ids.max()) > 0xFFFF
    head = struct.pack("<Bq", (doc_id is None) | wide << 1, doc_id or 0)
    return head + ids.astype("<u4" if wide else "<u2").tobytes()


def deserialize(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4")


def read_record(stream) -> bytes | None:
    """The next payload; None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    length, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    body = stream.read(length + 4)
    if len(body) != length + 4 or masked(body[:length]) != struct.unpack_from("<I", body, length)[0]:
        raise ValueError("damaged record")
    return body[:length]


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def read_at(path: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records of one shard by number, in any order, through its index."""
    store, inner = _file_system(path)
    with store.open_input_file(inner + ".idx") as f:
        offsets = np.frombuffer(f.read(), "<u8")
    out = []
    with store.open_input_file(inner) as f:
        for k in numbers:
            f.seek(int(offsets[k]))
            out.append(deserialize(read_record(f)))
    return out


def _spliced(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class PieceEncoder:
    """Ids of whole texts, with repeated pieces encoded once.

    A single space or line end between two visible characters always starts a
    new pre-token of a byte-level tokenizer, so a text is the pieces before
    such characters, each but the first with its separator in front. A batch of
    texts is cut by Arrow and its distinct pieces are looked up; known pieces
    have a number, under which their ids stand in one array. Beyond
    ``CACHE_PIECES`` (or one batch's) the pieces are forgotten and learned anew.

    The tokenizer is used as it is loaded, so a special token's string in a
    text becomes that token. Cutting leaves this alone unless the token takes
    in the white space around it; texts with such a string stay whole."""

    def __init__(self, tokenizer):
        self._encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        self._whole = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.lstrip or t.rstrip or t.single_word or " " in t.content]
        vocabulary = tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # the byte level's space
        self._forget()

    def _forget(self) -> None:
        # Number 0 is the end of a text.
        self._numbers: dict[str, int] = {}
        self._ids, self._used = np.full(1 << 16, END_ID, "<u4"), 1
        self._starts, self._lengths = np.zeros(1 << 12, np.int64), np.ones(1 << 12, np.int64)

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces."""
        new = [p for p in pieces if p not in self._numbers]
        if new and self._numbers and len(self._numbers) + len(new) > CACHE_PIECES:
            self._forget()
            new = pieces
        for part in self._parts(new):
            flat, lengths = self._encoded(part)
            first, last = len(self._numbers) + 1, len(self._numbers) + 1 + len(part)
            while self._used + len(flat) > len(self._ids):
                self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
            while last > len(self._starts):
                self._starts, self._lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self._starts, self._lengths))
            self._ids[self._used:self._used + len(flat)] = flat
            self._lengths[first:last] = lengths
            self._starts[first:last] = self._used + np.cumsum(lengths) - lengths
            self._used += len(flat)
            self._numbers.update(zip(part, range(first, last)))
        return np.fromiter(map(self._numbers.__getitem__, pieces), np.int64, len(pieces))

    @staticmethod
    def _parts(new: list[str]) -> Iterator[list[str]]:
        """Batches of pieces that are one space and a word, and of the others."""
        words = [p for p in new if p[:1] == " " and len(p.split()) == 1]
        others = [p for p in new if not (p[:1] == " " and len(p.split()) == 1)] if len(words) < len(new) else []
        for kind in (words, others):
            yield from (kind[at:at + BATCH_PIECES] for at in range(0, len(kind), BATCH_PIECES))

    def _encoded(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces end to end, and how many each has."""
        if part[0][:1] == " ":
            # Each has one token that starts with a space, its first, so all
            # can be encoded as one text and told apart.
            flat = np.asarray(self._encode(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self._spaced[flat])
            if len(starts) == len(part) and starts[0] == 0:
                return flat, np.diff(np.append(starts, len(flat)))
        found = [e.ids for e in self._encode(part, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", int(lengths.sum())), lengths

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text with separators of any kind."""
        if any(s in text for s in self._whole):
            return [text]
        first, *rest = CUT.split(text)
        return [first, *(" " + p for p in rest)]

    def _plain(self, texts: pa.Array) -> np.ndarray:
        """Texts whose spaces and line ends are all single and between visible characters."""
        plain = ~pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        for special in self._whole:
            plain &= ~pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        return plain

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        texts = texts.cast(pa.large_string())
        plain = self._plain(texts)
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        marked = texts.filter(pa.array(plain))
        for separator in (" ", "\n"):  # plain texts hold no NUL
            marked = pc.replace_substring(marked, separator, "\0" + separator)
        split = pc.split_pattern(marked, "\0")
        pieces = split.flatten().dictionary_encode()
        odd = [self._cut(t) for t in texts.filter(pa.array(~plain)).to_pylist()]
        todo = [
            (np.flatnonzero(plain), lambda: self._learn(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()], np.diff(split.offsets.to_numpy())),
            (np.flatnonzero(~plain), lambda: self._learn_all(odd), np.fromiter(map(len, odd), np.int64, len(odd)))]
        for at, numbers, counts in todo:
            if len(at):
                # A zero, the end id's number, after every text's pieces.
                numbers = np.insert(numbers(), np.cumsum(counts), 0)
                lengths = self._lengths[numbers]
                ids = _spliced(self._ids, self._starts[numbers], lengths)
                ends = np.cumsum(lengths)[np.cumsum(counts + 1) - 1]
                for k, part in zip(at.tolist(), np.split(ids, ends[:-1])):
                    out[k] = part
        return out

    def _learn_all(self, cut: list[list[str]]) -> np.ndarray:
        flat = list(chain.from_iterable(cut))
        distinct = list(dict.fromkeys(flat))
        place = dict(zip(distinct, self._learn(distinct).tolist()))
        return np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))


# One encoder per tokenizer file: worker processes are reused, and so is what
# they have learned.
_encoders: dict[str, PieceEncoder] = {}


def _encoder(tokenizer_path: str) -> PieceEncoder:
    if tokenizer_path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _encoders[tokenizer_path] = PieceEncoder(Tokenizer.from_file(tokenizer_path))
    return _encoders[tokenizer_path]


def _batches_of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """doc_ids and texts of about ``BATCH_BYTES``, nulls as empty texts."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[list, pa.Array]:
        table = pa.Table.from_batches(held)
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").combine_chunks()
        return table["doc_id"].to_pylist(), texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts

    for batch in batches:
        if len(batch):
            held.append(batch)
        if sum(b.nbytes for b in held) >= BATCH_BYTES:
            yield joined()
            held = []
    if held:
        yield joined()


def _write_shard(tokenizer_path: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _batches_of_text(batches)
        first = next(work, None)
        if first is None:
            return
        encoder = _encoder(tokenizer_path)
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        store, inner = _file_system(path)
        offsets, at, total = [], 0, 0
        with store.open_output_stream(inner) as out:
            for doc_ids, texts in chain([first], work):
                for doc_id, ids in zip(doc_ids, encoder.encode(texts)):
                    record = frame(serialize(doc_id, ids))
                    out.write(record)
                    offsets.append(at)
                    at += len(record)
                    total += len(ids)
        with store.open_output_stream(inner + ".idx") as out:
            out.write(np.asarray([*offsets, at], "<u8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [path],
            "docs": pa.array([len(offsets)], pa.int64()), "ids": pa.array([total], pa.int64())})
    return run


def write_records(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None) -> DataFrame:
    """Encode and write every document; returns the manifest (shard, path,
    docs, ids), one row per file, as a written table."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    store, inner = _file_system(folder)
    store.create_dir(inner, recursive=True)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               # The hash spreads documents of one doc_id, or of none.
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))
    return materialize(ordered.mapInArrow(_write_shard(tokenizer_path or default_tokenizer(), folder), MANIFEST),
                       "token-manifest")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            store, inner = _file_system(path)
            rows: list[tuple] = []
            with store.open_input_stream(inner, buffer_size=1 << 20) as f:
                while (payload := read_record(f)) is not None:
                    doc_id, ids = deserialize(payload)
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(rows) == 4096:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(names, zip(*rows))})


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the files. The manifest has one
    row per file; its running sum of ids gives every file's first position."""
    files, start = [], 0
    for shard in sorted(manifest.collect(), key=lambda r: r["shard"]):
        files.append((shard["path"], start))
        start += shard["ids"]
    todo = spark.createDataFrame(files, "path string, start long")
    return todo.repartition(max(1, len(files))).mapInArrow(_read_shards, READ)


def token_report(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    return read_records(docs.sparkSession, write_records(docs, tokenizer_path))
