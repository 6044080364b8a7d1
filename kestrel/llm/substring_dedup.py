"""Suffix-array deduplication of repeated byte strings (operator 4).

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else
(other documents or the same one) is removed. The steps:

1.  Each text's windows get an anchor: the smallest hash among the 32-byte
    grams of the window, leftmost on ties. It depends on the window's bytes
    alone, so equal windows have equal anchors at equal places. Neighbouring
    windows mostly share an anchor: one row per run of windows, about one per
    180 bytes. Only anchors met twice or more go on (map-side combined count).
2.  Equal texts stand together from here (one representative, a count); a text
    of at least one window that occurs twice is removed whole.
3.  The bytes of the remaining runs are dealt to buckets by anchor; an anchor
    met more than ``BUCKET_RUNS`` times is salted over buckets of about that
    size. A task joins its buckets to blocks of under 1 MB of distinct
    strings, builds the block's suffix array by two-stage sorting, and marks
    the windows whose adjacent suffixes share ``WINDOW`` bytes.
4.  Salted buckets hand on one representative per distinct window; a window
    repeated inside a bucket is marked there already, so representatives are
    all that is left to compare. They are keyed by their anchor, the 64
    possible distances to it that they fall in, and the bytes that all windows
    at such distances share. Keys met once are done (counted with map-side
    combine, before any bytes move); keys of up to ``BUCKET_RUNS`` rows are
    buckets again; rows of a hotter key are cut to 16, 4 and then single
    distances, which lengthens the shared bytes, down to the window itself.
    Equal keys are equal windows then and only counted. So no task ever holds
    more than ``BUCKET_RUNS`` rows of a key, in how many texts a passage stands.
5.  Marked spans are merged per text; built-in functions cut the texts.

Tables between the steps are written to the shared folder. Matches never
cross texts, and nothing is dropped: a hot anchor costs more buckets.

Defined results
    null text             empty: 0 bytes, nothing removed, hash of nothing
    short text            under one window: nothing removed
    very long text        anchors in pieces of 1 MB that overlap by a window
    repeated rows, ties   rows are documents of their own, so a repeated text
                          of at least one window is removed from each
    null or repeated doc_id
                          texts are known by their MD5, ids only passed on
    empty table           empty result
    extra columns         ignored by the report
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import suffix_array as sa
from kestrel.llm.textcols import small_batches
from kestrel.session import materialize

WINDOW = 400
GRAM = 32
PIECE = 1 << 20
BUCKET_RUNS = 256
BLOCK_BYTES = 900_000
SHIFTS = (64, 16, 4, 1)  # distances from the anchor that share a later key
BASE = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 20) - 1)

RUN_ROWS = "doc_id long, tid binary, anchor long, p long, q long, at long"
FOUND_ROWS = "kind string, tid binary, p long, q long, at long, anchor long, salt long, salts long, bytes binary"
CUT_ROWS = "tid binary, n_removed long, n_spans long, last long, kept array<struct<at:long,n:long>>"
KEY_ROWS = 512


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


# --- anchors ----------------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, kept between calls."""
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            cls.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE))])
            cls.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse))])
        return cls.up[:n], cls.down[:n]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes at each position that has them."""
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:-1], out=sums[1:])
    m = len(data) - gram + 1
    return _mixed((sums[gram:] - sums[:m]) * down[:m])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(back[:m], ahead[width - 1:width - 1 + m])


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor over texts laid end to end.

    Returns text number, anchor hash, first start, last start + 1 and anchor
    position, in positions of ``data`` (under 1 MB + one window long)."""
    m = len(data) - WINDOW + 1
    if m <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    hashes = gram_hashes(data.astype(np.uint64))
    # 44 bits of hash, then the position: the smallest is the leftmost.
    relative = np.arange(len(hashes), dtype=np.uint64)
    best = np.full(m, 0, np.int64)
    block = 1 << 19
    for a in range(0, m, block):  # positions relative to the block fit 20 bits
        b = min(m, a + block)
        part = slice(a, b + WINDOW - GRAM)
        keys = (hashes[part] & ~LOW) | (relative[part] - np.uint64(a))
        best[a:b] = (sliding_min(keys, WINDOW - GRAM + 1) & LOW).astype(np.int64) + a
    text = np.searchsorted(ends, np.arange(m), side="right")
    inside = np.arange(m) + WINDOW <= ends[np.minimum(text, len(ends) - 1)]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.ones(len(starts), bool)
    new[1:] = ((best[starts[1:]] != best[starts[:-1]]) | (text[starts[1:]] != text[starts[:-1]])
               | (np.diff(starts) != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    at = best[starts[first]]
    return text[starts[first]], hashes[at].view(np.int64), starts[first], starts[last] + 1, at


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column end to end, and the end of each text."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(ids, tids, text, anchor, p, q, at):
        return pa.RecordBatch.from_pydict({
            "doc_id": ids.take(pa.array(text)), "tid": pa.array([tids[t] for t in text.tolist()], pa.binary()), "anchor": pa.array(anchor, pa.int64()),
            "p": pa.array(p, pa.int64()), "q": pa.array(q, pa.int64()), "at": pa.array(at, pa.int64())})

    for batch in batches:
        ids, tids = batch.column("doc_id"), batch.column("tid").to_pylist()
        data, ends = _text_bytes(batch.column("text"))
        begins = np.append(0, ends[:-1]).astype(np.int64)
        k = 0
        while k < len(tids):
            # As many whole texts as fit a piece, or one long text in pieces.
            upto = max(k + 1, int(np.searchsorted(ends, begins[k] + PIECE, side="right")))
            for a in range(int(begins[k]), max(int(begins[k]) + 1, int(ends[upto - 1]) - WINDOW + 1), PIECE):
                b = min(int(ends[upto - 1]), a + PIECE + WINDOW - 1)
                text, anchor, p, q, at = anchor_runs(data[a:b], np.minimum(ends[k:upto], b) - a)
                if len(text):
                    shift = a - begins[k + text]
                    yield rows(ids, tids, k + text, anchor, p + shift, q + shift, at + shift)
            k = upto


# --- blocks -----------------------------------------------------------------------

def repeated_windows(strings: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each distinct string: is the window at each start met elsewhere in
    the block, and is it its class's representative?"""
    symbols, plain, starts = sa.joined(strings)
    counts = np.fromiter((len(s) - WINDOW + 1 for s in strings), np.int64, len(strings))
    order = sa.suffix_array(symbols, WINDOW)
    string = np.searchsorted(starts, order, side="right") - 1
    valid = order[order - starts[string] < counts[string]]
    equal = sa.common_prefixes(plain, valid[:-1], valid[1:], WINDOW) == WINDOW
    repeated = np.zeros(len(plain), bool)
    repeated[valid[:-1][equal]] = True
    repeated[valid[1:][equal]] = True
    first = np.zeros(len(plain), bool)
    first[valid[np.append(True, ~equal)]] = True
    return ([repeated[s:s + n] for s, n in zip(starts, counts)], [first[s:s + n] for s, n in zip(starts, counts)])


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _block(buckets: list[list[dict]]) -> Iterator[dict]:
    """Marks and representatives of some whole buckets. Rows of a bucket with
    equal bytes are one string; a bucket with one string needs no sorting, as
    the windows of one run differ in their distance to the anchor."""
    def mark(row, a, b):
        return {"kind": "mark", "tid": row["tid"], "p": row["p"] + a, "q": row["p"] + b + WINDOW - 1}

    todo: list[tuple[list[dict], bool]] = []
    for bucket in buckets:
        by_bytes: dict[bytes, list[dict]] = {}
        for row in bucket:
            by_bytes.setdefault(row["bytes"], []).append(row)
        for rows in by_bytes.values():
            whole = len(rows) > 1
            if whole:
                yield from (mark(row, 0, row["q"] - row["p"]) for row in rows)
            if len(by_bytes) > 1 or rows[0]["salts"] > 1:
                todo.append((rows, len(by_bytes) > 1))
    sort = [rows[0] for rows, several in todo if several]
    flags = iter(zip(*repeated_windows([row["bytes"] for row in sort]))) if sort else iter(())
    for rows, several in todo:
        row = rows[0]
        n = row["q"] - row["p"]
        repeated, first = next(flags) if several else (np.zeros(n, bool), np.ones(n, bool))
        if len(rows) == 1:
            yield from (mark(row, a, b) for a, b in _spans(repeated))
        if row["salts"] > 1:
            for a, b in _spans(first):
                yield row | {"kind": "run", "p": row["p"] + a, "q": row["p"] + b,
                             "bytes": row["bytes"][a:b + WINDOW - 1]}


def _found(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.string()), ("tid", pa.binary()), ("p", pa.int64()), ("q", pa.int64()), ("at", pa.int64()),
                        ("anchor", pa.int64()), ("salt", pa.int64()), ("salts", pa.int64()), ("bytes", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _large_bucket(rows: list[dict]) -> Iterator[dict]:
    """A bucket beyond one block, exactly: its distinct strings are cut into
    half blocks, and every two of them are sorted together."""
    by_bytes: dict[bytes, list[dict]] = {}
    for row in rows:
        by_bytes.setdefault(row["bytes"], []).append(row)
    halves: list[list[dict]] = [[]]
    size = 0
    for same in by_bytes.values():
        size += len(same[0]["bytes"]) + 1
        if size > BLOCK_BYTES // 2:
            halves.append([])
            size = len(same[0]["bytes"]) + 1
        # A string met twice is marked for all its rows by the first block it is in.
        halves[-1].extend(same)
    for j, half in enumerate(halves):
        yield from _block([half])
        for other in halves[:j]:
            yield from (found for found in _block([other + half]) if found["kind"] == "mark")


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (anchor, salt); whole buckets are gathered up to
    ``BLOCK_BYTES`` and sorted together."""
    block: list[list[dict]] = []
    bucket: list[dict] = []
    key, filled, size = None, 0, 0

    def rows_of(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        rows = list(found)
        if rows:
            yield _found(rows)

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal block, bucket, filled, size
        if size > BLOCK_BYTES:
            yield from rows_of(_large_bucket(bucket))
        elif bucket:
            if filled + size > BLOCK_BYTES:
                yield from rows_of(_block(block))
                block, filled = [], 0
            block.append(bucket)
            filled += size
        bucket, size = [], 0

    for batch in batches:
        for row in batch.to_pylist():
            if (row["anchor"], row["salt"]) != key:
                yield from close()
                key = (row["anchor"], row["salt"])
            bucket.append(row)
            size += len(row["bytes"]) + 1
    yield from close()
    yield from rows_of(_block(block))


# --- steps ------------------------------------------------------------------------

def _dealt(runs: DataFrame) -> DataFrame:
    return (runs.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
            .mapInArrow(_sort_buckets, FOUND_ROWS))


def _next_key(shift: int):
    """Runs cut by distance to the anchor, with their key: the anchor and the
    bytes that all windows at such distances share. Single windows travel as
    their digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), KEY_ROWS):
                rows = []
                for row in batch.slice(at, KEY_ROWS).to_pylist():
                    start = row["p"]
                    while start < row["q"]:
                        level = (row["at"] - start) // shift
                        stop = min(row["q"], row["at"] - level * shift + 1)
                        a, b = start - row["p"], stop - row["p"]
                        core = row["at"] - level * shift - row["p"]
                        shared = row["bytes"][core:core + WINDOW - shift + 1]
                        key = hashlib.md5(b"%d,%d,%s" % (row["anchor"], level, shared)).digest()
                        rows.append(row | {"p": start, "q": stop, "bytes": key if shift == 1 else row["bytes"][a:b + WINDOW - 1],
                                           "salt": int.from_bytes(key[:8], "little", signed=True), "salts": 1})
                        start = stop
                yield _found(rows)
    return run


def _hot_windows(hot: DataFrame) -> Iterator[DataFrame]:
    """Marks among the representatives of the salted anchors (step 4)."""
    key = ["anchor", "salt"]
    for shift in SHIFTS:
        keyed = materialize(hot.mapInArrow(_next_key(shift), FOUND_ROWS), "suffix-keyed")
        if shift == 1:
            equal = [*key, "bytes"]
            often = keyed.groupBy(*equal).agg(F.count("*").alias("n")).filter("n > 1")
            yield keyed.join(often, equal).select("tid", "p", (F.col("p") + WINDOW).alias("q"))
            return
        sizes = materialize(keyed.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "suffix-sizes")
        yield _marks(materialize(_dealt(keyed.join(sizes.filter(F.col("n") <= BUCKET_RUNS), key).select(*keyed.columns)), "suffix-found"))
        hotter = sizes.filter(F.col("n") > BUCKET_RUNS)
        if hotter.isEmpty():
            return
        hot = keyed.join(hotter, key).select(*keyed.columns)


def _marks(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'mark'").select("tid", "p", "q")


def _emit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of every run of a text, a few hundred rows at a time."""
    rows: list[dict] = []
    for batch in batches:
        for tid, text, runs in zip(batch.column("tid"), batch.column("text"), batch.column("runs")):
            data, tid = text.as_buffer(), tid.as_py()
            for run in runs.as_py():
                rows.append(run | {"kind": "run", "tid": tid,
                                   "bytes": data.slice(run["p"], run["q"] - run["p"] + WINDOW - 1).to_pybytes()})
                if len(rows) >= 512:
                    yield _found(rows)
                    rows = []
    if rows:
        yield _found(rows)


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The candidate texts (tid, text, copies) and the spans (tid, p, q) that
    are covered by repeated windows."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                        text_id(F.col("text")).alias("tid")).filter(F.octet_length("text") >= WINDOW)
    runs = materialize(texts.mapInArrow(_runs, RUN_ROWS), "suffix-runs")
    # Written before the join, so that Spark may split a hot anchor's rows.
    counts = materialize(runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "suffix-anchors")
    salts = F.ceil(F.col("n") / F.lit(float(BUCKET_RUNS))).cast("long")
    salt = F.pmod(F.xxhash64("tid", "p"), F.col("salts"))
    per_text = (runs.join(counts, "anchor").withColumn("salts", salts)
                .groupBy("tid", "p").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"),
                                         F.min(F.struct("anchor", "q", "at", "salts")).alias("r"))
                .select("tid", "p", "copies", "doc_id", "r.*").withColumn("salt", salt)
                .groupBy("tid").agg(F.max("copies").alias("copies"), F.min("doc_id").alias("first_doc"), F.max("salts").alias("most"),
                                    F.collect_list(F.struct("p", "q", "at", "anchor", "salt", "salts")).alias("runs"))
                .withColumnRenamed("tid", "text_tid"))
    per_text = materialize(per_text, "suffix-candidates")
    held = texts.join(per_text, F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("tid") == F.col("text_tid")))
    held = materialize(held.select("tid", "text", "copies", "runs"), "suffix-texts")
    most = per_text.agg(F.max("most").alias("m")).first()["m"] or 1
    found = materialize(_dealt(held.select("tid", "text", "runs").mapInArrow(_emit_runs, FOUND_ROWS)), "suffix-found")
    spans = _marks(found)
    if most > 1:
        for more in _hot_windows(found.filter("kind = 'run'")):
            spans = spans.unionAll(more)
    return held, spans


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the stretches between the spans that are marked."""
    for batch in batches:
        rows = []
        for tid, spans in zip(batch.column("tid").to_pylist(), batch.column("spans").to_pylist()):
            kept, end, removed, n = [], 0, 0, 0
            for a, b in sorted((s["p"], s["q"]) for s in spans):
                if a > end or not n:
                    kept.append((end, a))
                    n += 1
                elif b <= end:
                    continue
                removed += b - max(a, end)
                end = b
            # The last stretch runs to the text's end, wherever that is.
            rows.append({"tid": tid, "n_removed": removed, "n_spans": n, "last": end,
                         "kept": [{"at": a, "n": b - a} for a, b in kept if b > a]})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("tid", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("last", pa.int64()),
            ("kept", pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))]))


def cuts(docs: DataFrame) -> DataFrame:
    """Per text that loses bytes: tid, how many, in how many spans, the kept
    stretches before the last span (at, n) and the last span's end."""
    held, spans = repeated_spans(docs)
    # Rows of a text that another text's copy removes whole need no spans.
    whole = held.filter("copies > 1").select(
        "tid", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.octet_length("text").cast("long").alias("last"), F.array().cast("array<struct<at:long,n:long>>").alias("kept")).dropDuplicates(["tid"])
    lists = (spans.groupBy("tid").agg(F.collect_list(F.struct("p", "q")).alias("spans"))
             .join(held.filter("copies = 1").select("tid"), "tid", "left_semi"))
    return whole.unionAll(lists.mapInArrow(_merged, CUT_ROWS))


def cut_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, n_bytes, n_removed, n_spans and
    kept, the remaining bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").alias("doc_id"), text.alias("bytes"), text_id(F.col("text")).alias("tid"))
    # Spans are a few numbers a text; Spark broadcasts them where they fit.
    cut = materialize(cuts(docs), "suffix-cut")
    stretch = lambda s: F.substring(F.col("bytes"), (s["at"] + 1).cast("int"), s["n"].cast("int"))
    rest = F.substring(F.col("bytes"), (F.col("last") + 1).cast("int"), F.octet_length("bytes"))
    kept = F.aggregate("kept", F.lit(b""), lambda before, s: F.concat(before, stretch(s)))
    zero = F.lit(0).cast("long")
    return rows.join(cut, "tid", "left").select(
        "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.when(F.col("last").isNull(), F.col("bytes")).otherwise(F.concat(kept, rest)).alias("kept"))


def substring_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the hash of what is left and
    kept_text: what is left as text (a character cut in two is U+FFFD)."""
    return cut_documents(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))
