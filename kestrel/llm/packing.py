"""Best-fit packing into several permitted sequence lengths (operator 9).

Documents are dealt by hash into blocks of about 8,192; each block is packed
alone, best fit in descending size. When no open bin holds a document a new
one is opened in the permitted capacity with the least cost per word it can
expect to carry, and at the end every bin is downsized to the smallest
permitted capacity that holds its contents. The capacities are optimised
jointly: the block is packed once under every limit on the opened size, and
the packing with the least total cost stays. Documents longer than the
largest capacity become full bins plus one remaining piece.

Only doc_id, size and block are shuffled, dealt by a hash of doc_id, size and
text, so that rows without an id spread too; a task streams its blocks and
holds one at a time (``BLOCK_MOST`` pieces and one batch at most, the pieces
that long documents are cut into counted), so no source, length or copy group
can grow a task.

Defined results
    null or empty text    one row with length 0 in no bin (null bin)
    very long text        consecutive pieces, all words placed
    ties, repeated rows   each row is packed on its own
    empty table           empty result
    extra columns         ignored
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.textcols import small_batches, word_count

CAPACITIES = (256, 512, 1024, 2048, 4096)
OVERHEAD = 16  # cost of a bin beyond its capacity, in words
BLOCK_ROWS = 8192
BLOCK_MOST = 8 * BLOCK_ROWS
SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("bin", pa.int64()), ("bin_offset", pa.int64()), ("capacity", pa.int32())])
RESULT = "doc_id long, piece int, start long, length long, bin long, bin_offset long, capacity int"


def _downsized(filled: np.ndarray, capacities: Sequence[int]) -> np.ndarray:
    return np.asarray(capacities)[np.searchsorted(capacities, filled)]


def _pack_under(sizes: np.ndarray, capacities: Sequence[int], limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit decreasing, opening no bin above ``limit`` unless the item
    needs it. ``sizes`` descend. Returns bin, offset per item and fill per bin."""
    left_after = np.cumsum(sizes[::-1])[::-1]
    spaces: list[tuple[int, int]] = []  # (free words, bin), ascending
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    filled: list[int] = []
    capacity: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        at = bisect_left(spaces, (size, -1))
        if at < len(spaces):
            free, b = spaces.pop(at)
        else:
            fits = [c for c in capacities if c >= size]
            allowed = [c for c in fits if c <= limit] or fits[:1]
            expected = int(left_after[i])
            free = min(allowed, key=lambda c: ((c + OVERHEAD) / min(c, expected), c))
            b = len(filled)
            filled.append(0)
            capacity.append(free)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += size
        if free > size:
            insort(spaces, (free - size, b))
    return bins, offsets, np.asarray(filled, np.int64)


def pack(sizes: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item and the final capacity of each bin, for
    positive sizes of at most the largest capacity in descending order."""
    best = None
    for limit in capacities:
        bins, offsets, filled = _pack_under(sizes, capacities, limit)
        final = _downsized(filled, capacities)
        cost = int(final.sum()) + OVERHEAD * len(final)
        if best is None or cost < best[0]:
            best = (cost, bins, offsets, final)
    return best[1:]


def _pieces(frame: pd.DataFrame, largest: int) -> pd.DataFrame:
    """One row per piece; every piece but a document's last is full."""
    n = np.maximum(1, -(-frame["size"].to_numpy(np.int64) // largest))
    out = frame.loc[np.repeat(frame.index, n)].reset_index(drop=True)
    out["piece"] = np.concatenate([np.arange(k) for k in n]) if len(n) else []
    out["start"] = out["piece"] * largest
    out["length"] = np.minimum(out["size"] - out["start"], largest)
    return out


def _pack_block(frame: pd.DataFrame, block: int, part: int, capacities: Sequence[int]) -> pd.DataFrame:
    items = _pieces(frame, max(capacities)).sort_values("length", ascending=False, kind="stable").reset_index(drop=True)
    placed = int((items["length"] > 0).sum())
    bins, offsets, final = pack(items["length"].to_numpy(np.int64)[:placed], capacities)
    blank = [None] * (len(items) - placed)
    first = (block << 40) | (part << 24)
    return pd.DataFrame({
        "doc_id": items["doc_id"], "piece": items["piece"].astype("int32"), "start": items["start"], "length": items["length"],
        "bin": pd.array([*(first + bins).tolist(), *blank], "Int64"),
        "bin_offset": pd.array([*offsets.tolist(), *blank], "Int64"),
        "capacity": pd.array([*final[bins].tolist(), *blank], "Int32")})


def _pack_blocks(capacities: Sequence[int], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        block, part, pieces = None, 0, 0

        def flush():
            nonlocal held, pieces
            out = _pack_block(pd.concat(held, ignore_index=True), block, part, capacities)
            held, pieces = [], 0
            return pa.RecordBatch.from_pandas(out, schema=SCHEMA, preserve_index=False)

        for batch in batches:
            # Nullable integers: an id must not pass through a float.
            frame = batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
            for now, rows in frame.groupby("block", sort=True):
                now = int(now)
                if held and now != block:
                    yield flush()
                    part = 0
                elif held and pieces >= most:
                    yield flush()
                    part += 1
                if now != block:
                    part = 0
                block = now
                held.append(rows)
                pieces += int(np.maximum(1, -(-rows["size"].to_numpy(np.int64) // max(capacities))).sum())
        if held:
            yield flush()
    return run


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """One row per document piece with its bin, its offset there and the
    bin's capacity. Sizes are words."""
    small_batches(docs.sparkSession)
    capacities = tuple(sorted(capacities))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"), F.xxhash64(F.col("text")).alias("text_hash"))
    n_blocks = max(1, -(-docs.count() // BLOCK_ROWS))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "text_hash"), F.lit(n_blocks)).cast("long")).drop("text_hash")
    return (dealt.repartition("block").sortWithinPartitions("block", F.col("size").desc(), "doc_id")
            .mapInArrow(_pack_blocks(capacities, BLOCK_MOST), RESULT))
