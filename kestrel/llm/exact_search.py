"""Exact top-k inner-product search over an impact-ordered index (operator 1).

Vectors become integers floor(256 x). An index shard holds at most 4,096
vectors as posting segments: the segment (impact 2^p, dimension d) lists the
vectors whose component d, counted from the shard's smallest value, has bit p
set. Segments are stored and processed by descending impact, score at a time:
after each step of impact levels every vector's score is known up to an
interval, whose ends use what the shard's vectors can still gain in each
dimension. A vector whose upper end is below the query's bar is proven out;
proven queries and vectors leave the matrices. Processing stops when few
possible members are left (or all levels are read); these alone are rebuilt
from their postings and rescored exactly, ties to the smaller vec_id.

Bars and bounds cross shards. Rows and queries are dealt to shards and blocks
by the nearest of at most 256 centres, fitted on a bounded sample
(``SAMPLE_ROWS``; any centres give the same answer). Every block first
searches one shard of its own cell: the k-th score found is the query's bar
everywhere. Shard summaries (smallest and largest components, middle, radius)
then bound what a shard can hold for a query, and a query goes on only to
shards that its bar doesn't rule out. The bar is a score of k real rows and
equal scores pass it, so nothing is lost.

Each step joins on a shard or summary number: one work unit is a block of at
most 512 queries with one shard (or with some 256 summaries), k rows a query
out of each. Nothing is broadcast but the centres; no task holds more than
one shard and one block at a time.

Defined results
    null vectors, vectors with null or non-finite components, null vec_id
                          take no part
    finite components of 2^53 or more in size
                          take no part (256 times them is beyond a long);
                          a score beyond a long raises
    vectors of different lengths
                          missing components count as 0
    empty vector          scores 0 against everything
    repeated vec_id       a query never meets rows with its own vec_id; as
                          candidates repeated rows each count; as a query a
                          repeated vec_id stands once (its smallest vector)
    fewer than k others   all of them
    empty table           empty result
    extra columns         ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.textcols import small_batches
from kestrel.session import materialize

SCALE = 256
QUERY_STEP = 50
SHARD_ROWS = 4096
BLOCK_ROWS = 512
STEP = 3  # impact levels read between two proofs
ENOUGH = 16  # possible members a query, times k, at which levels stop being read
CELLS = 256
SAMPLE_ROWS = 8192
FIT_ROUNDS = 4
SUMMARIES = 256  # shard summaries a block is compared with at a time
LARGEST = float(1 << 53)
NO_BAR = np.iinfo(np.int64).min
CHUNK = 1 << 16
LARGEST_EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}


def quantised(vector: Column) -> Column:
    """The integer vector, or null if any component is unusable."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as an int64 matrix, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values[offsets[0]:offsets[-1]]
    return out


def _groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, ids, matrix) of at most ``rows`` vectors from rows sorted by group."""
    def flush(parts: list[pa.Table]):
        table = pa.concat_tables(parts)
        return table["group"][0].as_py(), table["vec_id"].to_numpy(), _matrix(table["vector"])

    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        groups = table["group"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1), len(groups)]
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                if held and (held[0]["group"][0].as_py() != groups[a] or sum(map(len, held)) >= rows):
                    yield flush(held)
                    held = []
                take = min(b - a, rows - sum(map(len, held)))
                held.append(table.slice(a, take))
                a += take
    if held:
        yield flush(held)


def _numbered(groups: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The groups with their number among pieces of the same group."""
    last, part = None, 0
    for group, ids, x in groups:
        last, part = group, part + 1 if group == last else 0
        yield group, part, ids, x


def shard_row(x: np.ndarray) -> dict:
    """Postings and summary of one shard's vectors."""
    width = x.shape[1]
    base = x.min(axis=0) if x.size else np.zeros(width, np.int64)
    above = (x - base).T.astype(np.uint64)
    levels = int(above.max(initial=0)).bit_length()
    segments = [np.packbits((above >> np.uint64(p)) & np.uint64(1) != 0, axis=1).tobytes()
                for p in range(levels - 1, -1, -1)]
    gains = np.array([(above & np.uint64((1 << p) - 1)).max(axis=1, initial=0) for p in range(levels, -1, -1)], np.uint64)
    middle = np.rint(x.mean(axis=0, dtype=np.float64)) if x.size else np.zeros(width)
    radius = float(np.sqrt(np.square(x - middle).sum(axis=1).max(initial=0)))
    return {"base": base, "segments": segments, "gains": gains.astype(np.int64), "middle": middle, "radius": radius}


def _index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group, part, ids, x in _numbered(_groups(batches, SHARD_ROWS)):
        row = shard_row(x)
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([group], pa.int64()), "part": pa.array([part], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()), "base": pa.array([row["base"].tobytes()], pa.binary()),
            "segments": pa.array([row["segments"]], pa.list_(pa.binary())),
            "gains": pa.array([row["gains"].tobytes()], pa.binary()),
            "middle": pa.array([row["middle"].tobytes()], pa.binary()), "radius": pa.array([row["radius"]], pa.float64())})


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group, part, ids, q in _numbered(_groups(batches, BLOCK_ROWS)):
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([group], pa.int64()), "block_part": pa.array([part], pa.int32()),
            "query_ids": pa.array([ids.tobytes()], pa.binary()), "queries": pa.array([q.tobytes()], pa.binary())})


def _fitted(q: np.ndarray, width: int) -> np.ndarray:
    """Query rows as wide as a shard: further components meet zeros."""
    return np.pad(q, ((0, 0), (0, max(0, width - q.shape[1]))))[:, :width]


def search_pair(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, base: np.ndarray, segments: list[bytes], k: int,
                gains: np.ndarray | None = None, bars: np.ndarray | None = None,
                work: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact top k of one shard for one block of queries, without what is
    below ``bars``: query ids, ids, scores. ``work`` counts the products of a
    query, a vector and a level that were looked at ("read") of "all"."""
    n, d, levels = len(ids), len(base), len(segments)
    q = _fitted(q, d)
    packed = [np.frombuffer(s, np.uint8).reshape(d, (n + 7) // 8) for s in segments]
    if gains is None:
        gains = np.array([[(1 << p) - 1] * d for p in range(levels, -1, -1)], object)
    # Python integers: no overflow while checking that the sums are exact.
    largest = d * max(1, int(np.abs(q).max(initial=0))) * ((1 << levels) + max((abs(int(b)) for b in base), default=0))
    kind = next((t for t, most in LARGEST_EXACT.items() if largest < most), None)
    rows, cols = np.arange(len(q)), np.arange(n)
    possible = query_ids[:, None] != ids[None, :]
    at, score = 0, None
    if kind is not None:
        most = LARGEST_EXACT[kind]
        bar = np.full(len(q), -np.inf, kind) if bars is None else np.clip(bars, -most, most).astype(kind)
        f = q.astype(kind)
        gains = gains.astype(kind)
        score = np.repeat((f @ base.astype(kind))[:, None], n, axis=1)
        while True:
            if len(cols) > k:
                low = np.where(possible, score + (np.minimum(f, 0) @ gains[at])[:, None], -np.inf)
                bar = np.maximum(bar, np.partition(low, len(cols) - k, axis=1)[:, len(cols) - k])
            possible &= score + (np.maximum(f, 0) @ gains[at])[:, None] >= bar[:, None]
            on, off = possible.any(axis=1), possible.any(axis=0)
            rows, f, bar = rows[on], f[on], bar[on]
            cols, possible, score = cols[off], possible[np.ix_(on, off)], score[np.ix_(on, off)]
            if at == levels or possible.sum() <= ENOUGH * k * len(rows):
                break
            upto = min(levels, at + STEP)
            digits = np.zeros((d, len(cols)), np.uint8)
            for plane in packed[at:upto]:
                digits = digits << 1 | np.unpackbits(plane, axis=1, count=n)[:, cols]
            score += (f @ digits.astype(kind)) * kind(1 << (levels - upto))
            if work is not None:
                work["read"] = work.get("read", 0) + score.size * (upto - at)
            at = upto
    if work is not None:
        work["all"] = work.get("all", 0) + len(q) * n * levels
    qi, xi = np.nonzero(possible)
    if score is not None and at == levels:
        exact = score[qi, xi].astype(np.int64)
    else:
        x = np.tile(base[:, None], (1, len(cols)))
        for p, plane in enumerate(packed):
            x += np.unpackbits(plane, axis=1, count=n)[:, cols].astype(np.int64) << (levels - p - 1)
        x, q = x.T, q[rows]
        if kind is None:
            x, q = x.astype(object), q.astype(object)
        exact = np.concatenate([(q[qi[a:a + CHUNK]] * x[xi[a:a + CHUNK]]).sum(axis=1).astype(np.int64)
                                for a in range(0, max(1, len(qi)), CHUNK)])
    order = np.lexsort((ids[cols[xi]], -exact, qi))
    qi, xi, exact = qi[order], xi[order], exact[order]
    best = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return query_ids[rows[qi[best]]], ids[cols[xi[best]]], exact[best]


def _ints(value: pa.Scalar, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(value.as_py(), np.int64)
    return out if width is None else out.reshape(-1, width)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of block columns, decoded."""
    for batch in batches:
        for at in range(len(batch)):
            row = {c: batch.column(c)[at] for c in batch.schema.names}
            row["query_ids"] = _ints(row["query_ids"])
            row["queries"] = np.frombuffer(row["queries"].as_py(), np.int64).reshape(len(row["query_ids"]), -1)
            if "bars" in row:
                row["bars"] = _ints(row["bars"])
            yield row


def _search_row(row: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = _ints(row["base"])
    gains = _ints(row["gains"]).reshape(len(row["segments"]) + 1, len(base))
    return search_pair(row["query_ids"], row["queries"], _ints(row["ids"]), base, row["segments"].as_py(), k, gains, row.get("bars"))


def _first_bars(k: int):
    """The block with the k-th score each query has in the joined shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pairs(batches):
            bars = np.full(len(row["query_ids"]), NO_BAR, np.int64)
            if row["ids"].is_valid:
                query, _, score = _search_row(row, k)
                order = np.argsort(row["query_ids"])
                names, first, count = np.unique(query, return_index=True, return_counts=True)
                full = count == k
                bars[order[np.searchsorted(row["query_ids"][order], names[full])]] = score[first[full] + k - 1]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([row["block"].as_py()], pa.int64()),
                "query_ids": pa.array([row["query_ids"].tobytes()], pa.binary()),
                "queries": pa.array([row["queries"].tobytes()], pa.binary()), "bars": pa.array([bars.tobytes()], pa.binary())})
    return run


def most_a_shard_holds(q: np.ndarray, base: np.ndarray, gain: np.ndarray, middle: np.ndarray, radius: float) -> np.ndarray:
    """An upper bound of every query's scores in a shard, rounding allowed for."""
    f, low = _fitted(q, len(base)).astype(np.float64), base.astype(np.float64)
    box = np.maximum(f, 0) @ (low + gain) + np.minimum(f, 0) @ low
    ball = f @ middle + np.sqrt(np.square(f).sum(axis=1)) * radius
    size = np.abs(f).sum(axis=1) * (np.abs(low).max(initial=0) + float(gain.max(initial=0)))
    return np.minimum(box, ball) + 1 + size * 1e-9


def _worth_searching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every shard summary, the queries whose bar it may reach."""
    for row in _pairs(batches):
        for shard in row["shards"].as_py():
            base = np.frombuffer(shard["base"], np.int64)
            bound = most_a_shard_holds(row["queries"], base, np.frombuffer(shard["gain"], np.int64),
                                       np.frombuffer(shard["middle"], np.float64), shard["radius"])
            on = (row["bars"] == NO_BAR) | ~(bound < row["bars"])
            if on.any():
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard["shard"]], pa.int64()), "part": pa.array([shard["part"]], pa.int32()),
                    **{c: pa.array([row[c][on].tobytes()], pa.binary()) for c in ("query_ids", "queries", "bars")}})


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pairs(batches):
            found = _search_row(row, k)
            yield pa.RecordBatch.from_pydict(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))
    return run


def fit_centres(sample: np.ndarray, n_cells: int) -> np.ndarray:
    """Centres of a few rounds of Lloyd's algorithm over the sampled rows."""
    x = sample.astype(np.float64)
    if not x.size:
        return np.zeros((1, x.shape[1]))
    centres = np.unique(x, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(n_cells, len(centres))).astype(int)]
    for _ in range(FIT_ROUNDS):
        cell = nearest(x, centres)
        size = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x = _fitted(x, centres.shape[1]).astype(np.float64)
    return np.argmin(np.square(centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _deal(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = nearest(_matrix(batch["vector"]), centres) if len(batch) else np.zeros(0, np.int64)
            yield batch.append_column("cell", pa.array(cell, pa.int32()))
    return run


def _grouped(vectors: DataFrame, parts: np.ndarray) -> DataFrame:
    """Rows with a ``group``: a cell is as many groups as ``parts`` says."""
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    at = lambda values: F.array(*[F.lit(int(v)) for v in values])[F.col("cell")]
    return vectors.select("vec_id", "vector", "cell", (
        at(first) + F.pmod(F.xxhash64("vec_id", "vector"), at(parts))).cast("long").alias("group"))


def build_index(vectors: DataFrame, parts: np.ndarray) -> DataFrame:
    """Index shards of dealt vectors (vec_id long, vector array<long>, cell int)."""
    return (_grouped(vectors, parts).repartition("group").sortWithinPartitions("group", "vec_id")
            .mapInArrow(_index_shards, "shard long, part int, ids binary, base binary, segments array<binary>, "
                                       "gains binary, middle binary, radius double"))


def query_blocks(queries: DataFrame, index: DataFrame, parts: np.ndarray, query_parts: np.ndarray, k: int) -> DataFrame:
    """Blocks of queries of one cell, with the bars their seed shard sets. The
    blocks of a cell are spread over the cell's shards."""
    first, ends = np.concatenate([[0], np.cumsum(parts)[:-1]]), np.cumsum(query_parts)
    cell = F.size(F.filter(F.array(*[F.lit(int(e)) for e in ends]), lambda e: e <= F.col("block")))
    of_cell = lambda values: F.array(*[F.lit(int(v)) for v in values])[cell]
    seed = (of_cell(first) + F.pmod("block", of_cell(parts))).cast("long")
    blocks = (_grouped(queries, query_parts).repartition("group").sortWithinPartitions("group", "vec_id")
              .mapInArrow(_query_blocks, "block long, block_part int, query_ids binary, queries binary"))
    return (blocks.withColumn("shard", seed).join(index.filter("part = 0"), "shard", "left")
            .mapInArrow(_first_bars(k), "block long, query_ids binary, queries binary, bars binary"))


def pairs_to_search(blocks: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """(shard, part) with the queries that no bound rules out there."""
    chunks = max(1, -(-n_shards // SUMMARIES))
    summaries = (index.select(
        F.pmod(F.xxhash64("shard", "part"), F.lit(chunks)).cast("long").alias("chunk"),
        F.struct("shard", "part", "base", F.substring("gains", 1, F.length("base")).alias("gain"), "middle", "radius").alias("shard"))
        .groupBy("chunk").agg(F.collect_list("shard").alias("shards")))
    met = (blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))
           .join(summaries, "chunk").select("query_ids", "queries", "bars", "shards"))
    return met.mapInArrow(_worth_searching, "shard long, part int, query_ids binary, queries binary, bars binary")


def _plan(usable: DataFrame, query_step: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows' number of shards, the centres, and the groups a cell's rows and
    queries are dealt to, by the cells' shares of the sample."""
    n_rows = usable.count()
    n_shards = max(1, -(-n_rows // SHARD_ROWS))
    sample = (usable.filter(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n_rows))) < SAMPLE_ROWS)
              .select("vector").limit(2 * SAMPLE_ROWS).toArrow())
    x = _matrix(sample["vector"]) if len(sample) else np.zeros((1, 0), np.int64)
    centres = fit_centres(x, min(CELLS, n_shards))
    share = np.bincount(nearest(x, centres), minlength=len(centres)) / len(x)
    parts = np.maximum(1, np.ceil(share * n_shards)).astype(int)
    return n_shards, centres, parts, np.maximum(1, np.ceil(share * n_rows / (query_step * BLOCK_ROWS))).astype(int)


def top_k(embeddings: DataFrame, k: int = 5, query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score of every query's k best other rows."""
    small_batches(embeddings.sparkSession)
    usable = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("vector"))
              .filter("vec_id is not null and vector is not null"))
    n_shards, centres, parts, query_parts = _plan(usable, query_step)
    dealt = "vec_id long, vector array<long>, cell int"
    index = materialize(build_index(usable.mapInArrow(_deal(centres), dealt), parts), "search-index")
    queries = (usable.filter(F.col("vec_id") % query_step == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
               .mapInArrow(_deal(centres), dealt))
    blocks = materialize(query_blocks(queries, index, parts, query_parts, k), "search-queries")
    pairs = pairs_to_search(blocks, index, n_shards).join(index, ["shard", "part"])
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle_sql(k: int = 5, query_step: int = QUERY_STEP) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {query_step} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= {k}"""
