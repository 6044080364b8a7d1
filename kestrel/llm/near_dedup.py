"""MinHash near-deduplication with HyperMinHash sketches (operator 3).

Each document's distinct word shingles are hashed once. A hash's first bits
choose one of ``REGISTERS`` registers; a register keeps, of its smallest
hash, the number of leading zeros and ``MANTISSA`` bits after them.

1.  Documents with equal sets form a class, known by a 128-bit signature; one
    row per class goes on (map-side combined).
2.  The compressed registers are banded; classes that share a band are
    candidates. Every band bucket is first a star around the class with the
    most company over all its buckets, which in a family of edited copies is
    the original.
3.  Candidates pass the size bound and the collision-corrected Jaccard
    estimate (five deviations below the threshold, so that a true link passes
    but for about one in a million) and are then verified on the full sets of
    both texts.
4.  Links give components. A pair inside one component can change nothing;
    what is left are the pairs of a bucket whose classes lie in different
    components. The verification noted which of the centre's shingles a class
    has: two sets have in common at most what both have of it, and the
    smaller rest. Up to ``CHUNK`` classes outside the centre's component meet
    all members of their bucket in chunks of ``CHUNK`` classes. The classes of
    a bucket with more outside ones (a crowded bucket) meet under single
    registers instead, rarest first: a set of n shingles that reaches the
    threshold with another differs from it in a quarter of n shingles at most,
    hence in no more registers, so the first registers beyond that number
    include one that both have. Registers that stay common are dealt in pairs
    of blocks, within a set-size band or two adjacent ones (the size bound
    rules out the rest). So a group holds about two chunks, whatever a bucket
    holds; pairs that pass these exact bounds and the estimate are verified,
    once each. Then the components are final: every candidate pair was tested,
    cannot reach the threshold, or is inside a component.
    With 32 bands of 4 registers two documents at similarity 0.8 share no
    band once in 20 million. Lower thresholds take narrower bands, so that a
    link is missed less than once in a million at any of them.

Defined results
    null text, no words   empty set, n_shingles 0, linked with nothing
    few words             the whole sequence is the one shingle
    very long text        hashed whole, in pieces cut at white space
    ties, repeated rows   equal texts are one class; a repeated doc_id with
                          another text is a document of its own
    null doc_id           linked as any other; null component only if no
                          document of the component has an id
    empty table           empty result
    extra columns         kept by ``drop_near_duplicates``
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.components import components
from kestrel.llm.shingles import shingle_sets
from kestrel.llm.substring_dedup import _mixed, text_id
from kestrel.llm.textcols import small_batches
from kestrel.session import materialize

SHINGLE_WORDS = 5
MIN_PERCENT = 80
REGISTER_BITS = 7
REGISTERS = 1 << REGISTER_BITS
MANTISSA = 10
BAND = 4
MISSED = 1e-6
CHUNK = 1024
DEVIATIONS = 5.0
PAIRS = 1 << 13  # pairs whose registers are estimated at a time
SKETCH_ROWS = "doc_id long, tid binary, n long, sig binary, registers binary"


# --- sketches ---------------------------------------------------------------------

def registers_of(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of ascending distinct hashes; 0: empty."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(hashes):
        register = (hashes >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(register, prepend=-1))  # the smallest, as hashes ascend
        rest = (hashes[first] << np.uint64(REGISTER_BITS)) | np.uint64((1 << REGISTER_BITS) - 1)
        fraction, exponent = np.frexp(rest.astype(np.float64))
        zeros = np.maximum(0, 64 - exponent)
        mantissa = ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
        out[register[first]] = (zeros + 1 << MANTISSA) | mantissa
    return out


def signature(hashes: np.ndarray) -> bytes:
    """128 bits of an unordered set."""
    other = _mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return hashes.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(other).tobytes()


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig, registers = [], [], []
            for hashes in shingle_sets(batch.column("text"), size):
                n.append(len(hashes))
                sig.append(signature(hashes) if len(hashes) else None)
                registers.append(registers_of(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "tid": batch.column("tid"), "n": pa.array(n, pa.int64()), "sig": pa.array(sig, pa.binary()),
                "registers": pa.array(registers, pa.binary())})
    return run


def sketches(docs: DataFrame, size: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id(F.col("text")).alias("tid"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(_sketch(size), SKETCH_ROWS)


def band_width(percent: int) -> int:
    """Registers a band: the widest, up to ``BAND``, at which two sets at the
    threshold share no band less than ``MISSED`` of the time."""
    band = BAND
    while band > 1 and (1 - (percent / 100) ** band) ** (REGISTERS // band) >= MISSED:
        band //= 2
    return band


def band_keys(registers: Column, band: int = BAND) -> Column:
    """(band, hash) of each band that has a register in use."""
    width = 2 * band
    empty = F.lit(b"\0" * width)
    def key(b: int) -> Column:
        part = F.substring(registers, b * width + 1, width)
        return F.when(part != empty, F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), part).alias("bucket")))
    return F.array_compact(F.array(*[key(b) for b in range(REGISTERS // band)]))


# --- estimates --------------------------------------------------------------------

def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of registers that two disjoint sets of n and m hashes make equal
    by chance: their minima fall into one cell of leading zeros and mantissa."""
    a, b = n / REGISTERS, m / REGISTERS
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(64 - REGISTER_BITS):
        low, high = 2.0 ** -(zeros + 1), 2.0 ** -zeros
        total += low / (1 << MANTISSA) * (a * b / (a + b)) * (np.exp(-(a + b) * low) - np.exp(-(a + b) * high))
    return total


def _count(marks: np.ndarray) -> np.ndarray:
    """How many marks a row of registers has, eight at a time."""
    marks = np.ascontiguousarray(marks)
    return np.bitwise_count(marks.view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bits rows of 64-bit words share with one row."""
    return np.bitwise_count(x & y).sum(axis=1, dtype=np.int64)


def _within_size(n: np.ndarray, m: int, percent: int) -> tuple[int, int]:
    """The stretch of the ascending sizes ``n`` that a set of size ``m`` can be linked to."""
    return (int(np.searchsorted(n, -(-percent * m // 100))), int(np.searchsorted(n, 100 * m // percent, "right")))


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = MIN_PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows and its deviation
    at the threshold."""
    used = _count((x > 0) | (y > 0))
    equal = _count((x == y) & (x > 0))
    by_chance = chance_equal(n.astype(float), m.astype(float)) * REGISTERS
    share = percent / 100
    return (np.maximum(equal - by_chance, 0) / np.maximum(used, 1),
            np.sqrt(share * (1 - share) / np.maximum(used, 1)))


def _likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    value, deviation = estimate(x, y, n, m, percent)
    # The minimum on tiny sketches: two registers can be all that is left.
    return (value >= percent / 100 - DEVIATIONS * deviation) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _estimated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                number = lambda c: batch.column(c).to_numpy()
                good = _likely(_rows_of(batch.column("ra")), _rows_of(batch.column("rb")), number("na"), number("nb"), percent)
                keep = pa.array(np.flatnonzero(good))
                yield pa.RecordBatch.from_pydict({c: batch.column(c).take(keep) for c in ("a", "b")})
    return run


def _verified(size: int, percent: int):
    """Tests pairs on their full sets; keeps which of b's shingles a has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in batches:
            b, linked, bits = batch.column("b").to_pylist(), [], []
            centres = batch.column("tb")
            for k, x in enumerate(shingle_sets(batch.column("ta"), size)):
                if b[k] != held[0]:
                    held = (b[k], next(shingle_sets(centres.slice(k, 1), size)))
                has = np.isin(held[1], x, assume_unique=True)
                both = int(has.sum())
                linked.append(100 * both >= percent * (len(x) + len(has) - both))
                bits.append(np.packbits(has).tobytes())
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "linked": pa.array(linked, pa.bool_()),
                                              "bits": pa.array(bits, pa.binary())})
    return run


# --- linking ----------------------------------------------------------------------

def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the size bound and the estimate."""
    side = lambda c: classes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"),
                                    F.col("registers").alias(f"r{c}"))
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    return sized.mapInArrow(_estimated(percent), "a binary, b binary")


def _verify(candidates: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    text = lambda c: texts.select(F.col("sig").alias(c), F.col("text").alias(f"t{c}"))
    rows = candidates.join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
    return rows.mapInArrow(_verified(size, percent), "a binary, b binary, linked boolean, bits binary")


def _bit_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Each row's part of the centre's shingles as bits, and how many of its
    shingles lie outside it. Rows that were not compared with the centre have
    no known part: all of their shingles lie outside, and all bits are set.
    The bits come as 64-bit words."""
    n, centre = table["n"].to_numpy(), table["centre"][0].as_py()
    known = table["bits"].to_pylist()
    sigs = table["sig"].to_pylist()
    own = next((int(k) for k, s in zip(n, sigs) if s == centre), None)
    width = max((len(b) for b in known if b is not None), default=0 if own is None else -(-own // 8))
    bits, outside = np.full((len(n), -(-width // 8) * 8), 255, np.uint8), n.astype(np.int64)
    for k, (b, s) in enumerate(zip(known, sigs)):
        if s == centre:
            outside[k] = 0
        elif b is not None:
            bits[k] = 0
            bits[k, :len(b)] = np.frombuffer(b, np.uint8)
            outside[k] -= int(np.bitwise_count(bits[k]).sum())
    return bits.view(np.uint64), outside


def _numbered(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _in_batches(rows: Iterator[tuple[np.ndarray, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (several, one) as two index arrays of about ``PAIRS``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    many = 0
    for at, k in rows:
        if len(at):
            held.append((at, np.full(len(at), k)))
            many += len(at)
        if many >= PAIRS:  # one row more adds a chunk at most
            yield tuple(map(np.concatenate, zip(*held)))
            held, many = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _listed(sig: list[bytes], pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    out = [(max(sig[j], sig[k]), min(sig[j], sig[k])) for at, by in pairs for j, k in zip(at.tolist(), by.tolist())]
    return pa.table({"a": [a for a, _ in out], "b": [b for _, b in out]}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def _chunk_pairs(percent: int):
    """Rows of one (bucket, chunk): its members and every class outside the
    centre's component; the pairs across components that can still reach the
    threshold come out, each from the first band that it shares."""
    def run(table: pa.Table) -> pa.Table:
        other = table["outside"].to_numpy(zero_copy_only=False)
        registers, n = _rows_of(table["registers"].combine_chunks()), table["n"].to_numpy()
        mine = np.flatnonzero(~other)
        mine = mine[np.argsort(n[mine], kind="stable")]
        bits, beyond = _bit_rows(table)
        sig, component = table["sig"].to_pylist(), _numbered(table["component"])
        own_n, own_bits, own_beyond, own_component = n[mine], bits[mine], beyond[mine], component[mine]
        band = table["band"][0].as_py()
        width = band_width(percent)
        before = slice(0, band * width)

        def able():
            for k in np.flatnonzero(other):
                lo, hi = _within_size(own_n, int(n[k]), percent)
                # What two sets have in common lies in both parts of the
                # centre or outside it in both.
                most = _common(own_bits[lo:hi], bits[k]) + np.minimum(own_beyond[lo:hi], beyond[k])
                most = np.minimum(most, np.minimum(own_n[lo:hi], n[k]))
                yield mine[lo:hi][((100 + percent) * most >= percent * (own_n[lo:hi] + n[k])) & (own_component[lo:hi] != component[k])], k

        found = []
        for at, by in _in_batches(able()):
            x, y = registers[at], registers[by]
            earlier = (x[:, before] == y[:, before]).reshape(len(at), band, width).all(axis=2)
            used = (y[:, before].reshape(len(at), band, width) > 0).any(axis=2)
            keep = _likely(x, y, n[at], n[by], percent) & ~(earlier & used).any(axis=1)
            found.append((at[keep], by[keep]))
        return _listed(sig, found)
    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The registers in use as numbers of place and value."""
    for batch in batches:
        place = np.arange(REGISTERS, dtype=np.int32) << 16
        listed = [(place | row)[row > 0] for row in _rows_of(batch.column("registers")).astype(np.int32)]
        yield pa.RecordBatch.from_pydict({"sig": batch.column("sig"), "n": batch.column("n"),
                                          "used": pa.array([len(x) for x in listed], pa.int32()),
                                          "tokens": pa.array(listed, pa.list_(pa.int32()))})


def _may_differ(n: Column, used: Column, percent: int) -> Column:
    """How many of its registers a set can have that a candidate has not: one
    for each shingle that only one of both has, and no more than the estimate
    lets pass."""
    share = percent / 100
    equal = F.ceil(used * share - F.sqrt(used * (share * (1 - share))) * DEVIATIONS - 1e-6)
    return F.least(F.floor(n * (100 - percent) / percent + 1e-9), used - F.greatest(equal, F.lit(0))).cast("int")


def _block_pairs(percent: int):
    """Rows of one register and two blocks (or one): the pairs across
    components that can still reach the threshold."""
    def run(table: pa.Table) -> pa.Table:
        registers, n = _rows_of(table["registers"].combine_chunks()), table["n"].to_numpy()
        rising = np.argsort(n, kind="stable")
        table, registers, n = table.take(pa.array(rising)), registers[rising], n[rising]
        sig, component = table["sig"].to_pylist(), _numbered(table["component"])
        anchors, known = table["anchor"].to_pylist(), table["bits"].to_pylist()
        number = {c: i for i, c in enumerate(set(anchors) - {None})}
        anchor = np.array([number.get(c, -1) for c in anchors])
        bits, row_of, beyond = {}, np.zeros(len(n), np.int64), n.astype(np.int64)
        for i in number.values():
            at = np.flatnonzero(anchor == i)
            width = max(len(known[k]) for k in at)
            own = np.zeros((len(at), -(-width // 8) * 8), np.uint8)
            for r, k in enumerate(at):
                own[r, :len(known[k])] = np.frombuffer(known[k], np.uint8)
            bits[i] = own.view(np.uint64)
            row_of[at] = np.arange(len(at))
            beyond[at] -= np.bitwise_count(bits[i]).sum(axis=1, dtype=np.int64)
        first, same = table["first"].to_numpy(zero_copy_only=False), table["same"][0].as_py()
        left = np.flatnonzero(first)
        left_n, left_component, left_registers = n[left], component[left], registers[left]

        def able():
            for k in range(len(n)) if same else np.flatnonzero(~first):
                lo, hi = _within_size(left_n, int(n[k]), percent)
                hi = min(hi, int(np.searchsorted(left, k))) if same else hi
                on = lo + np.flatnonzero(left_component[lo:max(lo, hi)] != component[k])
                # Registers that differ stand for as many shingles that only one has.
                unequal = _count(left_registers[on] != registers[k])
                at = left[on[(100 + percent) * unequal <= (100 - percent) * (left_n[on] + n[k])]]
                most = np.minimum(n[at], n[k])
                if anchor[k] >= 0 and len(at):
                    alike = anchor[at] == anchor[k]
                    own, j = bits[anchor[k]], at[alike]
                    common = _common(own[row_of[j]], own[row_of[k]])
                    most[alike] = np.minimum(most[alike], common + np.minimum(beyond[j], beyond[k]))
                yield at[(100 + percent) * most >= percent * (n[at] + n[k])], k

        found = []
        for at, by in _in_batches(able()):
            keep = _likely(registers[at], registers[by], n[at], n[by], percent)
            found.append((at[keep], by[keep]))
        return _listed(sig, found)
    return run


def _crowded_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of different components among ``members`` (sig, n,
    registers, component, anchor, bits)."""
    tokens = materialize(members.select("sig", "n", "registers").mapInArrow(_tokens, "sig binary, n long, used int, tokens array<int>")
                         .select("sig", "n", "used", F.explode("tokens").alias("token")), "near-tokens")
    often = materialize(tokens.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
                        .withColumnRenamed("token", "t"), "near-often")
    ordered = (tokens.join(often, F.col("token") == F.col("t")).groupBy("sig")
               .agg(F.min("n").alias("n"), F.min("used").alias("used"), F.sort_array(F.collect_list(F.struct("often", "token"))).alias("order")))
    # Registers that no other class has come first and meet nobody.
    length = _may_differ(F.col("n"), F.col("used"), percent) + 1 - (F.col("used") - F.size("order"))
    prefix = (ordered.select("sig", "n", F.explode(F.slice("order", F.lit(1), F.greatest(length, F.lit(0)))).alias("o"))
              .select("sig", "n", F.col("o.token").alias("token"))
              .join(members.select(F.col("sig").alias("s"), "component"), F.col("sig") == F.col("s")).drop("s"))
    prefix = materialize(prefix, "near-prefix")
    homes = (prefix.groupBy("token", "component").agg(F.count("*").alias("many")).groupBy("token")
             .agg(F.sum("many").alias("total"), F.max(F.struct("many", "component")).alias("most")).filter("total > most.many")
             .select(F.col("token").alias("t"), "total", F.col("most.component").alias("main")))
    homes = materialize(homes, "near-homes")
    large = F.col("total") > CHUNK
    size_band = F.floor(F.log("n") / F.lit(float(np.log(100 / percent))) + 1e-9) if percent < 100 else F.col("n")
    placed = (prefix.join(homes, F.col("token") == F.col("t")).drop("t")
              .withColumn("cell", F.when(large, size_band).otherwise(F.lit(0)).cast("long"))
              .withColumn("home", large & (F.col("component") == F.col("main"))))
    placed = materialize(placed.select("token", "sig", "component", "cell", "home"), "near-placed")
    cells = (placed.groupBy("token", "cell", "home").agg(F.ceil(F.count("*") / F.lit(float(CHUNK))).cast("int").alias("blocks"))
             .groupBy("token").agg(F.collect_list(F.struct("cell", "home", "blocks")).alias("cells")).withColumnRenamed("token", "t"))
    cells = materialize(cells, "near-cells")
    block = lambda c, h, k: F.struct(c.alias("cell"), h.alias("home"), k.cast("int").alias("block"))
    near = F.filter("cells", lambda c: (F.abs(c["cell"] - F.col("cell")) <= 1) & ~(c["home"] & F.col("home")))
    others = F.flatten(F.transform(near, lambda c: F.transform(
        F.sequence(F.lit(0), c["blocks"] - 1), lambda k: block(c["cell"], c["home"], k))))
    mine = F.filter("cells", lambda c: (c["cell"] == F.col("cell")) & (c["home"] == F.col("home")))[0]["blocks"]
    places = (placed.join(cells, F.col("token") == F.col("t"))
              .withColumn("me", block(F.col("cell"), F.col("home"), F.pmod(F.xxhash64("sig"), mine)))
              .select("token", "sig", "me", F.explode(others).alias("other"))
              .select("token", F.col("sig").alias("s"), F.least("me", "other").alias("lo"), F.greatest("me", "other").alias("hi"),
                      (F.col("me") <= F.col("other")).alias("first"), (F.col("me") == F.col("other")).alias("same")))
    return (materialize(places, "near-places").join(members, F.col("s") == F.col("sig")).drop("s")
            .groupBy("token", "lo", "hi").applyInArrow(_block_pairs(percent), "a binary, b binary"))


def _rest(rows: DataFrame, centres: DataFrame, company: DataFrame, classes: DataFrame, labels: DataFrame, verified: DataFrame,
          percent: int) -> DataFrame:
    """Likely pairs of a bucket that lie in different components and were not
    tested yet."""
    labelled = materialize(
        classes.join(labels.withColumnRenamed("node", "x"), F.col("sig") == F.col("x"), "left")
        .select("sig", "n", "registers", F.coalesce("component", "sig").alias("component")), "near-labelled")
    # Buckets of two are whole as stars.
    open_rows = (rows.filter("size > 2").join(centres.withColumnRenamed("bucket", "k"), F.col("bucket") == F.col("k")).drop("k")
                 .join(labelled.select(F.col("sig").alias("s"), "component"), F.col("sig") == F.col("s")).drop("s"))
    open_rows = materialize(open_rows, "near-bucket-rows")
    mixed = (open_rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                             F.max(F.when(F.col("sig") == F.col("centre"), F.col("component"))).alias("home"))
             .filter("lo <> hi").select(F.col("bucket").alias("k"), "home"))
    mixed = materialize(mixed, "near-mixed")
    if mixed.isEmpty():
        return verified.limit(0).select("a", "b")
    known = verified.select(F.col("a").alias("s"), F.col("b").alias("c"), "bits")
    either = verified.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    crowded = (open_rows.filter(F.col("size") > CHUNK).join(mixed, F.col("bucket") == F.col("k"))
               .filter("component <> home").groupBy("bucket").count().filter(F.col("count") > CHUNK).select("bucket"))
    crowded = materialize(crowded, "near-crowded")
    pairs = None
    if not crowded.isEmpty():
        inside = materialize(open_rows.join(crowded, "bucket", "left_semi").select("sig").distinct(), "near-inside")
        anchors = (known.join(company.select(F.col("sig").alias("x"), "company"), F.col("c") == F.col("x"))
                   .join(inside, F.col("s") == F.col("sig"), "left_semi").groupBy("s")
                   .agg(F.max(F.struct("company", "c", "bits")).alias("best"))
                   .select("s", F.col("best.c").alias("anchor"), F.col("best.bits").alias("bits")))
        members = labelled.join(inside, "sig", "left_semi").join(anchors, F.col("sig") == F.col("s"), "left").drop("s")
        pairs = materialize(_crowded_pairs(materialize(members, "near-members"), percent).distinct(), "near-crowded-pairs")
        mixed = materialize(mixed.join(crowded, F.col("k") == F.col("bucket"), "left_anti"), "near-uncrowded")
    dealt = (open_rows.join(mixed, F.col("bucket") == F.col("k")).drop("k")
             .join(known, (F.col("sig") == F.col("s")) & (F.col("centre") == F.col("c")), "left").drop("s", "c")
             .join(labelled.select(F.col("sig").alias("s"), "n", "registers"), F.col("sig") == F.col("s")).drop("s")
             .withColumn("chunks", F.ceil(F.col("size") / F.lit(float(CHUNK))).cast("int"))
             .withColumn("outside", F.col("component") != F.col("home")))
    # One row as a member of its chunk, and for the outside ones (CHUNK at most) one per chunk.
    own = F.array(F.struct(F.pmod(F.xxhash64("sig"), F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("outside")))
    every = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(c.alias("chunk"), F.lit(True).alias("outside")))
    places = dealt.select("bucket", "band", "sig", "component", "centre", "n", "registers", "bits", F.explode(
        F.when(F.col("outside"), F.concat(own, every)).otherwise(own)).alias("at")).select("*", "at.*").drop("at")
    chunked = places.groupBy("bucket", "chunk").applyInArrow(_chunk_pairs(percent), "a binary, b binary")
    pairs = (chunked if pairs is None else chunked.unionAll(pairs)).distinct()
    return pairs.join(either, ["a", "b"], "left_anti")


def _decide(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, the text's hash, n_shingles, component_id and kept per row."""
    small_batches(docs.sparkSession)
    sketched = materialize(sketches(docs, size), "near-sketches")
    classes = materialize(
        sketched.filter("sig is not null").groupBy("sig")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tid")).alias("first"), F.min("n").alias("n"),
             F.min("registers").alias("registers"))
        .select("sig", "first.doc_id", "first.tid", "n", "registers"), "near-classes")
    buckets = classes.select("sig", F.explode(band_keys(F.col("registers"), band_width(percent))).alias("b")).select("sig", "b.*")
    met = materialize(buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
                      .withColumnRenamed("bucket", "k"), "near-buckets")
    rows = materialize(buckets.join(met, F.col("bucket") == F.col("k")).select("bucket", "band", "sig", "size"), "near-rows")
    # A bucket's centre is the class with the most company over all its bands:
    # the original of a family rather than one of its edited copies.
    company = materialize(rows.groupBy("sig").agg(F.sum("size").alias("company")), "near-company")
    centres = (rows.select("bucket", "sig").join(company.withColumnRenamed("sig", "s"), F.col("sig") == F.col("s"))
               .groupBy("bucket").agg(F.max(F.struct("company", "sig")).alias("best")))
    centres = materialize(centres.select("bucket", F.col("best.sig").alias("centre")), "near-centres")
    stars = (rows.join(centres.withColumnRenamed("bucket", "k"), F.col("bucket") == F.col("k"))
             .filter("sig <> centre").select(F.col("sig").alias("a"), F.col("centre").alias("b")).distinct())
    wanted = materialize(classes.join(company.select(F.col("sig").alias("s")), F.col("sig") == F.col("s"), "left_semi")
                         .select("sig", F.col("doc_id").alias("first"), F.col("tid").alias("first_text")), "near-wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # By the text too: a repeated or null doc_id brings other texts than the one wanted.
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("first")) & (text_id(F.col("text")) == F.col("first_text")))
    texts = materialize(texts.select("sig", "text"), "near-texts")
    if not texts.groupBy("sig").count().filter("count > 1").isEmpty():  # rows repeated with their doc_id
        texts = materialize(texts.dropDuplicates(["sig"]), "near-texts-once")
    tested = materialize(_candidates(stars, classes, percent), "near-candidates")
    verified = materialize(_verify(tested, texts, size, percent), "near-verified")
    links = verified.filter("linked").select("a", "b")
    labels = components(links)
    rest = materialize(_rest(rows, centres, company, classes, labels, verified, percent), "near-rest")
    if not rest.isEmpty():
        more = materialize(_verify(rest, texts, size, percent).filter("linked").select("a", "b"), "near-links")
        if not more.isEmpty():
            labels = components(links.unionAll(more))
    named = (classes.select("sig", F.col("doc_id").alias("first"))
             .join(labels.withColumnRenamed("node", "x"), F.col("sig") == F.col("x"), "left")
             .select("sig", "first", F.coalesce("component", "sig").alias("component")))
    named = materialize(named, "near-named")
    smallest = materialize(named.groupBy("component").agg(F.min("first").alias("component_id"))
                           .withColumnRenamed("component", "c"), "near-smallest")
    by_class = materialize(named.join(smallest, F.col("component") == F.col("c")).select(F.col("sig").alias("s"), "component_id"), "near-by-class")
    return (sketched.select("doc_id", "tid", "n", "sig").join(by_class, F.col("sig") == F.col("s"), "left")
            .select("doc_id", "tid", F.col("n").alias("n_shingles"),
                    F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return _decide(docs, size, percent).drop("tid")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """One document of each group, with all its columns. Rows repeated in
    every column become one; texts that share a doc_id are judged alone."""
    decided = materialize(_decide(docs, size, percent), "near-decided")
    gone = materialize(decided.filter("not kept").select(F.col("doc_id").alias("gone"), F.col("tid").alias("gone_text")).distinct(),
                       "near-gone")
    inner = docs.toDF(*[f"in_{k}" for k in range(len(docs.columns))])
    at = {c.lower(): f"in_{k}" for k, c in enumerate(docs.columns)}
    key = F.col(at["doc_id"]).cast("long")
    left = inner.join(gone, key.eqNullSafe(F.col("gone")) & (text_id(F.col(at["text"])) == F.col("gone_text")), "left_anti")
    again = materialize(decided.filter("kept").groupBy("doc_id").count().filter("count > 1")
                        .select(F.col("doc_id").alias("again")), "near-again")
    if not again.isEmpty():
        same = key.eqNullSafe(F.col("again"))
        left = left.join(again, same, "left_anti").unionAll(left.join(again, same, "left_semi").distinct())
    return left.toDF(*docs.columns)
