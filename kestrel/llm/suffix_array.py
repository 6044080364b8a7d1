"""Two-stage suffix sorting of one block of byte strings, with numpy.

Only suffixes that are smaller than their successor are sorted directly; all
others follow by scanning the buckets of first bytes in order (a suffix that
is larger than its successor is placed when the successor is met). Adjacent
suffixes are then compared for their common prefixes.

A helper of the suffix-array deduplication: Spark deals the strings into
blocks, a task sorts one block at a time.
"""

from __future__ import annotations

import numpy as np

INDEX_BITS = 20
MOST = 1 << INDEX_BITS  # positions a block may have
CODE_BITS, CODES = 10, 6  # six (byte, kind) codes to a 60-bit word


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings with a smallest separator after each: symbols (byte + 1,
    separator 0), the plain bytes (separator 0) and the strings' starts."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    plain = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
    symbols = plain.astype(np.uint16) + np.uint16(1)
    symbols[starts + lengths] = 0
    return symbols, plain, starts


def smaller_than_successor(symbols: np.ndarray) -> np.ndarray:
    """For each suffix, is it smaller than the next one? (The last counts as so.)"""
    n = len(symbols)
    step = np.ones(n, np.int8)
    step[:-1] = np.sign(np.diff(symbols.astype(np.int32)))
    at = np.where(step != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[nearest] > 0


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    new = np.ones(len(keys), np.int64)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


def _sort_directly(symbols: np.ndarray, smaller: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the smaller suffixes in the order of (at least) their
    first ``depth`` symbols.

    A smaller suffix is the chain of its stretches from one smaller suffix to
    the next. Stretches are named in order (a kind bit makes no stretch a
    prefix of another), then names are doubled."""
    at = np.flatnonzero(smaller)
    ends = np.append(at[1:], at[-1] + 1)
    lengths = ends - at + 1
    codes = np.zeros(len(symbols) + CODES + 1, np.int64)
    codes[:len(symbols)] = symbols.astype(np.int64) * 2 + smaller + 1
    names = np.zeros(len(at), np.int64)
    for word in range(-(-int(lengths.max()) // CODES)):
        open_ = np.flatnonzero(lengths > word * CODES)
        packed = np.zeros(len(open_), np.int64)
        for k in range(word * CODES, (word + 1) * CODES):
            inside = k < lengths[open_]
            packed = (packed << CODE_BITS) | np.where(inside, codes[np.minimum(at[open_] + k, len(symbols))], 0)
        if word == 0:
            names[open_] = _dense(packed)
        else:
            # Only equal names so far can differ here; spread them in place.
            full = np.zeros(len(at), np.int64)
            full[open_] = _dense(packed)
            names = _dense(names * (int(full.max()) + 1) + full)
    covered, m = 1, len(at)
    index = np.arange(m, dtype=np.int64)
    low = np.int64(MOST - 1)
    while covered < depth and int(names.max()) < m:
        ahead = np.zeros(m, np.int64)
        ahead[:m - covered] = names[covered:] if covered < m else 0
        # The key carries its own index, so a plain sort orders both.
        keys = np.sort((names << (2 * INDEX_BITS)) | (ahead << INDEX_BITS) | index)
        order = keys & low
        new = np.ones(m, np.int64)
        new[1:] = (keys[1:] >> INDEX_BITS) != (keys[:-1] >> INDEX_BITS)
        names = np.empty(m, np.int64)
        names[order] = np.cumsum(new)
        covered *= 2
    return at[np.sort((names << INDEX_BITS) | index) & low]


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of (at least) their first ``depth`` symbols.
    At most ``MOST`` - 1 symbols, the last one 0."""
    if len(symbols) >= MOST:
        raise ValueError("block too large")
    smaller = smaller_than_successor(symbols)
    direct = _sort_directly(symbols, smaller, depth)
    first = symbols[direct]
    bounds = np.searchsorted(first, np.arange(int(symbols.max()) + 2))
    pending: list[list[np.ndarray]] = [[] for _ in range(int(symbols.max()) + 1)]
    out = []
    for c in range(len(pending)):
        layers = [np.concatenate(pending[c])] if pending[c] else []
        while layers and len(layers[-1]):
            before = layers[-1] - 1
            layers.append(before[(before >= 0) & (symbols[before] == c)])
        bucket = np.concatenate([*layers, direct[bounds[c]:bounds[c + 1]]])
        pending[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        symbol = symbols[before]
        larger = symbol > c
        before, symbol = before[larger], symbol[larger]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        for piece in np.split(before, np.flatnonzero(np.diff(symbol)) + 1):
            if len(piece):
                pending[symbols[piece[0]]].append(piece)
    return np.concatenate(out)


def common_prefixes(plain: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most``, of each pair of positions
    that both have ``most`` bytes left (``most`` at least 8)."""
    words = np.ndarray((len(plain) - 7,), "<u8", buffer=plain, strides=(1,))
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for at in [*range(0, most - 7, 8), most - 8]:
        x, y = words[a[open_] + at], words[b[open_] + at]
        same = x == y
        ended = open_[~same]
        if len(ended):
            different = (x ^ y)[~same]
            lowest = different & (~different + np.uint64(1))
            out[ended] = at + (np.log2(lowest.astype(np.float64)).astype(np.int64) >> 3)
        open_ = open_[same]
        if not len(open_):
            break
    out[open_] = most
    return out
