"""Distinct word-shingle hashes of whole texts, with numpy.

A-Z are lower-cased, words are runs of bytes other than x20 and x09-x0D. A
word is hashed by differences of running polynomial sums (one pass over the
bytes of many texts at once), a shingle by its words' hashes in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kestrel.llm.substring_dedup import _mixed, _Powers, _text_bytes

PIECE = 1 << 20
ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; texts begin at ``begins``."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    first[begins[begins < len(data)]] = inside[begins[begins < len(data)]]
    last = inside.copy()
    last[:-1] &= space[1:]
    ends_before = begins[(begins > 0) & (begins <= len(data))] - 1
    last[ends_before] = inside[ends_before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lowered = (data + np.uint8(32) * ((data >= 65) & (data <= 90))).astype(np.uint64)
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lowered + np.uint64(1)) * up[:-1], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text beyond a piece, cut at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):
            part = data[end:end + 4096]
            space = np.flatnonzero((part == 32) | ((part >= 9) & (part <= 13)))
            if len(space):
                end += int(space[0])
                break
            end = min(len(data), end + 4096)
        out.append(_words(data[at:end], np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row; all words as one if fewer."""
    n = len(words)
    if n == 0:
        return words
    span = min(n, size)
    total = np.full(n - span + 1, np.uint64(span))
    for k in range(span):
        total = _mixed(total * ORDER[k] + words[k:n - span + 1 + k])
    return total


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the ascending distinct hashes of its shingles."""
    if not 0 < size <= len(ORDER):
        raise ValueError(f"shingles of 1 to {len(ORDER)} words")
    data, ends = _text_bytes(texts.cast(pa.binary()))
    begins = np.append(0, ends[:-1]).astype(np.int64)
    k = 0
    while k < len(ends):
        upto = max(k + 1, int(np.searchsorted(ends, begins[k] + PIECE, side="right")))
        if ends[k] - begins[k] > PIECE:
            yield np.unique(_shingles(_long_text(data[begins[k]:ends[k]]), size))
            k += 1
            continue
        own = begins[k:upto] - begins[k]
        words, at = _words(data[begins[k]:ends[upto - 1]], own)
        cuts = np.append(np.searchsorted(at, own), len(words))
        # Every window of the piece at once; those across texts are not used.
        across = _shingles(words, size) if len(words) >= size else np.zeros(0, np.uint64)
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            yield np.unique(across[a:b - size + 1] if b - a >= size else _shingles(words[a:b], size))
        k = upto
