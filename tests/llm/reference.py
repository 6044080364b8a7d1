"""Brute-force versions of the operators, on plain Python data."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, size: int) -> set:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def near_components(texts: list[str | None], size: int, percent: int = 80) -> list[int]:
    """For each row the smallest row index it is linked with."""
    sets = [shingles(t, size) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in where[s])
        for j, both in common.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in own:
            where[s].append(i)
    return [find(i) for i in range(len(texts))]


def removed_substrings(texts: list[str | None], window: int) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if starts[d[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_lines(texts: list[str | None], min_chars: int, equal_chars: int) -> list[str | None]:
    """Texts in document order without lines equal or near to an earlier one."""
    seen: list[str] = []
    out = []
    for text in texts:
        if text is None:
            out.append(None)
            continue
        kept = []
        for raw in text.split("\n"):
            line = raw.strip(" \t\n\x0b\x0c\r")
            if len(line) >= equal_chars:
                near = line in seen or len(line) >= min_chars and any(
                    len(e) >= min_chars and abs(len(line) - len(e)) <= 1 and edit_distance(line, e) <= 1 for e in seen)
                seen.append(line)
                if near:
                    continue
            kept.append(raw)
        out.append("\n".join(kept))
    return out


def best_fit(sizes: list[int], capacities: list[int], overhead: int) -> tuple[int, list[tuple[int, int]]]:
    """Total cost and (bin, offset) per item of descending sizes: every open
    bin is looked at for every item, under every limit on the opened size."""
    best = None
    for limit in capacities:
        bins, at = [], []  # [free, filled]
        for i, size in enumerate(sizes):
            fitting = [(free, b) for b, (free, _) in enumerate(bins) if free >= size]
            if fitting:
                b = min(fitting)[1]
            else:
                fits = [c for c in capacities if c >= size]
                allowed = [c for c in fits if c <= limit] or fits[:1]
                b = len(bins)
                bins.append([min(allowed, key=lambda c: ((c + overhead) / min(c, sum(sizes[i:])), c)), 0])
            at.append((b, bins[b][1]))
            bins[b][0] -= size
            bins[b][1] += size
        cost = sum(min(c for c in capacities if c >= filled) + overhead for _, filled in bins)
        if best is None or cost < best[0]:
            best = (cost, at)
    return best
