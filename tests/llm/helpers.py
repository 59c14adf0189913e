"""Brute-force versions of the training-data operators."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if 0 < len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def components(rows, k, num, den):
    """{row: (set size, smallest id of its component)} by comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                top[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(sets[i]), low.get(root(i), d)) for i, (d, _) in enumerate(rows)]


def without_repeats(rows, size):
    """(id, n_bytes, n_removed, n_spans, kept bytes) by counting all windows."""
    count = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i:i + size] for i in range(len(b) - size + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance(pattern, text):
    """Smallest edit distance of the pattern to a substring of the text."""
    last = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(last[j - 1] + (c != x), last[j] + 1, now[-1] + 1))
        last = now
    return min(last)


def base_counts(text):
    w = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    times = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = set()
    for i in range(len(w) - 7):
        if times[tuple(w[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)
