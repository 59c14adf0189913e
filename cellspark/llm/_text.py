"""Hashing of words and word shingles, vectorised over a text's bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed at a time; a longer text is cut at blanks.
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)  # a random value for each byte
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers (at least) of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with hash(data[i:j]) = (S[j] - S[i]) * base**i, modulo 2**64: equal byte
    strings have equal hashes wherever they stand."""
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[1][:len(data)], out=s[1:])
    return s


def _hash_words(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    blank = np.ones(len(b) + 2, bool)
    blank[1:-1] = _BLANK[b]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    s = prefix_sums(b)
    return mix((s[ends] - s[starts]) * powers(len(b) + 1)[0][starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """Hashes of the words of a text, lower-cased (A-Z) or as they are, in order."""
    if not text:
        return np.zeros(0, np.uint64)
    data = text.encode()
    if lower:
        data = data.translate(_LOWER)
    if len(data) <= _CHUNK:
        return _hash_words(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        out.append(_hash_words(data[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None, k: int) -> np.ndarray:
    """The set of a text's k-word shingles, as sorted hashes; a text of fewer
    words has its whole word sequence as its one shingle, one without words none."""
    w = word_hashes(text)
    n = len(w)
    if not n:
        return w
    size = min(k, n)
    x = np.full(n - size + 1, size, np.uint64) * _BASE
    for j in range(size):
        x = mix(x + w[j:n - size + 1 + j])
    return np.unique(x)


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit identity of a sorted set of hashes."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
