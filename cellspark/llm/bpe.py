"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

A text is cut into pieces by the vocabulary's split pattern; merges never cross
a piece.  For every prefix of a piece the *last token* of its BPE encoding is
unique, so one number per prefix describes the encodings of all prefixes:

* an automaton over the vocabulary's byte strings reports, at each end position,
  every token that is a suffix of the prefix, longest first;
* token t may end a prefix if it is pair-compatible with the last token of what
  precedes it, that is, if BPE of the two tokens' joined bytes is these two;
* the first such token is stored, and following the back-pointers from the whole
  piece gives exactly the ids that the merge loop would give, in time linear in
  the piece's length (a piece of a million letters is no special case).

A batch of texts is encoded together: equal pieces once, and all different pieces
side by side, one byte position after the other (the automaton's transitions and
the pair tests are array operations).

Defined results: a null text encodes as an empty array, as does an empty text;
null ids decode as an empty text.  An output column that exists is replaced;
every other column passes through, whatever its name.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text encoded at a time, and bytes from which a piece is handled alone.
BATCH_CHARS, LONG_PIECE = 6 << 20, 256
#: Slots of the table of known token pairs.
_SLOTS = 1 << 20

#: White space of the split pattern (Unicode White_Space; fixed by the format).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split pattern (fixed by the format).
_PIECE = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|["
          + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+")

#: A blank that may not begin a piece: white space or the end follows.
_LOOSE = (r" (?:[\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in vocabulary files:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _EdgeTable:
    """Whole numbers to whole numbers above 0, in two arrays: a key is in one of two
    slots, so looking up an array of keys takes two steps."""

    def __init__(self, items: dict[int, int]) -> None:
        self.bits = max(4, (4 * len(items)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int32)
        self.value = np.zeros(1 << self.bits, np.int32)
        keys = np.array(list(items), np.int64)
        one, two = (dict(zip(keys.tolist(), s.tolist(), strict=True)) for s in self._slots(keys))
        held: dict[int, int] = {}  # slot to key
        for k in items:
            slot = one[k]
            while slot in held:  # the key there moves to its other slot
                held[slot], k = k, held[slot]
                slot = two[k] if slot == one[k] else one[k]
            held[slot] = k
        for slot, k in held.items():
            self.key[slot], self.value[slot] = k, items[k]

    def _slots(self, key):
        mask = (1 << self.bits) - 1
        return (key * 0x9E3779B1 >> 15) & mask, (key * 0x85EBCA77 >> 17) & mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, 0 for unknown keys."""
        one, two = self._slots(keys)
        out = self.value[one]
        rest = np.flatnonzero(self.key[one] != keys)
        slot = two[rest]
        out[rest] = np.where(self.key[slot] == keys[rest], self.value[slot], 0)
        return out

    def get_one(self, key: int) -> int:
        for slot in self._slots(key):
            if self.key[slot] == key:
                return int(self.value[slot])
        return 0


class PrefixCoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_alphabet()
        raw = {t: bytes(byte_of[c] for c in t) for t in spec["model"]["vocab"]}
        ids = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in ids.items():
            self.bytes_of[i] = raw[t]
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.size_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.id_of = {raw[t].decode("latin-1"): i for t, i in ids.items()}
        # rank of a merge, and the two parts that each merged token comes from first
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair, whole = (ids[a], ids[b]), ids[a + b]
            self.rank.setdefault(pair, r)
            self.parts.setdefault(whole, (r, *pair))
        self.find = regex.compile(_PIECE).findall
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in self.added) + ")").split if self.added else None
        self.lookup = pa.array(self.bytes_of, pa.large_binary())
        self._build_automaton()
        self.slot_key = np.full(_SLOTS, -1, np.int64)
        self.slot_ok = np.zeros(_SLOTS, bool)

    def _build_automaton(self) -> None:
        """Automaton of all tokens' suffixes: for each state, the next state by byte
        and the state of the longest token that ends there."""
        children: list[dict[int, int]] = [{}]
        token, depth = [-1], [0]
        for text, i in self.id_of.items():
            at = 0
            for b in text.encode("latin-1"):
                to = children[at].get(b)
                if to is None:
                    to = children[at][b] = len(children)
                    children.append({})
                    token.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            token[at] = i
        shorter = [0] * len(children)  # state of the longest proper suffix
        ends = [0] * len(children)     # state of the longest token that is a suffix
        queue = [0]
        for at in queue:
            if at:
                ends[at] = at if token[at] >= 0 else ends[shorter[at]]
            for b, to in children[at].items():
                back = shorter[at]
                while at and back and b not in children[back]:
                    back = shorter[back]
                shorter[to] = children[back].get(b, 0) if at else 0
                queue.append(to)
        # whole rows of next states for the states of up to two bytes, edges for all others
        near = [at for at in queue if depth[at] <= 2]
        self.row = np.full(len(children), -1, np.int32)
        self.row[near] = np.arange(len(near))
        rows = np.zeros((len(near), 256), np.int32)
        for r, at in enumerate(near):
            if at:
                rows[r] = rows[self.row[shorter[at]]]
            rows[r, list(children[at])] = list(children[at].values())
        self.near = rows.ravel()
        self.edges = _EdgeTable({at << 8 | b: to for at, kids in enumerate(children) if depth[at] > 2 for b, to in kids.items()})
        self.shorter = np.array(shorter, np.int32)
        self.token, self.depth = np.array(token, np.int32), np.array(depth, np.int32)
        self.ends = np.array(ends, np.int32)
        self.next_end = self.ends[np.array(shorter)]

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The automaton's next states: by an edge of the state or of its longest
        suffix that has one for the byte."""
        row = self.row[state]
        out = self.near[np.maximum(row, 0) << 8 | byte]
        todo = np.flatnonzero(row < 0)
        at, byte = state[todo], byte[todo]
        while len(todo):
            to = self.edges.get(at.astype(np.int64) << 8 | byte)
            at = self.shorter[at]
            row = self.row[at]
            found = to > 0
            stop = ~found & (row >= 0)
            to[stop] = self.near[row[stop] << 8 | byte[stop]]
            found |= stop
            out[todo[found]] = to[found]
            more = ~found
            todo, at, byte = todo[more], at[more], byte[more]
        return out

    def _pairs_ok(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """compatible() of arrays of tokens."""
        key = a << 20 | b
        slot = (key * np.int64(0x1E3779B97F4A7C15) & np.int64(0x7FFFFFFFFFFFFFFF)) >> 43
        ok = self.slot_ok[slot]
        unknown = np.flatnonzero(self.slot_key[slot] != key)
        if len(unknown):
            new, where = np.unique(key[unknown], return_inverse=True)
            answer = np.array([self.compatible(k >> 20, k & 0xFFFFF) for k in new.tolist()], bool)
            ok[unknown] = answer[where]
            self.slot_key[slot[unknown]] = key[unknown]
            self.slot_ok[slot[unknown]] = ok[unknown]
            # two keys of one slot: whichever was written last must own its answer
            self.slot_ok[slot[unknown]] = answer[np.searchsorted(new, self.slot_key[slot[unknown]])]
        return ok

    def pieces(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces: all ids one after the other, and n + 1 offsets."""
        size = np.array([len(d) for d in data], np.int64)
        by = np.argsort(-size, kind="stable")
        counts = np.zeros(len(data), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (piece and place from its end, id)
        n_long = int((size >= LONG_PIECE).sum())
        for k in by[:n_long].tolist():
            ids = self._long(data[k])
            counts[k] = len(ids)
            done.append((np.stack([np.full(len(ids), k), np.arange(len(ids))[::-1]]), np.array(ids, np.int64)))
        lo = n_long
        while lo < len(data) and size[by[lo]]:
            width = int(size[by[lo]])
            rows = by[lo:lo + max(1, (4 << 20) // (width + 1))]
            rows = rows[size[rows] > 0]
            lo += len(rows)
            n = size[rows]
            flat = np.frombuffer(b"".join([data[r] for r in rows.tolist()]), np.uint8)
            start = np.cumsum(n) - n
            last = np.zeros((width + 1, len(rows)), np.int64)
            state = np.zeros(len(rows), np.int32)
            alive = len(rows)
            for t in range(width):
                while n[alive - 1] <= t:
                    alive -= 1
                state = self._step(state[:alive], flat[start[:alive] + t])
                end = self.ends[state]
                todo = np.arange(alive)
                while len(todo):
                    tok, back = self.token[end].astype(np.int64), t + 1 - self.depth[end]
                    ok = back == 0
                    some = np.flatnonzero(~ok)
                    if len(some):
                        ok[some] = self._pairs_ok(last[back[some], todo[some]], tok[some])
                    last[t + 1, todo[ok]] = tok[ok]
                    todo, end = todo[~ok], self.next_end[end[~ok]]
            at, todo, place = n.copy(), np.arange(len(rows)), 0
            while len(todo):
                tok = last[at[todo], todo]
                done.append((np.stack([rows[todo], np.full(len(todo), place)]), tok))
                at[todo] -= self.size_of[tok]
                counts[rows[todo]] += 1
                todo, place = todo[at[todo] > 0], place + 1
        offsets = np.zeros(len(data) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        ids = np.zeros(offsets[-1], np.int64)
        for (k, from_end), tok in done:
            ids[offsets[k + 1] - 1 - from_end] = tok
        return ids, offsets

    def _long(self, data: bytes) -> list[int]:
        """Ids of one long piece."""
        ends, next_end, token, depth = self.ends, self.next_end, self.token, self.depth
        edge, shorter, row, near = self.edges.get_one, self.shorter, self.row, self.near
        last, state = [-1], 0
        for t, b in enumerate(data):
            to = 0
            while row[state] < 0 and not (to := edge(state << 8 | b)):
                state = int(shorter[state])
            state = to or int(near[int(row[state]) << 8 | b])
            end = int(ends[state])
            while True:
                tok, back = int(token[end]), t + 1 - int(depth[end])
                if back == 0 or self.compatible(last[back], tok):
                    break
                end = int(next_end[end])
            last.append(tok)
        out, n = [], len(data)
        while n:
            out.append(last[n])
            n -= len(self.bytes_of[last[n]])
        return out[::-1]

    @lru_cache(maxsize=1 << 17)  # noqa: B019  one coder lives as long as its worker
    def compatible(self, a: int, b: int) -> bool:
        """BPE of the joined bytes of tokens a and b is [a, b].

        Undo merges on both sides of the border, latest first: at each state, a
        merge across the border with an earlier rank than the last undone merge
        would have come before it, and the tokens would not both appear."""
        parts, rank = self.parts, self.rank
        until, on_right = 1 << 60, False  # the last undone merge: its rank, its side
        while True:
            r = rank.get((a, b))
            if r is not None and (r < until or r == until and on_right):
                return False
            ra, rb = parts.get(a, (-1,))[0], parts.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            on_right = rb >= ra  # equal ranks merge from left to right
            if on_right:
                until, b = rb, parts[b][1]
            else:
                until, a = ra, parts[a][2]

    def encode_batch(self, texts: pa.Array, added: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts: all ids one after the other, and n + 1 offsets.
        added=False takes the added tokens' strings as ordinary text."""
        texts = pc.fill_null(texts, "")
        # a blank before a non-blank always begins a piece: where all blanks do,
        # the text is cut at them, and equal runs of pieces are looked at once
        loose = pc.match_substring_regex(texts, _LOOSE)
        for t in self.added if added else ():
            loose = pc.or_(loose, pc.match_substring(texts, t))
        split = pc.split_pattern(pc.if_else(loose, "", texts), " ")
        if isinstance(split, pa.ChunkedArray):
            split = split.combine_chunks()
        at = split.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        runs = split.flatten().dictionary_encode()
        unit = runs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        runs = runs.dictionary.to_pylist()
        unit[at[:-1]] = len(runs) + np.arange(len(texts))  # the first run has no blank before it

        index: dict = {}
        sizes, order = [], []
        for run in runs:
            if run.isalpha():
                sizes.append(1)
                order.append(index.setdefault(" " + run, len(index)))
                continue
            if run[:-1].isalpha() and run[-1] in ".,":
                sizes.append(2)
                order += index.setdefault(" " + run[:-1], len(index)), index.setdefault(run[-1], len(index))
                continue
            found = self.find(" " + run)
            sizes.append(len(found))
            for p in found:
                order.append(index.setdefault(p, len(index)))
        heads = split.flatten().take(pa.array(at[:-1])).to_pylist()
        for k in np.flatnonzero(loose.to_numpy(zero_copy_only=False)).tolist():
            heads[k] = None
        for k, head in enumerate(heads):
            if head is not None:
                found = self.find(head)
            else:
                found = []
                text = texts[k].as_py()
                for i, part in enumerate(self.split(text) if added and self.split else (text,)):
                    found += [(part,)] if i & 1 else self.find(part)
            sizes.append(len(found))
            for p in found:
                order.append(index.setdefault(p, len(index)))
        special = {i: self.added[p[0]] for p, i in index.items() if isinstance(p, tuple)}
        ids, ends = self.pieces([b"\0" if isinstance(p, tuple) else p.encode() for p in index])
        for i, token in special.items():
            ids[ends[i]:ends[i + 1]] = token
        by_unit, unit_ends = _gathered(ids, ends, np.array(order, np.int64), np.array(sizes, np.int64))
        return _gathered(by_unit, unit_ends, unit, np.diff(at))

    def encode_all(self, texts: list[str], added: bool = True) -> list[list[int]]:
        if not texts:
            return []
        ids, ends = self.encode_batch(pa.array(texts, pa.string()), added)
        return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, text: str, added: bool = True) -> list[int]:
        return self.encode_all([text], added)[0]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _gathered(flat: np.ndarray, ends: np.ndarray, pick: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked slices of a ragged array one after the other, and the offsets of
    groups of sizes[i] slices each."""
    n = (ends[1:] - ends[:-1])[pick]
    stop = np.cumsum(n)
    total = int(stop[-1]) if len(stop) else 0
    out = flat[np.arange(total) + np.repeat(ends[:-1][pick] - (stop - n), n)]
    offsets = np.zeros(len(sizes) + 1, np.int64)
    offsets[1:] = np.concatenate([[0], stop])[np.cumsum(sizes)]
    return out, offsets


def _parts(texts: pa.Array):
    """Slices of a column of about BATCH_CHARS characters each."""
    size = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + BATCH_CHARS))
        hi = min(max(hi, lo + 1), len(texts))
        yield texts.slice(lo, hi - lo)
        lo = hi


@lru_cache(maxsize=2)
def coder(path: str) -> PrefixCoder:
    """One coder per worker process and file."""
    return PrefixCoder(path)


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with ``out_col`` array<int>: the ids of ``text_col``.  ``path`` is
    the vocabulary file, which every executor must have."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        c = coder(path)
        flat, offsets = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for part in _parts(texts):
            ids, ends = c.encode_batch(part)
            flat.append(ids.astype(np.int32))
            offsets.append(offsets[-1][-1] + ends[1:])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(np.concatenate(flat)))

    return df.withColumn(out_col, ids_of(F.col(text_col).cast("string")))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` string: the text of the ids; bytes that are no
    UTF-8 become U+FFFD, special tokens their own text."""

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        c = coder(path)
        out = []
        for row in ids:
            flat = row.values  # the ids of one row
            if flat is None or not len(flat):
                out.append("")
                continue
            joined = c.lookup.take(flat)
            at = np.frombuffer(joined.buffers()[1], np.int64)
            out.append(joined.buffers()[2].to_pybytes()[at[joined.offset]:at[joined.offset + len(joined)]].decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return df.withColumn(out_col, text_of(F.col(ids_col)))
