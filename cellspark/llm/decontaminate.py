"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised to lower-case words joined by single blanks.  A test item of
m characters may differ from a passage by e = floor(max_error * m) edits.  Cut
into e + 1 pieces, at least one piece must then occur in the passage unchanged:
an Aho-Corasick automaton over all pieces finds these hits in one scan of a text,
and the neighbourhood of each hit is verified with Myers' bit-parallel edit
distance of the whole item against any substring.

The items are a stated query set: their total size is measured first, and they are
handled in blocks of at most BLOCK_CHARS characters, each broadcast in turn, so
any number of items can be run against any number of texts.

Defined results: a null or empty text or item matches nothing; an item of fewer
than ``min_chars`` normalised characters matches only as it is, as whole words; items
with equal texts each match; an empty table gives no matches; the match column
replaces a column of its name and every other column passes through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of items in one broadcast block.
BLOCK_CHARS = 4 << 20
_WORDS = re.compile(r"\w+")
_MATCH = pa.struct([("item_id", pa.int64()), ("errors", pa.int32()), ("stop", pa.int32())])


def normalise(text: str | None) -> str:
    return " ".join(_WORDS.findall(text.lower())) if text else ""


def pieces(m: int, e: int) -> list[tuple[int, int]]:
    """e + 1 pieces (start, stop) of a string of m characters, as even as can be."""
    cuts = [m * i // (e + 1) for i in range(e + 2)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def masks(pattern: str) -> dict[str, int]:
    """For each character, the bits of its places in the pattern."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(places: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int] | None:
    """(errors, end) of the substring of ``text`` with the smallest edit distance to
    a pattern of m characters, the first of equals; None above ``limit``.  A column
    of the distance table is kept as two bit vectors of its vertical steps."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        right_up = down | ~(h | up) & full
        right_down = up & h
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = right_up << 1 & full
        up = (right_down << 1 | ~(x | right_up)) & full
        down = right_up & x
        if score <= limit and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Items:
    """A block of items ready to be searched for."""

    def __init__(self, rows: list[tuple[int | None, str]], max_error: float, min_chars: int = 0) -> None:
        import ahocorasick

        self.items, starts, self.short = [], {}, set()
        for item_id, text in rows:
            m = len(text)
            e = int(max_error * m) if m >= min_chars else 0
            if m < min_chars:
                self.short.add(len(self.items))
            self.items.append((item_id, m, e, masks(text)))
            for a, b in pieces(m, e):
                starts.setdefault(text[a:b], []).append((len(self.items) - 1, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in starts.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item_id, errors, end in the normalised text), the best match of each item."""
        near: dict[int, list[tuple[int, int]]] = {}
        whole: dict[int, int] = {}  # short items, and the end of their first place
        for end, (size, where) in self.automaton.iter(text):
            for k, a in where:
                _, m, e, _ = self.items[k]
                if k in self.short:
                    lo = end + 1 - size
                    if k not in whole and (lo == 0 or text[lo - 1] == " ") and (end + 1 == len(text) or text[end + 1] == " "):
                        whole[k] = end + 1
                    continue
                lo = end + 1 - size - a - e
                hi = lo + m + 2 * e
                spans = near.setdefault(k, [])
                if spans and lo <= spans[-1][1]:
                    spans[-1] = (min(lo, spans[-1][0]), max(hi, spans[-1][1]))
                else:
                    spans.append((lo, hi))
        out = [(self.items[k][0], 0, end) for k, end in whole.items()]
        for k, spans in near.items():
            item_id, m, e, places = self.items[k]
            found = []
            for lo, hi in spans:
                lo = max(lo, 0)
                if (b := best_match(places, m, text[lo:hi], e)) is not None:
                    found.append((b[0], b[1] + lo))
            if found:
                out.append((item_id, *min(found)))
        return out


def with_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 max_error: float = 0.06, min_chars: int = 30, out_col: str = "matches") -> DataFrame:
    """``docs`` with ``out_col``: array of (item_id, errors, stop) of the items that
    occur in the text with at most max_error of their length in edits.  Items of fewer
    than ``min_chars`` normalised characters must occur as they are, as whole words."""
    spark = docs.sparkSession

    @F.arrow_udf("string")
    def plain(texts: pa.Array) -> pa.Array:
        return pa.array([normalise(t.as_py()) for t in texts], pa.string())

    items = items.select(F.col(item_col).cast("long").alias("item_id"), plain(F.col(item_text).cast("string")).alias("text"))
    items = items.where(F.length("text") > 0)
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_CHARS)
    found = F.array().cast("array<struct<item_id:bigint,errors:int,stop:int>>")
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = spark.sparkContext.broadcast([tuple(r) for r in rows])
        found = F.concat(found, _searcher(block, max_error, min_chars)(F.col(text_col).cast("string")))
    return docs.withColumn(out_col, found)


def _searcher(block, max_error: float, min_chars: int):
    @F.arrow_udf("array<struct<item_id:bigint,errors:int,stop:int>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(block.value, max_error, min_chars)
        for texts in batches:
            yield pa.array([[{"item_id": i, "errors": e, "stop": s} for i, e, s in items.search(normalise(t.as_py()))] for t in texts],
                           pa.list_(_MATCH))

    return search
