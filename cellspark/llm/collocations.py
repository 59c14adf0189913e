"""Phrase collocations by direct-address tiling of frequency-ranked ids.

1. *Blocks.*  Texts are tokenised once: a block is a row of a few hundred thousand
   word occurrences of one language, as places in the block's own list of different
   words, with a break between pieces.  A piece that goes on in the next block is
   continued by an overlap of max_words - 1 words, of which only the first block owns
   the phrases that start before it.
2. *Ranks.*  Words of at least ``min_count`` occurrences get their rank by frequency as
   id.  All other words become breaks: no frequent phrase holds them.
3. *Tiles.*  Neighbouring ids are pairs; the plane of pairs is cut into tiles of
   TILE x TILE ids.  As ids are frequency ranks, most pairs fall into few tiles near
   the origin, which are counted by ``bincount`` into a dense table; the pairs of all
   other tiles are sorted and run-length counted.  Stripes of some tiles are the shuffle's
   rows, so counts travel as a few bytes per cell; a stripe's counts are summed in a dense
   table where it is full, and by sorting where it is not.  What one task sends of a
   stripe is bounded by its cells, however hot it is.
4. *Recursion.*  Frequent pairs are ranked by frequency again, and the blocks are
   rewritten with these ids: place i holds the id of the phrase that starts there.
   Two neighbouring phrases of n words overlap in n - 1, so the pair of their ids is
   a phrase of n + 1 words, and counting goes on with the same step.  A phrase is
   counted only if both its parts are frequent, which loses nothing.
5. *Scores.*  Each phrase carries the counts of all its beginnings and ends, from those of its
   two parts, so every cut is scored without searching for the parts; the arithmetic is in
   decimals of 38 digits.

Ids are looked up in tables: those of at most HEAD words or PAIRS * HEAD pairs are sent to the tasks,
larger ones are joined with the blocks' distinct words or pairs, with the same result: what is
found follows its block in sorted order, and a task holds one block's ids at a time.
Codes are written as bytes, and in row groups of a few blocks, so that readers hold few of them.

Defined results: a null text is empty; a null language is ``und``; repeated rows count
as often as they occur; a phrase is text, so one that occurs in two languages is a row in
each; ties in rank are broken by count and phrase; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows, running
from ._shared import materialize, tidy

#: Word occurrences of a block, ids of a tile's side, and bytes tokenised at a time.
BLOCK, TILE, _CHUNK = 1 << 18, 512, 1 << 20
#: Cells of a stripe: neighbouring tiles, which are shuffled and summed together.
STRIPE = 1 << 22
#: Words, their bytes, and pairs (16 bytes each) per word up to which a table of ids is sent to the tasks.
HEAD, HEAD_BYTES, PAIRS = 1 << 17, 16 << 20, 8
#: Bytes of a row group of blocks.
GROUP_BYTES = 8 << 20
BREAK = -1

_TABLE = bytes(0x0A if c in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if c == 0x09 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str) -> Iterator[list[bytes]]:
    """The words of a text in runs of bounded size; b"\\n" stands between pieces."""
    data = text.encode().translate(_TABLE)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > _CHUNK:
            cuts = [x for x in (data.find(b" ", at + _CHUNK), data.find(b"\n", at + _CHUNK)) if x >= 0]
            end = min(cuts, default=len(data))
        yield [w for w in data[at:end].replace(b"\n", b" \n ").split(b" ") if w]
        at = end


def _bytes(codes: np.ndarray) -> bytes:
    """Codes as bytes; the first one tells the width of the others."""
    width = 4 if not len(codes) or codes.max() < 1 << 31 else 8
    return bytes([width]) + codes.astype(f"i{width}").tobytes()


def _codes(data: pa.Scalar) -> np.ndarray:
    raw = data.as_buffer()
    return np.frombuffer(raw, f"i{raw[0]}", offset=1).astype(np.int64)


class _Builder:
    """Word occurrences of one language on their way into blocks."""

    def __init__(self, overlap: int) -> None:
        self.overlap, self.places, self.codes = overlap, {}, []

    def add(self, run: list[bytes]) -> None:
        places = self.places
        self.codes.extend([BREAK if w == b"\n" else places.setdefault(w, len(places)) for w in run])

    def close(self) -> None:
        """The end of a text is the end of a piece."""
        if self.codes and self.codes[-1] != BREAK:
            self.codes.append(BREAK)

    def block(self, last: bool) -> tuple[list[int], int, list[bytes], list[int]] | None:
        """(codes, owned, words, their counts among the owned) and what goes on."""
        owned = len(self.codes) if last else max(0, len(self.codes) - self.overlap)
        if not owned:
            return None
        codes, tail, names = self.codes, self.codes[owned:], list(self.places)
        counts = np.bincount(np.array(codes[:owned], np.int64) + 1, minlength=len(names) + 1)[1:]
        self.places, self.codes = {}, []
        self.add([b"\n" if c == BREAK else names[c] for c in tail])
        return codes, owned, names, counts.tolist()


def _blocks(docs: DataFrame, overlap: int) -> DataFrame:
    """(lang, owned, codes, words, counts): see the module's first step."""

    def rows(blocks):
        return pa.RecordBatch.from_arrays(
            [pa.array([b[0] for b in blocks], pa.string()), pa.array([b[1][1] for b in blocks], pa.int32()),
             pa.array([_bytes(np.array(b[1][0], np.int64)) for b in blocks], pa.binary()),
             pa.array([[w.decode("utf-8", "surrogatepass") for w in b[1][2]] for b in blocks], pa.list_(pa.string())),
             pa.array([b[1][3] for b in blocks], pa.list_(pa.int64()))], names=["lang", "owned", "codes", "words", "counts"])

    def run(batches):
        open_blocks: dict[str, _Builder] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                builder = open_blocks.get(lang)
                if builder is None:
                    builder = open_blocks[lang] = _Builder(overlap)
                for part in words(text.as_py() or ""):
                    builder.add(part)
                    if len(builder.codes) >= BLOCK and (found := builder.block(False)):
                        yield rows([(lang, found)])
                builder.close()
                if len(builder.codes) >= BLOCK and (found := builder.block(True)):
                    yield rows([(lang, found)])
            if sum(len(b.codes) for b in open_blocks.values()) > 4 * BLOCK:  # many languages at once
                for lang, builder in open_blocks.items():
                    if found := builder.block(True):
                        yield rows([(lang, found)])
                open_blocks.clear()
        for lang, builder in open_blocks.items():
            if found := builder.block(True):
                yield rows([(lang, found)])

    out = docs.mapInArrow(run, "lang string, owned int, codes binary, words array<string>, counts array<long>")
    return materialize(out.withColumn("block", F.monotonically_increasing_id()), GROUP_BYTES)


def compact(codes: np.ndarray, owned: int) -> tuple[np.ndarray, int]:
    """Without breaks that follow breaks and ids between two breaks, which form no pair."""
    live = codes >= 0
    near = live.copy()
    near[1:] |= live[:-1]
    lone = live.copy()
    lone[1:] &= ~live[:-1]
    lone[:-1] &= ~live[1:]
    # a kept break follows a kept id, so equal breaks never repeat
    keep = near & ~lone
    keep[1:] &= ~(~live[1:] & lone[:-1])
    at = np.flatnonzero(keep)
    return codes[at], int(np.searchsorted(at, owned))


def tile_counts(a: np.ndarray, b: np.ndarray, side: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Cells and their counts, in parts of ascending cells.  A cell is a pair's place when the
    plane of pairs, ``side`` tiles wide, is laid out tile by tile and row by row.  Tiles that
    many of the pairs fall into are counted in a dense table each, all others by sorting."""
    tile = (a // TILE) * side + b // TILE
    cell = tile * (TILE * TILE) + (a % TILE) * TILE + b % TILE
    cell.sort()
    if not len(cell):
        return []
    tile = cell // (TILE * TILE)
    edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
    dense = np.flatnonzero(np.diff(edges) * 8 >= TILE * TILE)
    out = []
    sparse = np.ones(len(cell), bool)
    for t in dense:
        lo, hi = edges[t], edges[t + 1]
        sparse[lo:hi] = False
        table = np.bincount(cell[lo:hi] - tile[lo] * (TILE * TILE), minlength=TILE * TILE)
        found = np.flatnonzero(table)
        out.append((tile[lo] * (TILE * TILE) + found, table[found]))
    cell = cell[sparse]
    if len(cell):
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        out.append((cell[start], np.diff(np.append(start, len(cell)))))
    return out


def _stripes(cell: np.ndarray, count: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """(stripe, steps between its cells, their counts) of ascending cells: the rows that are
    shuffled.  Steps are as narrow as the widest of them (its bytes come first).
    Without counts, each cell is written as often as it occurs, with steps of 0."""
    stripe = cell // STRIPE
    edges = np.flatnonzero(np.concatenate([[True], stripe[1:] != stripe[:-1], [True]]))
    out = []
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        place, times = cell[lo:hi] % STRIPE, count[lo:hi]
        alone = int(times.sum()) <= 2 * (hi - lo)
        if alone:
            place = np.repeat(place, times)
        step = np.diff(place, prepend=0)
        width = 1 if (top := int(step.max())) < 1 << 8 else 2 if top < 1 << 16 else 4
        out.append((int(stripe[lo]), bytes([width]) + step.astype(f"u{width}").tobytes(), b"" if alone else times.astype(np.uint32).tobytes()))
    return out


def _cells(stripe: int, steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The cells and counts of a row of ``_stripes``."""
    cell = np.cumsum(np.frombuffer(steps, f"u{steps[0]}", offset=1), dtype=np.int64) + stripe * STRIPE
    return cell, np.frombuffer(counts, np.uint32).astype(np.int64) if counts else np.ones(len(cell), np.int64)


def _summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different cells, ascending, and the sums of their counts."""
    cell, count = np.concatenate(cells), np.concatenate(counts)
    if len(cell) and cell.max() - cell.min() < 4 * len(cell):  # a dense table
        base = cell.min()
        table = np.bincount(cell - base, weights=count).astype(np.int64)  # exact below 2 ** 53
        found = np.flatnonzero(table)
        return found + base, table[found]
    order = np.argsort(cell, kind="stable")
    cell, count = cell[order], count[order]
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    return cell[start], np.add.reduceat(count, start) if len(start) else count


def _count_pairs(blocks: DataFrame, n_ids: int, min_count: int) -> DataFrame:
    """(a, b, f): pairs of neighbouring ids below ``n_ids`` with at least ``min_count``
    occurrences.  A task sends, for every stripe, one row with all it has counted."""
    held_pairs, side = 2 * BLOCK, n_ids // TILE + 1

    def count(batches):
        held, n = [], 0

        def flush():
            rows = [r for part in tile_counts(*np.concatenate(held, axis=1), side) for r in _stripes(*part)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["stripe", "steps", "counts"])

        for batch in batches:
            for owned, codes in zip(batch.column("owned").to_pylist(), batch.column("codes"), strict=True):
                x = _codes(codes)
                a, b = x[:-1][:owned], x[1:][:owned]
                both = (a >= 0) & (b >= 0)
                held.append(np.stack([a[both], b[both]]))
                n += held[-1].shape[1]
                if n >= held_pairs:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def total(batches):
        """Stripes come in order: all but the last are complete."""
        cells, counts, n, limit = [], [], 0, held_pairs

        def result(cell, count):
            keep = count >= min_count
            cell, count = cell[keep], count[keep]
            tile, place = cell // (TILE * TILE), cell % (TILE * TILE)
            return pa.RecordBatch.from_arrays([pa.array(tile // side * TILE + place // TILE), pa.array(tile % side * TILE + place % TILE),
                                               pa.array(count.astype(np.int64))], names=["a", "b", "f"])

        for batch in batches:
            for stripe, steps, number in zip(*(batch.column(c).to_pylist() for c in ("stripe", "steps", "counts")), strict=True):
                cell, count = _cells(stripe, steps, number)
                cells.append(cell)
                counts.append(count)
                n += len(cell)
                if n >= limit:
                    cell, count = _summed(cells, counts)
                    last = cell >= stripe * STRIPE
                    yield result(cell[~last], count[~last])
                    cells, counts, n = [cell[last]], [count[last]], int(last.sum())  # a stripe's cells at most
                    limit = n + held_pairs
        if cells:
            yield result(*_summed(cells, counts))

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = blocks.mapInArrow(count, "stripe long, steps binary, counts binary").repartition(n, "stripe").sortWithinPartitions("stripe")
    return materialize(stripes.mapInArrow(total, "a long, b long, f long"))


def _ranked(found: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``found`` with id, its rank by f (ties by ``order``), and the number of rows."""
    out = number_rows(found, [F.col("f").desc(), *(F.col(c) for c in order)], out_col="id")
    return out, out.count()


def _rows(out: list[tuple[int, np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
    """Blocks (number, codes, owned), without those that own nothing any more."""
    out = [(block, *compact(codes, owned)) for block, codes, owned in out]
    out = [r for r in out if r[2]]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int32()),
                                          pa.array([_bytes(r[1]) for r in out], pa.binary())], names=["block", "owned", "codes"])


def _rewrite(blocks: DataFrame, lookup) -> DataFrame:
    """Blocks (block, owned, codes) with the ids that ``lookup(row)`` gives for every place."""

    def run(batches):
        for batch in batches:
            yield from _rows([(batch.column("block")[i].as_py(), *lookup(batch, i)) for i in range(batch.num_rows)])

    return materialize(blocks.mapInArrow(run, "block long, owned int, codes binary"), GROUP_BYTES)


def _rewrite_found(blocks: DataFrame, found: DataFrame, apply) -> DataFrame:
    """Blocks with the ids that ``apply(codes, found)`` gives for every place, ``found`` being the
    block's rows of the table ``found`` (block, longs) in the order of its columns, as one matrix.  Sorted, a block comes
    before what was found for it, so a task holds one block."""
    names = [c for c in found.columns if c != "block"]
    head = blocks.select("block", *[F.lit(None).cast("long").alias(c) for c in names], "owned", "codes")
    both = head.unionByName(found.select("block", *names, F.lit(None).cast("int").alias("owned"), F.lit(None).cast("binary").alias("codes")))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, "block").sortWithinPartitions("block", *[F.col(c).asc_nulls_first() for c in names])

    def run(batches):
        block = codes = owned = None
        held = []

        def result():
            rows = np.concatenate(held, axis=1) if held else np.zeros((len(names), 0), np.int64)
            return _rows([(block, apply(codes, rows), owned)])

        for batch in batches:
            first = np.flatnonzero(batch.column("codes").is_valid().to_numpy(zero_copy_only=False)).tolist()
            edges = [*([0] if not first or first[0] else []), *first, batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if batch.column("codes")[lo].is_valid:
                    if block is not None:
                        yield from result()
                    block, owned, codes = batch.column("block")[lo].as_py(), batch.column("owned")[lo].as_py(), _codes(batch.column("codes")[lo])
                    held, lo = [], lo + 1
                if lo < hi:
                    held.append(np.stack([batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]))
        if block is not None:
            yield from result()

    return materialize(both.mapInArrow(run, "block long, owned int, codes binary"), GROUP_BYTES)


def _word_ids(blocks: DataFrame, vocabulary: DataFrame, n: int) -> DataFrame:
    """Blocks whose codes are the ranks of their words."""

    if n <= HEAD and (vocabulary.agg(F.sum(F.octet_length("word"))).first()[0] or 0) <= HEAD_BYTES:
        ranks: dict[str, dict[str, int]] = {}
        for r in vocabulary.select("lang", "word", "id").collect():
            ranks.setdefault(r["lang"], {})[r["word"]] = r["id"]
        shared = blocks.sparkSession.sparkContext.broadcast(ranks)  # HEAD entries at most

        def lookup(batch, i):
            known = shared.value.get(batch.column("lang")[i].as_py(), {})
            ids = np.array([*(known.get(w, BREAK) for w in batch.column("words")[i].as_py()), BREAK], np.int64)  # place -1 is the break
            return ids[_codes(batch.column("codes")[i])], batch.column("owned")[i].as_py()

        return _rewrite(blocks.select("block", "lang", "owned", "codes", "words"), lookup)

    place = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    found = place.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("block", F.col("place").cast("long").alias("place"), "id")

    def apply(codes, found):
        ids = np.full(int(codes.max(initial=0)) + 2, BREAK, np.int64)
        ids[found[0]] = found[1]
        ids[-1] = BREAK
        return ids[codes]

    return _rewrite_found(blocks, found, apply)


def _keys(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Ascending keys of the pairs ``a``, ``b`` (sorted): the numbers of a, so that a key fits 64 bits,
    times a step, and b.  Also the different a, and the step."""
    first, group = np.unique(a, return_inverse=True)
    step = int(b.max(initial=0)) + 1
    return group * step + b, first, step


def _pair_ids(blocks: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Blocks whose codes are the ranks of the pairs that start at each place."""

    def apply(x, key, first, step, ids):
        out = np.full(len(x), BREAK, np.int64)
        at = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0) & (x[1:] < step))
        if len(key) and len(at):
            g = np.minimum(np.searchsorted(first, x[at]), len(first) - 1)
            want = np.where(first[g] == x[at], g * step + x[at + 1], -1)
            pos = np.minimum(np.searchsorted(key, want), len(key) - 1)
            hit = key[pos] == want
            out[at[hit]] = ids[pos[hit]]
        return out

    if n <= PAIRS * HEAD:
        rows = pairs.select("a", "b", "id").toArrow()
        a, b, ids = (rows.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "id"))
        order = np.lexsort((b, a))
        shared = blocks.sparkSession.sparkContext.broadcast((*_keys(a[order], b[order]), ids[order]))  # PAIRS * HEAD entries at most

        def lookup(batch, i):
            return apply(_codes(batch.column("codes")[i]), *shared.value), batch.column("owned")[i].as_py()

        return _rewrite(blocks, lookup)

    def distinct(batches):
        for batch in batches:
            for block, codes in zip(batch.column("block").to_pylist(), batch.column("codes"), strict=True):
                x = _codes(codes)
                both = (x[:-1] >= 0) & (x[1:] >= 0)
                if both.any():
                    a, b = np.unique(np.stack([x[:-1][both], x[1:][both]]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), block)), pa.array(a), pa.array(b)], names=["block", "a", "b"])

    found = blocks.mapInArrow(distinct, "block long, a long, b long").join(pairs.select("a", "b", "id"), ["a", "b"]).select("block", "a", "b", "id")
    return _rewrite_found(blocks, found, lambda codes, rows: apply(codes, *_keys(rows[0], rows[1]), rows[2]))


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals).  phrases: lang, n_words, phrase, a (its occurrences), begins and
    ends (the occurrences of its first and last 1, 2, ... words), inside (the most
    occurrences of a phrase one word longer that holds it, 0 without one), for every
    phrase of 1 to ``max_words`` words with ``min_count`` occurrences.  totals: lang, n."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    blocks = _blocks(docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")), max_words - 1)
    counted = materialize(blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
                          .groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f")))
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")))
    level, n = _ranked(counted.where(F.col("f") >= min_count), ["lang", "word"])
    ids = _word_ids(blocks, level, n)
    level = level.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("begins"), F.array("f").alias("ends"))
    levels = []
    for size in range(1, max_words + 1):
        if size == max_words:
            levels.append((size, level.withColumn("inside", F.lit(0).cast("long"))))
            break
        pairs, n = _ranked(_count_pairs(ids, n, min_count), ["a", "b"])
        # of the phrases one word longer that hold a phrase as their first or last words, the most frequent
        longer = pairs.select(F.col("a").alias("id"), "f").union(pairs.select(F.col("b").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("inside"))
        levels.append((size, level.join(longer, "id", "left").withColumn("inside", F.coalesce("inside", F.lit(0).cast("long")))))
        left = level.select(F.col("id").alias("a"), "lang", "phrase", "begins")
        right = level.select(F.col("id").alias("b"), "last", "ends")
        if size + 1 < max_words:
            ids = _pair_ids(ids, pairs, n)
        level = materialize(pairs.join(left, "a").join(right, "b").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
            F.concat("begins", F.array("f")).alias("begins"), F.concat("ends", F.array("f")).alias("ends")))
    out = None
    for size, found in levels:
        rows = found.select("lang", F.lit(size).alias("n_words"), "phrase", F.col("f").alias("a"), "begins", "ends", "inside")
        out = rows if out is None else out.unionByName(rows)
    return out, totals


@tidy
def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100,
                 inside_share: int = 100, top: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases (all if None).

    A phrase of 2 words or more is cut after its first k words into parts of l and r
    occurrences, with score floor(1000 a n / (l r)), n being the words of the language;
    its lowest-scoring cut counts (of equal ones the first).  Phrases that lie in a longer
    one of at least ``inside_share`` percent of their occurrences are dropped; as
    occurrences never grow with length, a phrase one word longer tells."""
    found, totals = phrases(docs, text_col, lang_col, max_words, min_count)
    wide = "decimal(38,0)"
    cuts = F.expr(f"""transform(sequence(1, n_words - 1), k -> struct(
        (cast(1000 as {wide}) * cast(a as {wide}) * cast(n as {wide})) div (cast(element_at(begins, k) as {wide}) * cast(element_at(ends, n_words - k) as {wide})) as score,
        k as k, element_at(begins, k) as l, element_at(ends, n_words - k) as r))""")
    scored = (found.where(F.col("n_words") > 1).where(F.col("inside") * 100 < F.col("a") * inside_share)
              .join(totals, "lang").withColumn("cut", F.array_min(cuts))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score")))
    ranked = running(scored, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], out_col="rank")
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
