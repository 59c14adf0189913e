"""Removal of long repeated byte strings with enhanced suffix arrays.

A text is taken as UTF-8 bytes.  A byte is removed if it is covered by a string
of ``min_len`` bytes that starts at any other place too, in the same text or in
another.  To find such strings without comparing everything with everything:

1. *Runs.*  Every window of min_len bytes has a minimizer: the leftmost smallest
   hash among its ``anchor``-byte substrings.  Equal windows have equal minimizers
   at equal offsets.  Neighbouring windows with one minimizer form a run; a run
   whose minimizer occurs once in the corpus holds no repeat and is dropped.
2. *Equal runs.*  If all runs of a minimizer are equal, all of them are repeats:
   copies are settled by counts and never meet in one task.
3. *Pieces.*  Other runs are cut, aligned on the minimizer, into pieces of a few
   windows.  Pieces are grouped by their core, the bytes which all windows of the
   piece contain; equal pieces are again settled by counts.
4. *Suffix arrays.*  The different pieces of a core are put into an enhanced
   suffix array of their window starts.  A stack scan of its common-prefix array
   gives the tree of common-prefix intervals; an interval whose occurrences are
   preceded by different bytes is a maximal repeat, reported with all its
   occurrences.  Pieces have few windows, and a core with very many different
   pieces (the edge of a passage that very many texts share) is cut into smaller
   pieces first, down to single windows, so no group is unbounded.

``remove_repeats`` also takes passages of ``min_words`` words that stand elsewhere, by
the same steps: every word becomes a code of CODE bytes, whose first byte is of another
half of the alphabet than the others, so that equal words in a row are equal bytes,
whatever blanks and line ends stand between them.

Defined results: a null text is empty; texts shorter than min_len keep all bytes;
rows with equal id and text are separate places, so each repeats the other; null
ids are kept; an empty table gives no rows; other columns are ignored by
``repeated_spans`` and passed through by ``remove_repeats``, whose kept text drops
the bytes of a character that was cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, scratch, small_side
from ._text import _BLANK, mix, powers, prefix_sums, word_hashes

#: Window starts handled at a time, windows of a piece at each level, different pieces per suffix array.
_CHUNK, LEVELS, GROUP = 1 << 18, (64, 8, 1), 512
#: Bytes of a word's code.
CODE = 8


# ---- enhanced suffix array -------------------------------------------------

def lcp_intervals(lcp: list[int]):
    """Intervals (length, first, last) of suffixes with a common prefix of that
    length, from the common prefixes lcp[i] of sorted suffixes i - 1 and i
    (lcp[0] = 0): a scan with a stack of the open intervals."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now, left = lcp[i] if i < len(lcp) else 0, i - 1
        while stack[-1][0] > now:
            length, left = stack.pop()
            yield length, left, i - 1
        if stack[-1][0] < now:
            stack.append((now, left))


def maximal_repeats(texts: list[bytes], min_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """All maximal repeats of at least min_len bytes: (length, [(text, start), ...])
    with every occurrence.  A repeat is maximal if its occurrences neither all go
    on with one byte (it is the whole common prefix of its interval) nor all
    follow one byte (left-extension diversity)."""
    owner = np.concatenate([np.full(max(0, len(t) - min_len + 1), k) for k, t in enumerate(texts)]).astype(np.int64)
    if len(owner) < 2:
        return []
    start = np.concatenate([np.arange(max(0, len(t) - min_len + 1)) for t in texts])
    width = max(map(len, texts))
    flat = np.zeros((len(texts), 2 * width), np.uint8)
    size = np.array([len(t) for t in texts])
    for k, t in enumerate(texts):
        flat[k, :len(t)] = np.frombuffer(t, np.uint8)
    suffix = flat[owner[:, None], start[:, None] + np.arange(width)[None, :]]
    rest = size[owner] - start
    order = np.argsort(np.ascontiguousarray(suffix).view(f"S{width}").ravel(), kind="stable")
    suffix, owner, start, rest = suffix[order], owner[order], start[order], rest[order]
    differ = suffix[1:] != suffix[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.minimum(lcp, np.minimum(rest[1:], rest[:-1]))
    before = np.where(start > 0, flat[owner, start - 1].astype(np.int64), -1 - owner)  # a text's begin is unlike any byte
    out = []
    for length, lo, hi in lcp_intervals([0, *lcp.tolist()]):
        if length >= min_len and (before[lo:hi + 1] != before[lo]).any():
            out.append((length, list(zip(owner[lo:hi + 1].tolist(), start[lo:hi + 1].tolist(), strict=True))))
    return out


# ---- runs ------------------------------------------------------------------

def _runs(data: bytes, min_len: int, anchor: int):
    """(minimizer, its position, first window, last window, hash of the run's
    bytes and alignment) arrays of a text, in parts of bounded size."""
    b = np.frombuffer(data, np.uint8)
    w = min_len - anchor + 1
    for lo in range(0, len(b) - min_len + 1, _CHUNK):
        part = b[lo:lo + _CHUNK + min_len - 1]
        s = prefix_sums(part)
        p = powers(len(part) + 1)[0]
        m = len(part) - anchor + 1
        h = mix((s[anchor:] - s[:m]) * p[:m])
        # sliding minimum of (hash, position), unique by its position
        key = (h & ~np.uint64(0xFFFFF)) | np.arange(m, dtype=np.uint64)
        blocks = np.full(-(-m // w) * w, ~np.uint64(0))
        blocks[:m] = key
        blocks = blocks.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = m - w + 1
        at = (np.minimum(back[:n], ahead[w - 1:w - 1 + n]) & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        pos = at[first]
        content = mix((s[last + min_len] - s[first]) * p[first] + mix(((pos - first) << 20 | last - first).astype(np.uint64)))
        yield h[pos], pos + lo, first + lo, last + lo, content


def _run_rows(docs: DataFrame, min_len: int, anchor: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for r in range(0, batch.num_rows, 512):
                sub = batch.slice(r, 512)
                ids, keys, cols = [], [], []
                for i, key, text in zip(sub.column("id").to_pylist(), sub.column("key").to_pylist(), sub.column("text"), strict=True):
                    data = text.as_py().encode()
                    if len(data) < min_len:
                        continue
                    for part in _runs(data, min_len, anchor):
                        ids += [i] * len(part[0])
                        keys.append(np.full(len(part[0]), key))
                        cols.append(part)
                if cols:
                    h, pos, first, last, content = (np.concatenate(c) for c in zip(*cols, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(np.concatenate(keys), pa.int64()), pa.array(h.view(np.int64)),
                         pa.array(content.view(np.int64)), pa.array(pos, pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                        names=["id", "key", "minimizer", "content", "pos", "first", "last"])

    return docs.mapInArrow(run, "id long, key long, minimizer long, content long, pos int, first int, last int")


# ---- pieces ----------------------------------------------------------------

def _digest(*parts) -> int:
    h = hashlib.blake2b(digest_size=8)
    for p in parts:
        h.update(p if isinstance(p, bytes) else int(p).to_bytes(8, "little", signed=True))
    return int.from_bytes(h.digest(), "little", signed=True)


def _cut(data: bytes, at: int, offset: int, first: int, last: int, windows: int, min_len: int, tag: int):
    """Pieces (core key, content key, offset of the first window, first, last) of
    the windows first..last of ``data``; ``offset`` is that of window ``at``."""
    a = first
    while a <= last:
        o = offset + a - at
        lo = a - o % windows        # the piece's full range of windows
        hi = lo + windows - 1
        z = min(hi, last)
        core = data[hi:lo + min_len]
        yield _digest(tag, (o - o % windows) * 2 + 1, core), _digest(tag, o, data[a:z + min_len]), o, a, z
        a = z + 1


_PIECE = "id long, key long, core long, content long, o int, first int, last int"


def _pieces(held: DataFrame, min_len: int) -> DataFrame:
    """Pieces of the runs of each row of ``held`` (id, key, text, runs)."""

    def run(batches):
        for batch in batches:
            for r in range(0, batch.num_rows, 64):
                out = []
                for x in batch.slice(r, 64).to_pylist():
                    data = x["text"].encode()
                    for q in x["runs"]:
                        # offsets count from the first window that can have the minimizer
                        for core, content, o, a, z in _cut(data, q["pos"], min_len, q["first"], q["last"], LEVELS[0], min_len, q["minimizer"]):
                            out.append((x["id"], x["key"], core, content, o, a, z))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True), [pa.int64()] * 4 + [pa.int32()] * 3, strict=True)],
                        names=["id", "key", "core", "content", "o", "first", "last"])

    return held.mapInArrow(run, _PIECE)


_BYTES = "id long, key long, core long, content long, o int, first int, data binary, copies long"


def _with_bytes(held: DataFrame, reps: DataFrame, min_len: int) -> DataFrame:
    """The bytes of pieces (one representative of each content)."""
    listed = reps.groupBy("id", "key").agg(F.collect_list(F.struct("core", "content", "o", "first", "last", "copies")).alias("pieces"))
    rows = (held.select("id", "key", "text").withColumnsRenamed({"id": "hid", "key": "hkey"})
            .join(listed, F.col("hid").eqNullSafe(F.col("id")) & (F.col("hkey") == F.col("key")))
            .dropDuplicates(["id", "key"]).select("id", "key", "text", "pieces"))

    def run(batches):
        for batch in batches:
            for r in range(0, batch.num_rows, 64):
                out = []
                for x in batch.slice(r, 64).to_pylist():
                    data = x["text"].encode()
                    for q in x["pieces"]:
                        out.append((x["id"], x["key"], q["core"], q["content"], q["o"], q["first"],
                                    data[q["first"]:q["last"] + min_len], q["copies"]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BYTES_TYPES, strict=True)],
                                                     names=_BYTES_NAMES)

    return rows.mapInArrow(run, _BYTES)


_BYTES_NAMES = ["id", "key", "core", "content", "o", "first", "data", "copies"]
_BYTES_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]


def _smaller(rows: DataFrame, windows: int, min_len: int) -> DataFrame:
    """Cut pieces with their bytes into pieces of fewer windows."""

    def run(batches):
        for batch in batches:
            for r in range(0, batch.num_rows, 256):
                out = []
                for x in batch.slice(r, 256).to_pylist():
                    data = x["data"]
                    for core, content, o, a, z in _cut(data, 0, x["o"], 0, len(data) - min_len, windows, min_len, x["core"]):
                        out.append((x["id"], x["key"], core, content, o, x["first"] + a, data[a:z + min_len], x["copies"]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BYTES_TYPES, strict=True)],
                                                     names=_BYTES_NAMES)

    return rows.mapInArrow(run, _BYTES)


def _scan(rows: DataFrame, min_len: int) -> DataFrame:
    """Spans of the maximal repeats among the different pieces of each core."""

    def run(batches):
        key, group = None, []

        def spans(group):
            found = {}
            for length, places in maximal_repeats([g[4] for g in group], min_len):
                for k, at in places:
                    found.setdefault((k, at), length)  # inner intervals come first and are longer
            return [(group[k][1], group[k][2], group[k][3] + at, group[k][3] + at + length)
                    for (k, at), length in found.items() if group[k][5] == 1]

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), [pa.int64()] * 2 + [pa.int32()] * 2, strict=True)], names=["id", "key", "start", "stop"])

        for batch in batches:
            out = []
            for g in zip(*(batch.column(c).to_pylist() for c in ("core", "id", "key", "first", "data", "copies")), strict=True):
                if g[0] != key:
                    if len(group) > 1:
                        out += spans(group)
                    key, group = g[0], []
                group.append(g)
            if out:
                yield table(out)
        if len(group) > 1 and (out := spans(group)):
            yield table(out)

    return (rows.select("core", "id", "key", "first", "data", "copies").repartition("core").sortWithinPartitions("core")
            .mapInArrow(run, "id long, key long, start int, stop int"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"_id": F.col(id_col).cast("long"), "_key": F.xxhash64(text)})


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_len: int = 400, anchor: int = 100) -> DataFrame:
    """(id, key, start, stop): byte spans of repeats, not merged; key is the
    xxhash64 of the text."""
    k = _keyed(docs, id_col, text_col)
    return _spans(k.select(F.col("_id").alias("id"), F.col("_key").alias("key"), F.col(text_col).cast("string").alias("text")), min_len, anchor)


def _codes(text: str) -> str:
    """The codes of a text's words, one after the other."""
    h = word_hashes(text, lower=False)
    five = (h[:, None] >> np.arange(0, 5 * CODE, 5, dtype=np.uint64)[None, :]).astype(np.uint8) & 31
    five += np.array([64] + [32] * (CODE - 1), np.uint8)
    return five.tobytes().decode("ascii")


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 51) -> DataFrame:
    """(id, key, start, stop): word spans (from 0, separated by blanks) of passages of
    at least min_words words that stand elsewhere, not merged."""

    @F.arrow_udf("string")
    def codes(texts: pa.Array) -> pa.Array:
        return pa.array([_codes(t.as_py()) for t in texts], pa.string())

    k = _keyed(docs, id_col, text_col)
    text = F.col(text_col).cast("string")
    rows = k.where(F.octet_length(text) >= 2 * min_words - 1)  # as many words, and blanks between them
    coded = materialize(rows.select(F.col("_id").alias("id"), F.col("_key").alias("key"), codes(text).alias("text")))
    spans = _spans(coded, min_words * CODE, min_words * CODE // 4)
    whole = spans.select("id", "key", F.ceil(F.col("start") / CODE).cast("int").alias("start"), F.floor(F.col("stop") / CODE).cast("int").alias("stop"))
    return whole.where(F.col("stop") - F.col("start") >= min_words)


def _spans(docs: DataFrame, min_len: int, anchor: int) -> DataFrame:
    """The repeats of (id, key, text) rows; rows of equal id and key have equal texts."""
    docs = docs.where(F.octet_length("text") >= min_len)
    runs = materialize(_run_rows(docs, min_len, anchor))
    # groups are a table of their own, so that the join's sides are plain shuffles and the rows of a
    # frequent minimizer can be split
    groups = materialize(runs.groupBy("minimizer").agg(F.count("*").alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
                         .where("n > 1").select("minimizer", (F.col("lo") == F.col("hi")).alias("same")))
    shared = materialize(runs.join(small_side(groups), "minimizer"))
    out = shared.where("same").select("id", "key", F.col("first").alias("start"), (F.col("last") + min_len).alias("stop"))

    # an equal row's runs are equal, so distinct runs describe all of them; rows count in copies below
    per_text = shared.where("NOT same").groupBy("id", "key").agg(
        F.collect_set(F.struct("minimizer", "pos", "first", "last")).alias("runs"))
    held = materialize(docs.withColumnsRenamed({"id": "hid", "key": "hkey"})
                       .join(per_text, F.col("hid").eqNullSafe(F.col("id")) & (F.col("hkey") == F.col("key")))
                       .select("id", "key", "text", "runs"))
    pieces = materialize(_pieces(held, min_len))
    counts = materialize(pieces.groupBy("core", "content").agg(F.count("*").alias("copies"), F.min(F.struct("id", "key", "o", "first", "last")).alias("r")))
    kinds = materialize(counts.groupBy("core").agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest")).where("kinds > 1 AND fewest = 1"))
    out = out.union(pieces.join(counts.where("copies > 1").select("core", "content"), ["core", "content"], "left_semi")
                    .select("id", "key", F.col("first").alias("start"), (F.col("last") + min_len).alias("stop")))
    reps = counts.join(kinds, "core").select("r.*", "core", "content", "copies")
    rows = materialize(_with_bytes(held, reps, min_len))
    for windows in LEVELS[1:]:
        kinds = rows.groupBy("core").agg(F.count("*").alias("kinds"))
        out = out.union(_scan(rows.join(kinds.where(F.col("kinds").between(2, GROUP)).select("core"), "core", "left_semi"), min_len))
        big = materialize(_smaller(rows.join(kinds.where(F.col("kinds") > GROUP).select("core"), "core", "left_semi"), windows, min_len))
        if big.isEmpty():
            return out
        counts = big.groupBy("core", "content").agg(F.sum("copies").alias("total"), F.min(F.struct("id", "key", "first")).alias("r"))
        big = materialize(big.join(counts, ["core", "content"]))
        out = out.union(big.where("total > 1 AND copies = 1").select(
            "id", "key", F.col("first").alias("start"), (F.col("first") + F.length("data")).alias("stop")))
        rows = big.where("r.id <=> id AND r.key = key AND r.first = first").select(
            *_BYTES_NAMES[:-1], F.col("total").alias("copies"))
    return out  # equal cores of single windows are equal windows: nothing is left to scan


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_len: int = 400, anchor: int = 100, min_words: int | None = None, count_words: bool = True) -> DataFrame:
    """``docs`` with its text replaced by the kept bytes, and n_bytes, n_removed,
    n_spans (maximal removed runs) and kept_sha256 (of the kept bytes).  With
    ``min_words``, passages of so many words that stand elsewhere go too; the figures
    and the hash are then of both, or of the byte strings alone without ``count_words``."""
    with scratch(docs.sparkSession) as s:
        with scratch(docs.sparkSession) as own:
            spans = own.keep(repeated_spans(docs, id_col, text_col, min_len, anchor).withColumn("words", F.lit(False)))
        if min_words:
            with scratch(docs.sparkSession) as own:
                spans = spans.unionByName(own.keep(repeated_words(docs, id_col, text_col, min_words).withColumn("words", F.lit(True))))
        per_text = s.keep(spans.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("start", "stop", "words"))).alias("_spans"))
                          .withColumnsRenamed({"id": "_sid", "key": "_skey"}))

    def byte_spans(data: bytes, found) -> list[tuple[int, int]]:
        if not any(s["words"] for s in found):
            return [(s["start"], s["stop"]) for s in found]
        blank = np.ones(len(data) + 2, bool)
        blank[1:-1] = _BLANK[np.frombuffer(data, np.uint8)]
        edges = np.flatnonzero(blank[1:] != blank[:-1])  # begin and end of each word
        return sorted((int(edges[2 * s["start"]]), int(edges[2 * s["stop"] - 1])) if s["words"] else (s["start"], s["stop"]) for s in found)

    def without(data: bytes, spans) -> tuple[bytes, int]:
        """The bytes outside sorted spans, and the number of removed runs."""
        kept, at, n, end = [], 0, 0, -1  # the end of the open removed run
        for start, stop in spans:
            if start > end:
                kept.append(data[at:start])
                n += 1
            at = end = max(end, stop)
        return (b"".join([*kept, data[at:]]), n) if n else (data, 0)

    @F.arrow_udf("struct<text:string,n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans, strict=True):
            text, found = text.as_py(), found.as_py() or ()
            data = (text or "").encode()
            kept, n = without(data, byte_spans(data, found))
            text = text if not n else kept.decode("utf-8", "ignore")
            if not count_words:
                kept, n = without(data, [(s["start"], s["stop"]) for s in found if not s["words"]])
            out.append({"text": text, "n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": n,
                        "kept_sha256": hashlib.sha256(kept).hexdigest()})
        return pa.array(out, pa.struct([("text", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(per_text, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_key") == F.col("_skey")), "left")
    done = joined.withColumn("_cut", cut(F.col(text_col).cast("string"), "_spans"))
    return done.withColumns({text_col: F.col("_cut.text"), "n_bytes": F.col("_cut.n_bytes"), "n_removed": F.col("_cut.n_removed"),
                             "n_spans": F.col("_cut.n_spans"), "kept_sha256": F.col("_cut.kept_sha256")}).drop(
        "_id", "_key", "_sid", "_skey", "_spans", "_cut")
