"""Near duplicates by fast similarity sketching, banding and exact verification.

1. *Sketches.*  A set of word shingles gets T coordinates.  In round i < T every
   shingle is hashed anew to one of the T bins, and a bin keeps the smallest value
   (round, hash) that reached it; in round T + j all shingles go to bin j.  A round
   is only played while a bin is empty, so every coordinate is filled after 2 T
   rounds at most and, for large sets, after one or two.  The chance that a
   coordinate of two sets agrees is their Jaccard similarity, and since the bins of
   a round are filled without replacement, the number of agreeing coordinates is
   at least as concentrated as with independent hash functions.
2. *Bands.*  ROWS coordinates make a band, and two sets with an equal band are
   candidates.  Sets of similarity s miss each other with probability
   (1 - s ** ROWS) ** (T / ROWS): 3e-13 at 0.8.  Within a band the sets are paired
   with one hub only, never with each other; a frequent band is split over tasks.
3. *Verification.*  Overlaps of whole sets decide every pair (by fragments, summed per
   pair); sets that share a hub but ended in different components are compared in
   blocks of bounded size, which return only links that join components.

Equal sets are one node from the start, so copies never meet each other.

Defined results: a null or blank text has an empty set and links with nothing;
fewer words than a shingle make one shingle; rows with a null or repeated id stay
rows of their own, and a component's id is the smallest non-null one (null without
any); an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._shared import materialize, scratch, small_side, tidy
from ._text import mix, set_id, shingles
from .ngram_join import _hub_pairs, _overlaps, _rest, _segments

#: Coordinates of a sketch, and coordinates of a band.
T, ROWS = 120, 3
#: The part of the hash order that decides early in blocks.  Sets of similarity s differ there by
#: about (1 - s) / (1 + s) * FIRST of their shingles, where a link at 0.8 allows 1 / 9 in all: a
#: half excludes most pairs below 0.64, 2 / 9 would only those below a third.
FIRST = 1 / 2
#: Fragments in which the sets of a pair are compared.
FRAGMENTS = 2
#: Shingles sketched at a time.
_FLAT = 1 << 18
_STEP = 0x9E3779B97F4A7C15


def sketches(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """The sketch of each non-empty set of 64-bit hashes, a row of t values each."""
    x = np.concatenate(sets)
    base = np.repeat(np.arange(len(sets), dtype=np.int64) * t, [len(s) for s in sets])
    empty = np.uint64((1 << 64) - 1)
    out = np.full(len(sets) * t, empty, np.uint64)
    for i in range(2 * t):
        h = mix(x ^ mix(np.full(1, (i + 1) * _STEP % (1 << 64), np.uint64)))
        at = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, base + at, (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
        unfilled = (out.reshape(-1, t) == empty).any(axis=1)
        alive = unfilled[base // t]
        if not alive.all():
            x, base = x[alive], base[alive]
            if not len(x):
                break
    return out.reshape(-1, t)


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of each sketch; bands at different places differ."""
    n, t = sketch.shape
    key = np.broadcast_to(np.arange(t // rows, dtype=np.uint64), (n, t // rows)) + np.uint64(1)
    for r in range(rows):
        key = mix(key * np.uint64(_STEP) + sketch[:, r:t // rows * rows:rows])
    return key


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """(id, text_key, n, sid, sketch, bands) per text.  ``sketch`` is the set's part in
    a first fragment of the hash order, on which step 3 drops most pairs of a hub's partners
    early; ``bands`` is null for a set that its task has met before."""
    width = np.uint64(round(FIRST * (1 << 32)) << 32)

    def run(batches):
        seen: set[int] = set()

        def flush(rows):
            new = [r for r in rows if r[5] is not None]
            keys = iter(bands(sketches([r[5] for r in new])).view(np.int64) if new else ())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[4] for r in rows], pa.list_(pa.int32())),
                 pa.array([None if r[5] is None else next(keys) for r in rows], pa.list_(pa.int64()))],
                names=["id", "text_key", "n", "sid", "sketch", "bands"])

        for batch in batches:
            rows, held = [], 0
            for i, key, text in zip(batch.column("id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text"), strict=True):
                s = shingles(text.as_py(), k)
                sid = set_id(s)
                new = len(s) > 0 and sid not in seen
                if new:
                    if len(seen) >= 1 << 18:
                        seen.clear()
                    seen.add(sid)
                    held += len(s)
                rows.append((i, key, len(s), sid, np.unique(s[:np.searchsorted(s, width)].astype(np.uint32)).view(np.int32), s if new else None))
                if held >= _FLAT:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)

    return docs.mapInArrow(run, "id long, text_key long, n int, sid long, sketch array<int>, bands array<long>")


@tidy
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                    num: int = 8, den: int = 10) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles, component_id (the smallest id
    reachable by links of Jaccard similarity num / den or more between sets of k-word
    shingles) and kept (this row has that id).

    The default bands suit similarities from 0.7 up (a pair at 0.7 is missed with
    probability 5e-8); links below the asked similarity are never returned."""
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    profiles = materialize(_profiles(docs, k))
    repeated = not profiles.groupBy("id", "text_key").count().where("count > 1").isEmpty()

    def segments_of(nodes: DataFrame, fragments: int) -> DataFrame:
        return _segments(docs, profiles, nodes.distinct(), k, repeated, fragments)

    rows = profiles.where("bands IS NOT NULL").select(F.explode("bands").alias("segment"), F.col("sid").alias("node"), "n")
    with scratch(docs.sparkSession) as s:
        pairs = s.keep(_hub_pairs(rows))
    paired = materialize(pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct())
    parts = materialize(profiles.where("bands IS NOT NULL").join(small_side(paired), "sid", "left_semi").groupBy("sid").agg(F.first("sketch").alias("sketch")))
    alive = pairs.where(f"least(na, nb) * {den}L >= greatest(na, nb) * {num}L")
    whole = segments_of(alive.select(F.col("a").alias("sid")).union(alive.select(F.col("b").alias("sid"))), FRAGMENTS)
    links = materialize(alive.join(_overlaps(alive, whole), ["a", "b"])
                        .where(f"overlap * {num + den} >= (na + nb) * {num}L").select("a", "b"))
    comps = components(links)
    more = materialize(_rest(pairs, comps, parts, segments_of, num, den))
    if not more.isEmpty():
        comps = components(links.union(more))
    placed = (profiles.select("id", "n", "sid").join(comps.withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "sid"))))
    lowest = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("low"))
    found = placed.join(lowest, "comp", "left").select("id", "n", F.coalesce("low", "id").alias("component_id"))
    return found.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
