"""N-gram Jaccard join by vertical partitioning.

Texts become sets of word shingles; two texts link when the Jaccard similarity
of their sets is at least num / den.  All shingles have one global order, that of
their hashes, which is cut into fragments; a set's part in a fragment is a segment.

1. *Profiles.*  Texts with one shingle set become one node.
2. *Candidates.*  Sets that link differ in at most D shingles, D following from their
   sizes.  With the order cut into D + 1 + e fragments, at least e + 1 of their
   segments are equal; segments of very few shingles say little, so each set leaves
   out its e least ones, and the two still meet in an equal segment.  The number
   of fragments depends on a size class; a set takes part in its own class and, if it
   can link with a smaller set there, in the class below.  Rows (segment, node)
   are range-partitioned by both and streamed in order; the first node of a segment is
   its hub, and every other node is paired with the hub only, never with each other.
3. *Overlaps.*  The global order is cut into fragments.  Within a fragment, a
   hub's segment is held while its partners' segments stream by, the partial
   overlaps are counted, and their sum per pair decides the link exactly.
   A pair whose sketches (a first, narrow fragment) already differ too much is
   dropped before any whole set is sent.
4. *Rest.*  Two partners of one hub that ended in different components are still
   undecided (a hub may be far from both).  They are compared in blocks of
   bounded size, without writing the pairs: a block returns only links that join
   different components.  Partners already joined through their hub are skipped,
   and only nodes with a partner that the sketches leave possible bring their
   segments.

So every link between different texts is either found or already implied, the
components are those of the full link graph, and no step holds a group whole.

Defined results: a null or blank text has an empty set and links with nothing;
fewer than k words make one shingle; rows with a null or repeated id stay rows of
their own (an id counts for its component once any of its texts is in it); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from math import ceil, exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._shared import materialize, scratch, small_side, tidy
from ._text import mix, set_id, shingles

#: Ratio of the sizes of a class.
CLASS_RATIO = 1.25
#: Fragments in which overlaps are counted.
FRAGMENTS = 6
#: Partners of a hub per task group, and rows and shingles of a block in step 4.
PARTNERS, BLOCK_ROWS, BLOCK_SHINGLES = 512, 1024, 1 << 19


def _profiles(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, text_key, n, sid, sketch) per text.  The sketch is the set's part in a
    first fragment, shingles cut to 32 bits: sets differ at least as much as their
    sketches.  It is as wide as it takes to tell sets of little overlap apart."""
    width = np.uint64(min((1 << 64) - 1, (1 << 64) * 2 * (den - num) // (den + num)))

    def run(batches):
        for batch in batches:
            n, sid, sketch = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                n.append(len(s))
                sid.append(set_id(s))
                sketch.append(np.unique(s[:np.searchsorted(s, width)].astype(np.uint32)).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n, pa.int32()), pa.array(sid, pa.int64()), pa.array(sketch, pa.list_(pa.int32()))],
                names=["id", "text_key", "n", "sid", "sketch"])

    return docs.mapInArrow(run, "id long, text_key long, n int, sid long, sketch array<int>")


class SizeClasses:
    """Size classes and their fragments for a similarity of num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.first = [1, 2]  # smallest size of each class
        self.plans: dict[int, tuple[int, int, int]] = {}

    def of(self, n: int) -> list[int]:
        """The classes that a set of n shingles takes part in: a pair belongs to the
        class of its smaller set."""
        while self.first[-1] <= n:
            self.first.append(max(self.first[-1] + 1, int(self.first[-1] * CLASS_RATIO)))
        own = bisect_right(self.first, n) - 1
        least = -(-n * self.num // self.den)  # the smallest set that n can link with
        return list(range(bisect_right(self.first, least) - 1, own + 1))

    def plan(self, c: int) -> tuple[int, int, int]:
        """(fragments, e, size up to which a segment is small) of a class.  e is about
        the number of small segments that a set of the class's least size has."""
        if c not in self.plans:
            while len(self.first) < c + 2:
                self.of(self.first[-1])
            small = self.first[c + 1] - 1
            most = (small + small * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
            m, e, bound = most + 1, 0, 1
            for _ in range(8):
                mean = self.first[c] / m
                bound = 1 if mean < 4 else 2
                share = exp(-mean) * sum(mean ** i / factorial(i) for i in range(bound + 1))
                e = min(most + 1, ceil(1.2 * share * m))
                m = most + 1 + e
            self.plans[c] = (0, 0, 0) if most == 0 else (m, e, bound)
        return self.plans[c]


def segment_keys(s: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Keys of a set's segments in each of its classes, without those left out."""
    out = []
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s), out=total[1:])
    for c in classes.of(len(s)):
        m, e, bound = classes.plan(c)
        if not m:  # sets of the class that link are equal
            continue
        limits = np.array([(i << 64) // m for i in range(1, m)], np.uint64)
        cut = np.concatenate([[0], np.searchsorted(s, limits), [len(s)]])
        size = np.diff(cut)
        key = mix((total[cut[1:]] - total[cut[:-1]]) + mix((np.uint64(c) << np.uint64(40)) + np.arange(m, dtype=np.uint64) * np.uint64(64)
                                                            + np.minimum(size, 63).astype(np.uint64)))
        least = np.flatnonzero(size <= bound)
        least = least[np.lexsort((key[least], size[least]))][:e]
        out.append(np.delete(key, least))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _segment_rows(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(segment, node, n) for the segments of each node."""

    def run(batches):
        classes = SizeClasses(num, den)
        seen: set[int] = set()
        for batch in (b.slice(r, 256) for b in batches for r in range(0, b.num_rows, 256)):
            out, nodes, sizes = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                if not len(s):
                    continue
                sid = set_id(s)
                if sid in seen:  # a copy in this task has given the same rows
                    continue
                if len(seen) >= 1 << 18:
                    seen.clear()
                seen.add(sid)
                out.append(segment_keys(s, classes))
                nodes.append(np.full(len(out[-1]), sid, np.int64))
                sizes.append(np.full(len(out[-1]), len(s), np.int32))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(nodes)),
                                                  pa.array(np.concatenate(sizes))], names=["segment", "node", "n"])

    return docs.mapInArrow(run, "segment long, node long, n int")


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, na, b, nb) of each segment's first node and its others.  A task
    sees part of a frequent segment's nodes: for its first and last segment it
    also reports the local hub, and the smallest local hub takes the others."""

    def run(batches):
        last, hub, size, first = None, 0, 0, None
        empty = True
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, node, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("segment", "node", "n"))
            empty = False
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            if last is not None:
                new[0] = sig[0] != last
            at = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
            a = np.where(at < 0, hub, node[at])
            na = np.where(at < 0, size, n[at])
            if first is None:
                first = sig[0]
            is_open = sig == first
            keep = (a != node) | is_open & new
            shut = keep & ~is_open
            last, hub, size = sig[-1], a[-1], na[-1]
            pairs, where = np.unique(np.stack([a[shut], node[shut]]), axis=1, return_index=True)
            some = np.flatnonzero(keep & is_open)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs[0], a[some]])), pa.array(np.concatenate([na[shut][where], na[some]]), pa.int32()),
                 pa.array(np.concatenate([pairs[1], node[some]])), pa.array(np.concatenate([n[shut][where], n[some]]), pa.int32()),
                 pa.array([None] * len(where) + [first] * len(some), pa.int64())], names=["a", "na", "b", "nb", "border"])
        if not empty:
            yield pa.RecordBatch.from_arrays([pa.array([hub], pa.int64()), pa.array([size], pa.int32()), pa.array([hub], pa.int64()),
                                              pa.array([size], pa.int32()), pa.array([last], pa.int64())],
                                             names=["a", "na", "b", "nb", "border"])

    streamed = materialize(rows.repartitionByRange("segment", "node").sortWithinPartitions("segment", "node")
                           .mapInArrow(run, "a long, na int, b long, nb int, border long"))
    border = streamed.where("border IS NOT NULL")
    hubs = border.groupBy("border").agg(F.min(F.struct("a", "na")).alias("hub"))  # two rows a partition at most
    moved = border.join(F.broadcast(hubs), "border").select("hub.a", "hub.na", "b", "nb")
    return streamed.where("border IS NULL").drop("border").union(moved).where("a <> b").distinct()


def _segments(docs: DataFrame, profiles: DataFrame, nodes: DataFrame, k: int, repeated: bool, fragments: int) -> DataFrame:
    """(sid, frag, seg) of the nodes, each from one of its texts.  ``repeated`` tells
    whether any row of docs occurs twice."""
    wanted = materialize(profiles.join(nodes, "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("id", "text_key")).alias("w")).select(
        "sid", F.col("w.id").alias("want_id"), F.col("w.text_key").alias("want_key")))
    found = docs.join(small_side(wanted), docs["id"].eqNullSafe(wanted["want_id"]) & (docs["text_key"] == wanted["want_key"]))

    def run(batches):
        for batch in batches:
            sids, frags, sizes, parts = [], [], [0], []
            for sid, text in zip(batch.column("sid").to_pylist(), batch.column("text"), strict=True):
                s = shingles(text.as_py(), k)
                if set_id(s) != sid:
                    continue
                cuts = np.searchsorted((s >> np.uint64(40)) * np.uint64(fragments) >> np.uint64(24), np.arange(fragments + 1))
                for x in range(fragments):
                    if cuts[x] < cuts[x + 1]:
                        sids.append(sid)
                        frags.append(x)
                        parts.append(s[cuts[x]:cuts[x + 1]])
                        sizes.append(sizes[-1] + len(parts[-1]))
            if sids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sids, pa.int64()), pa.array(frags, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))],
                    names=["sid", "frag", "seg"])

    rows = found.select("sid", "text").mapInArrow(run, "sid long, frag int, seg array<long>")
    return materialize(rows.dropDuplicates(["sid", "frag"]) if repeated else rows)


def _overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, overlap) of pairs that overlap: partial overlaps by fragment, summed."""
    groups = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("groups")))
    dealt = materialize(pairs.select("a", "b").join(small_side(groups), "a"))
    # the segments are the large side, and move only once, to their group
    hubs = (segments.join(small_side(groups), F.col("a") == F.col("sid"))
            .select("a", F.explode(F.sequence(F.lit(0), F.col("groups").cast("int") - 1)).alias("part"), "frag",
                    F.lit(None).cast("long").alias("b"), "seg"))
    partners = (segments.join(small_side(dealt), F.col("b") == F.col("sid"))
                .select("a", F.pmod(F.xxhash64("b"), "groups").cast("int").alias("part"), "frag", "b", "seg"))

    def run(batches):
        key, held = None, None
        for batch in batches:
            out = []
            segs = batch.column("seg")
            flat, at = segs.values.to_numpy(zero_copy_only=False), segs.offsets.to_numpy()
            for i, (a, part, frag, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "part", "frag", "b")), strict=True)):
                x = flat[at[i]:at[i + 1]].view(np.uint64)
                if b is None:
                    key, held = (a, part, frag), x.copy()
                elif key == (a, part, frag):
                    n = int((held[np.minimum(np.searchsorted(held, x), len(held) - 1)] == x).sum())
                    if n:
                        out.append((a, b, n))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "partial"])

    return (hubs.unionByName(partners).repartition("a", "part", "frag").sortWithinPartitions("a", "part", "frag", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a long, b long, partial long").groupBy("a", "b").agg(F.sum("partial").alias("overlap")))


def _possible(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sizes and sketches do not exclude a link."""
    close = pairs.where(f"least(na, nb) * {den}L >= greatest(na, nb) * {num}L")
    a, b = (sketches.select(F.col("sid").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    return close.join(a, "a").join(b, "b").where(
        f"(size(sa) + size(sb) - 2 * size(array_intersect(sa, sb))) * {den + num}L <= (na + nb) * {den - num}L").select("a", "na", "b", "nb")


def _blocks(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, block, side, b, n, comp): the partners of each hub a whose partners are in
    different components, placed in blocks so that any two of them in different
    components meet as sides 0 and 1 of one block (or both in side 0 of it)."""
    named = comps.select(F.col("node").alias("b"), "comp")
    member = pairs.join(named, "b", "left").withColumn("comp", F.coalesce("comp", "b"))
    open_hubs = (member.groupBy("a").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows"), F.max("nb").alias("most"))
                 .where("lo <> hi").select("a", F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("rows") * F.col("most") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    own = comps.select(F.col("node").alias("a"), F.col("comp").alias("hub_comp"))
    # partners that are joined to the hub are in one component: they are parts 0, 2, 4 ..., the others 1, 3, 5 ...
    member = (member.join(open_hubs, "a").join(own, "a", "left")
              .withColumn("far", (F.col("comp") != F.coalesce("hub_comp", "a")).cast("int"))
              .withColumn("part", F.when(F.col("parts") > 1, 2 * F.pmod(F.xxhash64("b"), "parts") + F.col("far")).otherwise(1).cast("int")))
    unit = member.select("a", "part").distinct()
    other = unit.select("a", F.col("part").alias("part1"))
    # two parts of even number hold one component
    block = (unit.select("a", F.col("part").alias("part0")).join(other, "a")
             .where("part0 <= part1 AND (part0 % 2 = 1 OR part1 % 2 = 1)")
             .withColumn("block", (F.col("part0").cast("long") * (1 << 31)) + F.col("part1")))
    one = block.select("a", "block", F.lit(0).alias("side"), F.col("part0").alias("part"))
    two = block.where("part0 <> part1").select("a", "block", F.lit(1).alias("side"), F.col("part1").alias("part"))
    return one.union(two).join(member, ["a", "part"]).select("a", "block", "side", "b", F.col("nb").alias("n"), "comp")


def _read_block(block: pa.Table, num: int, den: int, whole: bool):
    """Nodes, components and sides of a block, the place in it of each node's row, and the mask
    of pairs that link (``whole``: the segments are whole sets) or that the given segments do
    not exclude: of different components, compatible in size, and each pair once."""
    column = {c: block.column(c).to_numpy(zero_copy_only=False) for c in ("b", "n", "comp", "side")}
    b, first, row_of = np.unique(column["b"], return_index=True, return_inverse=True)
    n, comp, side = (column[c][first] for c in ("n", "comp", "side"))
    n = n.astype(np.int64)
    each = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int64) for x in block.column("seg")]
    row = np.repeat(row_of, [len(x) for x in each])
    column_of = np.unique(np.concatenate(each), return_inverse=True)[1]
    order = np.argsort(column_of, kind="stable")
    row, column_of = row[order], column_of[order]
    overlap = np.zeros((len(b), len(b)), np.int32)
    for lo in range(0, int(column_of[-1]) + 1 if len(column_of) else 0, 4096):
        i, j = np.searchsorted(column_of, [lo, lo + 4096])
        m = np.zeros((len(b), 4096), np.float32)
        m[row[i:j], column_of[i:j] - lo] = 1
        overlap += (m @ m.T).astype(np.int32)
    size = np.diag(overlap).astype(np.int64)
    ask = np.zeros(overlap.shape, bool)
    two, place = side.any(), np.arange(len(b))
    for lo in range(0, len(b), 256):  # some rows at a time: the block's matrices in 64 bits are large
        at = slice(lo, lo + 256)
        o, both = overlap[at].astype(np.int64), n[at, None] + n[None, :]
        ask[at] = (num + den) * o >= num * both if whole else (size[at, None] + size[None, :] - 2 * o) * (den + num) <= both * (den - num)
        ask[at] &= (comp[at, None] != comp[None, :]) & (np.minimum(n[at, None], n[None, :]) * den >= np.maximum(n[at, None], n[None, :]) * num)
        ask[at] &= side[at, None] < side[None, :] if two else place[at, None] < place[None, :]
    return b, comp, first, ask


def _rest(pairs: DataFrame, comps: DataFrame, sketches: DataFrame, segments_of, num: int, den: int) -> DataFrame:
    """Links between partners of one hub that are in different components: first the
    sketches exclude what they can, and only nodes that still have a possible partner
    bring their segments."""

    def possible(block: pa.Table) -> pa.Table:
        _, _, first, ask = _read_block(block, num, den, False)
        return block.select(names[:-1]).take(pa.array(first[ask.any(axis=0) | ask.any(axis=1)]))

    def decided(block: pa.Table) -> pa.Table:
        b, comp, _, ask = _read_block(block, num, den, True)
        top: dict[int, int] = {}

        def root(c):
            while c in top:
                c = top[c]
            return c

        out = []
        for i, j in np.argwhere(ask):
            p, q = root(int(comp[i])), root(int(comp[j]))
            if p != q:
                top[p] = q
                out.append((int(b[i]), int(b[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    placed = materialize(_blocks(pairs, comps))
    names = ["a", "block", "side", "b", "n", "comp", "seg"]
    light = sketches.withColumnRenamed("sketch", "seg").join(small_side(placed, F.lit(48)), F.col("b") == F.col("sid")).select(names)
    kept = materialize(light.groupBy("a", "block").applyInArrow(possible, "a long, block long, side int, b long, n int, comp long"))
    segments = segments_of(kept.select(F.col("b").alias("sid")), 1)  # a block compares whole sets
    full = segments.join(small_side(kept, F.lit(48)), F.col("b") == F.col("sid")).select(names)
    return full.groupBy("a", "block").applyInArrow(decided, "a long, b long")


@tidy
def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                       num: int = 9, den: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles (size of its set), sid (the
    identity of its set: rows with one sid have equal sets), text_key (xxhash64 of
    the text), node (the sid that names the component, null without words) and
    component_id, the smallest id that is reachable by links of Jaccard similarity
    >= num / den."""
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    profiles = materialize(_profiles(docs, k, num, den))
    repeated = not profiles.groupBy("id", "text_key").count().where("count > 1").isEmpty()

    def segments_of(nodes: DataFrame, fragments: int) -> DataFrame:
        return _segments(docs, profiles, nodes.distinct(), k, repeated, fragments)

    with scratch(docs.sparkSession) as s:
        pairs = s.keep(_hub_pairs(_segment_rows(docs.where("text IS NOT NULL").select("text"), k, num, den)))
    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    sketches = materialize(profiles.join(nodes, "sid", "left_semi").groupBy("sid").agg(F.first("sketch").alias("sketch")))
    alive = materialize(_possible(pairs, sketches, num, den))
    segments = segments_of(alive.select(F.col("a").alias("sid")).union(alive.select(F.col("b").alias("sid"))), FRAGMENTS)
    links = materialize(alive.join(_overlaps(alive, segments), ["a", "b"])
                        .where(f"overlap * {num + den} >= (na + nb) * {num}L").select("a", "b"))
    comps = components(links)
    more = materialize(_rest(pairs, comps, sketches, segments_of, num, den))
    if not more.isEmpty():
        comps = components(links.union(more))
    placed = (profiles.join(comps.withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "sid"))))
    lowest = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("low"))
    return (placed.join(lowest, "comp", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "sid", "text_key", F.col("comp").alias("node"),
                    F.coalesce("low", "id").alias("component_id")))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest
    id (of several texts with that id, the one of the smallest text hash; of equal
    rows one).  Unlike texts are components of their own whatever their ids, null or
    repeated; texts without words too, and stay."""
    found = jaccard_components(docs, id_col, text_col, k, num, den)
    keyed = docs.withColumn("_key", F.xxhash64(F.col(text_col).cast("string")))
    first = (found.where("n_shingles > 0").groupBy(F.col("node").alias("_c"))
             .agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("_id"), F.col("text_key").alias("_want"))).alias("_first"))
             .select("_first._id", "_first._want"))
    kept = keyed.join(first, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_want")), "left_semi")
    blank = found.where("n_shingles = 0").select(F.col(id_col).alias("_id"), F.col("text_key").alias("_want")).distinct()
    rest = keyed.join(blank, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_want")), "left_semi")
    return kept.dropDuplicates([id_col, "_key"]).union(rest).drop("_key")
