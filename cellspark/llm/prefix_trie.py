"""The prefix trie of conversations, by truncation peeling.

A node of the trie is a distinct sequence of first turns.  The trie is peeled from
its deepest level: the nodes of a level, found from the conversations that end there and the
nodes that survive from below, are summed up, lose their last turn and are grouped
again with the conversations that end one level higher.  So every node is discovered,
and all its figures are complete, in the one pass that reaches its level.

* *Paths.*  A turn is its 128-bit hash; a prefix is the exclusive or of its turns'
  hashes, each taken with its place.  Running values over ranges of (conversation,
  place) give the prefix at every turn, so a conversation may span many tasks.
* *Bands.*  Levels are cut into bands, and a conversation's path into one row per band:
  a surviving node fetches its path only when it enters a band.
* *Dense levels* are one ``groupBy`` of paths each.  It sums in part before the shuffle,
  so a first turn that a third of all conversations share is a few rows per task.
* *Tails.*  Neighbouring levels that hold at most TAIL_ROWS turns together, as the ends
  of few long conversations do, make one band that is peeled in one step: rows are
  grouped by the prefix above the band, and a group cannot exceed the bound.
* *Ids.*  The digest of the conversations that end at a node needs their ids in order:
  they are range-partitioned by (node, id), rendered to pieces of text in parallel, and
  one stream per node hashes its pieces; nothing is held but the hash state.

Defined results: null roles and texts are empty; rows of a null conversation id belong
to no conversation and are left out; turns are ordered by number (null first), turns of
one number by the hashes of role and text, and repeated rows are turns of their own;
a table without rows has no trie; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import running
from ._shared import materialize, tidy

#: Turns in a band that is peeled in one step, and levels of any other band.
TAIL_ROWS, LEVELS = 8192, 16
#: Ids per piece of text of a digest.
PIECE = 4096
NO_IDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, h1, h2, n_bytes): the turns in order, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"), F.octet_length(text).cast("long").alias("n_bytes"))
    return running(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")], out_col="pos").drop("turn")


def paths(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, n_bytes) for every prefix of every conversation of
    ``convs`` (conv), the empty one of depth 0 included: its key, its parent's key and
    the bytes of its last text.  ``rows`` has (conv, pos, h1, h2, n_bytes)."""
    t1, t2 = F.xxhash64("pos", "h1", "h2"), F.xxhash64("h2", "pos", "h1")
    keyed = running(rows.select("conv", "pos", "n_bytes", t1.alias("t1"), t2.alias("t2")), ["conv"], [F.col("pos")],
                    xors={"k1": "t1", "k2": "t2"}, out_col="depth")
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("n_bytes"))
    return root.unionByName(keyed.select("conv", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"),
                                         F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"), "n_bytes"))


def plan_bands(lengths: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """Bands (lowest depth, highest depth, is a tail) from the deepest up.  ``lengths``
    has (turns, conversations) for every length that occurs."""
    out: list[tuple[int, int, bool]] = []
    ended = dict(lengths)
    alive, high, held = 0, max(ended, default=-1), 0
    stops = sorted(ended, reverse=True)
    d = high
    # tails: as many levels as the bound allows, found by whole runs of levels with one width
    for i, stop in enumerate(stops):
        alive += ended[stop]
        end = stops[i + 1] if i + 1 < len(stops) else -1  # levels end + 1 .. stop have `alive` rows each
        while d > end and alive <= TAIL_ROWS:
            take = min(d - end, (TAIL_ROWS - held) // alive)
            d, held = d - take, held + take * alive
            if d > end:
                out.append((d + 1, high, True))
                high, held = d, 0
        if alive > TAIL_ROWS:
            break
    if d < high:
        out.append((d + 1, high, True))
    while d >= 0:
        out.append((max(0, d - LEVELS + 1), d, False))
        d -= LEVELS
    return out


def _segments(prefixes: DataFrame, bands: list[tuple[int, int, bool]]) -> DataFrame:
    """(band, conv, anchor, path, end): a conversation's path in each band (named by its
    lowest depth), the key above it, and the path's last depth."""
    table = prefixes.sparkSession.createDataFrame([(lo, hi) for lo, hi, _ in bands], "band long, high long")
    levels = table.select("band", F.explode(F.sequence("band", "high")).alias("depth"))
    return prefixes.join(levels, "depth").groupBy("band", "conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "k1", "k2", "n_bytes"))).alias("path"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("anchor"), F.max("depth").alias("end"))


SUMS = "conv long, n_convs long, n_children long, n_leaves long, saved long"


def _dense(rows: DataFrame, low: int, high: int) -> list[DataFrame]:
    """Node tables of the levels high ... low.  ``rows`` has (depth, anchor, path) and the
    sums of what was merged so far: surviving nodes stripped to ``high`` and
    conversations that end in the band."""
    out = []
    rest, moving = rows.where(F.col("depth") < high), rows.where(F.col("depth") == high)
    for d in range(high, low - 1, -1):
        last = F.element_at("path", -1)
        level = moving.groupBy("anchor", "path").agg(*(f(c).alias(c) for f, c in ((F.min, "conv"), (F.sum, "n_convs"), (F.sum, "n_children"),
                                                                             (F.sum, "n_leaves"), (F.sum, "saved"))))
        level = materialize(level.withColumns({
            "n_leaves": F.greatest("n_leaves", F.lit(1)), "saved": F.col("saved") + (F.col("n_convs") - 1) * last["n_bytes"]}))
        above = F.when(F.size("path") > 1, F.struct(F.element_at("path", -2)["k1"].alias("p1"), F.element_at("path", -2)["k2"].alias("p2"))).otherwise(F.col("anchor")) \
            if d > low else F.col("anchor")
        out.append(level.select(F.lit(d).cast("long").alias("depth"), last["k1"].alias("k1"), last["k2"].alias("k2"), above["p1"].alias("p1"),
                                above["p2"].alias("p2"), "conv", "n_convs", "n_children", "n_leaves", "saved"))
        if d > low:
            stripped = level.select("anchor", F.slice("path", 1, F.size("path") - 1).alias("path"), "conv", "n_convs",
                                    F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")
            moving = stripped.unionByName(rest.where(F.col("depth") == d - 1).drop("depth"))
    return out


def _peel(group: pa.Table) -> pa.Table:
    """All nodes of a tail band below one prefix, level by level from the deepest."""
    waiting: dict[int, list] = {}
    for r in group.to_pylist():
        keys = [(r["anchor"]["p1"], r["anchor"]["p2"])] + [(x["k1"], x["k2"]) for x in r["path"]]
        waiting.setdefault(r["depth"], []).append((keys, [x["n_bytes"] for x in r["path"]], r["conv"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"]))
    out, moving, d = [], [], max(waiting)
    low = d - len(waiting[d][0][0]) + 2
    while d >= low:
        level: dict[tuple, list] = {}
        at = d - low + 1  # of the level's key in a path
        for keys, sizes, conv, n, children, leaves, saved in moving + waiting.pop(d, []):
            node = level.get(keys[at])
            if node is None:
                level[keys[at]] = [keys, sizes, conv, n, children, leaves, saved]
            else:
                node[2] = min(node[2], conv)
                for i, x in enumerate((n, children, leaves, saved), 3):
                    node[i] += x
        moving = []
        for keys, sizes, conv, n, children, leaves, saved in level.values():
            leaves, saved = max(leaves, 1), saved + (n - 1) * sizes[at - 1]
            out.append((d, *keys[at], *keys[at - 1], conv, n, children, leaves, saved))
            moving.append((keys, sizes, conv, n, 1, leaves, saved))
        d -= 1
    names = ["depth", "k1", "k2", "p1", "p2", "conv", "n_convs", "n_children", "n_leaves", "saved"]
    return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names=names)


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of (depth, k1, k2, conv)."""
    node = ["depth", "k1", "k2"]

    def render(batches):
        def piece(key, ids):
            return (*key, ids[0], ",".join(map(str, ids)))

        key, held = None, []
        for batch in batches:
            out = []
            for *now, conv in zip(*(batch.column(c).to_pylist() for c in (*node, "conv")), strict=True):
                if now != key or len(held) >= PIECE:
                    if held:
                        out.append(piece(key, held))
                    key, held = now, []
                held.append(conv)
            if out:
                yield pieces(out)
        if held:
            yield pieces([piece(key, held)])

    def pieces(rows):
        return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int64()) for i in range(4)), pa.array([r[4] for r in rows])],
                                          names=[*node, "first", "ids"])

    def digest(batches):
        def result(rows):
            return pa.RecordBatch.from_arrays([*(pa.array([r[0][i] for r in rows], pa.int64()) for i in range(3)), pa.array([r[1].hexdigest() for r in rows])],
                                              names=[*node, "ends_sha256"])

        key, state = None, None
        for batch in batches:
            out = []
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*node, "ids")), strict=True):
                if now == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((key, state))
                    key, state = now, hashlib.sha256(ids.encode())
            if out:
                yield result(out)
        if key is not None:
            yield result([(key, state)])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = ends.repartitionByRange(n, *node, "conv").sortWithinPartitions(*node, "conv").mapInArrow(render, "depth long, k1 long, k2 long, first long, ids string")
    return text.repartition(n, *node).sortWithinPartitions(*node, "first").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


@tidy
def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations ``convs`` (conv), whose turns are ``rows``
    (conv, pos, h1, h2, n_bytes); conversations without turns end at the root.

    conv_id: the smallest member (conversation that starts with the node's turns); depth;
    parent_conv_id: the parent's smallest member; n_convs: members; n_children; n_leaves:
    childless nodes of the subtree; saved_tokens: over the subtree, each node's
    (n_convs - 1) times the bytes of its last text; ends_sha256: of the ids of the
    members that end here, ascending and joined by commas."""
    spark = convs.sparkSession
    prefixes = materialize(paths(convs, rows))
    ends = materialize(prefixes.groupBy("conv").agg(F.max(F.struct("depth", "k1", "k2")).alias("e")).select("conv", "e.*"))
    lengths = [(r["depth"], r["n"]) for r in ends.groupBy("depth").agg(F.count("*").alias("n")).collect()]  # a row per length
    bands = plan_bands(lengths)
    if not bands:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    segments = materialize(_segments(prefixes, bands).repartitionByRange("band", "conv"))
    lasting = ends.select("conv", F.col("depth").alias("length"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    nodes: list[DataFrame] = []
    above = None  # nodes of the level just below the band, to be stripped
    for low, high, tail in bands:
        here = segments.where(F.col("band") == low)
        path = F.transform("path", lambda x: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["n_bytes"].alias("n_bytes")))
        here = here.select("conv", "anchor", path.alias("path"), F.col("end").alias("depth"))
        new = (here.join(lasting, "conv").where("depth = length")
               .select("depth", "anchor", "path", "conv", one.alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved")))
        if above is not None:
            old = (above.drop("depth").join(here, "conv").select("depth", "anchor", "path", "conv", "n_convs", one.alias("n_children"), "n_leaves", "saved"))
            new = new.unionByName(old)
        if tail:
            found = [materialize(new.groupBy("anchor").applyInArrow(_peel, "depth long, k1 long, k2 long, p1 long, p2 long, " + SUMS))]
            above = found[0].where(F.col("depth") == low)
        else:
            found = _dense(materialize(new), low, high)
            above = found[-1]
        nodes += found
    every = materialize(reduce(DataFrame.unionByName, nodes))
    parents = every.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    keyed = every.join(_digests(ends.select("depth", "k1", "k2", "conv")), ["depth", "k1", "k2"], "left")
    return keyed.join(parents, ["depth", "p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def rebuilt(conversations: DataFrame, share: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(convs, rows) for ``trie``: every conversation c begins with the first h turns of
    conversation c - c % ``share`` (all if it has fewer, none if there is none), followed by
    its own turns after its first h; h = crc32(c as text) % ``most``."""
    every = turns(conversations)
    lengths = every.groupBy("conv").agg(F.count("*").alias("n"))
    base, h = F.col("conv") - F.col("conv") % share, F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = materialize(lengths.select("conv", base.alias("base"), h.alias("h")).join(
        lengths.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
        .select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")))
    own = (every.join(convs.select("conv", "h", "taken"), "conv").where("pos > h")
           .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "n_bytes"))
    first = every.where((F.col("pos") < most) & (F.col("conv") % share == 0)).withColumnRenamed("conv", "base")
    shared = (convs.where("taken > 0").select("conv", "base", "taken").join(first, "base").where("pos <= taken")
              .select("conv", "pos", "h1", "h2", "n_bytes"))
    return convs.select("conv"), own.unionByName(shared)
