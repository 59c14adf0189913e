"""The prefix trie against a trie of dicts."""

import hashlib
import random
import zlib

import pytest

from cellspark.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(convs):
    """{id: turns} to the rows of all nodes."""
    members, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[:d - 1]), set()).add(tuple(turns[:d]))

    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, ())
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def _rows(seed, n=60, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(1, n):
        if c % 10 == 4:
            continue
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "same", "x" * 40])))
    return rows


def _got(df):
    found = prefix_trie.trie(*prefix_trie.rebuilt(df))
    assert set(COLUMNS) <= set(found.columns)
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=str)


@pytest.mark.parametrize(("tail", "levels"), [(8192, 16), (40, 3), (0, 2)])
def test_nodes_equal_a_trie_of_dicts(spark, monkeypatch, tail, levels):
    monkeypatch.setattr(prefix_trie, "TAIL_ROWS", tail)
    monkeypatch.setattr(prefix_trie, "LEVELS", levels)
    rows = _rows(tail, longest=9) + [(100, t, "user", f"line {t}") for t in range(25 if tail else 12)] + [(101, t, "user", f"line {t}") for t in range(12)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _got(df) == trie(rebuilt(rows))


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = [(5, 1, None, None), (5, None, "user", "first"), (6, 0, "", ""), (7, 0, "user", "z" * 1_500_000), (7, 1, "user", "same"), (7, 2, "user", "same"),
            (-3, 0, "user", "negative"), (0, 0, "user", "zero"), (None, 0, "user", "nobody"), (None, None, None, None)]
    rows += [(c, t, "user", "copy") for c in range(1000, 1040) for t in range(10)]  # copies that end at few nodes
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, k1 string")
    assert _got(df) == [r for r in trie(rebuilt_sql(rows))]
    assert _got(df.limit(0)) == []
    assert _got(df.where("conv_id IS NULL")) == []


def rebuilt_sql(rows):
    """As ``rebuilt``, with the remainder of SQL for negative ids."""
    own = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def test_ties_and_repeated_rows(spark):
    """Turns of one number are ordered by content, so copies of a conversation agree
    whatever order their rows come in; repeated rows are turns of their own."""
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    every = prefix_trie.turns(df)
    nodes = prefix_trie.trie(every.select("conv").distinct(), every).collect()
    assert sorted((r.depth, r.n_convs, r.n_children) for r in nodes) == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 0)]


def test_bands_cover_all_levels_once():
    rng = random.Random(3)
    for _ in range(200):
        lengths = {rng.randint(0, 300): rng.choice([1, 3, 5000, 20000]) for _ in range(rng.randint(1, 12))}
        bands = prefix_trie.plan_bands(list(lengths.items()))
        levels = [d for lo, hi, _ in bands for d in range(hi, lo - 1, -1)]
        assert levels == list(range(max(lengths), -1, -1))
        for lo, hi, tail in bands:
            if tail:
                assert sum(sum(n for length, n in lengths.items() if length >= d) for d in range(lo, hi + 1)) <= prefix_trie.TAIL_ROWS
    assert prefix_trie.plan_bands([]) == []
