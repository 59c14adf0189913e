"""Near duplicates by similarity sketches against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.llm import minhash, ngram_join
from cellspark.llm._text import mix

from .helpers import components
from .test_ngram_join import _rows


def _expected(rows, k, num, den):
    return [(i, n, c, i is not None and i == c) for i, n, c in components(rows, k, num, den)]


def _got(df, **kw):
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, **kw).collect()]


@pytest.mark.parametrize(("k", "num", "den"), [(4, 8, 10), (5, 8, 10), (2, 9, 10)])
def test_components_equal_all_pairs(spark, k, num, den):
    rows = _rows(20 + k)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(_got(df, k=k, num=num, den=den)) == set(_expected(rows, k, num, den))


def test_large_family_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    monkeypatch.setattr(ngram_join, "PARTNERS", 4)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(80)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(_got(df)) == set(_expected(rows, 4, 8, 10))


def test_blocks_and_pairs_bring_few_rows(spark, monkeypatch):
    rng = random.Random(9)
    rows = []  # texts that share bands with one hub, most of them too unlike to link
    for i in range(60):
        w = [f"b{j}" for j in range(120)]
        at = rng.randrange(120)
        for j in range(rng.randint(8, 14)):
            w[(at + 3 * j) % 120] = f"x{rng.randrange(500)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    real = minhash._segments

    def segments(*args):
        found = real(*args)
        seen.append((args[-1], found.groupBy("sid").count().agg(F.max("count")).first()[0]))
        return found

    monkeypatch.setattr(minhash, "_segments", segments)
    assert set(_got(df)) == set(_expected(rows, 4, 8, 10))
    assert seen and max(most or 0 for _, most in seen) <= 2  # rows of a set, for each of its pairs
    profile = minhash._profiles(df.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("text_key")), 4)
    part = [len(r.sketch) / r.n for r in profile.collect()]
    assert 0.4 < sum(part) / len(part) < 0.6


def test_edge_cases(spark):
    long = " ".join(f"w{i % 5003}x{i % 7}" for i in range(250_000))  # over a MiB, cut while hashing
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(None, text), (None, text + " end"), (3, text), (3, text), (2, text + " tail"), (None, None), (None, "a b"), (7, "A B"), (8, ""), (9, " \t\n\x0b "),
            (10, long), (11, long + " more"), (12, "one"), (13, "x" * 2_000_000)]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, sid string, bands string")
    assert sorted(_got(df), key=str) == sorted(_expected(rows, 4, 8, 10), key=str)
    assert minhash.near_duplicates(df.limit(0)).collect() == []
    only_null = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert sorted(_got(only_null)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_every_coordinate_fills_and_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    sets = [mix(rng.integers(0, 1 << 60, n, dtype=np.uint64)) for n in (1, 2, 7, 100, 5000)]
    out = minhash.sketches(sets)
    assert out.shape == (5, minhash.T) and (out != np.uint64((1 << 64) - 1)).all()
    for shared in (50, 200, 450):  # of sets of 500
        error = []
        for _ in range(60):
            x = mix(rng.integers(0, 1 << 60, 1000 - shared, dtype=np.uint64))
            a, b = minhash.sketches([x[:500], x[500 - shared:]])
            error.append((a == b).mean() - shared / (1000 - shared))
        assert abs(np.mean(error)) < 0.03
        s = shared / (1000 - shared)
        assert np.std(error) < 1.3 * (s * (1 - s) / minhash.T) ** 0.5  # no wider than independent hashes


def test_sketches_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 60, n, dtype=np.uint64) for n in (3, 300, 30)]
    together = minhash.sketches(sets)
    assert all((minhash.sketches([s])[0] == r).all() for s, r in zip(sets, together, strict=True))


def test_a_large_family_is_placed_once_and_segments_move_once(spark):
    rows = [(1, 50, b, 50) for b in range(2, 1002)]  # partners of one hub, none of them linked with it
    pairs = spark.createDataFrame(rows, "a long, na int, b long, nb int")
    comps = spark.createDataFrame([(b, 2 + b // 4) for b in range(2, 1002)], "node long, comp long")
    placed = ngram_join._blocks(pairs, comps)
    assert placed.count() == 1000 and placed.select("b").distinct().count() == 1000
    segments = spark.createDataFrame([(i, f, [i, i + 1, 7 + f]) for i in range(1, 1002) for f in range(2)], "sid long, frag int, seg array<long>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join._overlaps(pairs, segments)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan  # the segments themselves are not shuffled for the pairs
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("whole", [True, False])
def test_block_decides_as_sets_do(whole):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 40)
    sets = [np.unique(np.where(rng.random(40) < rng.random() * 0.4, rng.integers(0, 1 << 60, 40), base)) for _ in range(600)]
    half = [s if whole else s[s < 1 << 59] for s in sets]
    table = pa.table({"b": pa.array(range(600), pa.int64()), "n": pa.array([len(s) for s in sets], pa.int32()),
                      "comp": pa.array([i // 2 for i in range(600)], pa.int64()), "side": pa.array([i % 2 for i in range(600)], pa.int32()),
                      "seg": pa.array([s.tolist() for s in half], pa.list_(pa.int64()))})
    b, comp, first, ask = ngram_join._read_block(table, 8, 10, whole)
    assert b.tolist() == list(range(600)) and first.tolist() == b.tolist() and (comp == b // 2).all()
    for i in rng.integers(0, 600, 60):
        for j in range(600):
            n, o = len(sets[i]) + len(sets[j]), len(np.intersect1d(half[i], half[j]))
            size = min(len(sets[i]), len(sets[j])) * 10 >= max(len(sets[i]), len(sets[j])) * 8
            close = 18 * o >= 8 * n if whole else (len(half[i]) + len(half[j]) - 2 * o) * 18 <= n * 2
            assert ask[i, j] == (i // 2 != j // 2 and i % 2 < j % 2 and size and close)
