"""N-gram Jaccard join against all pairs."""

import random

import pytest

from cellspark.llm import ngram_join

from .helpers import components


def _rows(seed, n=120, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, bases = [], []
    for i in range(n):
        kind = rng.random()
        if bases and kind < 0.5:  # near copies of few texts: families with near and far members
            w = list(rng.choice(bases[:4]))
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = w[:rng.randint(len(w) // 2, len(w))]
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(1, words * 3))]
            bases.append(w)
        rows.append((i, " ".join(w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One two"), (n + 4, "one\nTWO"), (n + 5, rows[0][1].upper())]


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 8, 10), (1, 1, 2)])
def test_components_equal_all_pairs(spark, k, num, den):
    rows = _rows(k)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, k=k, num=num, den=den).collect()}
    assert got == set(components(rows, k, num, den))


def test_large_family_in_blocks(spark, monkeypatch):
    """Families larger than a block, with members in several components."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    monkeypatch.setattr(ngram_join, "PARTNERS", 4)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(60)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
    assert got == set(components(rows, 3, 9, 10))


def test_edge_cases(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(None, text), (3, text), (3, text), (2, text + " tail"), (None, None), (7, "a b c d")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, sid string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()), key=str)
    assert got == sorted(components(rows, 3, 9, 10), key=str)
    kept = ngram_join.one_per_component(df, k=3, num=9, den=10)
    assert kept.columns == ["doc_id", "text", "n", "sid"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, text + " tail"), (7, "a b c d"), (None, None)], key=str)
    empty = df.limit(0)
    assert ngram_join.jaccard_components(empty).collect() == []
    assert ngram_join.one_per_component(empty).collect() == []


def test_unlike_texts_of_null_and_repeated_ids_stay(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(30))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("c")), (5, text("d")), (5, text("e")), (6, text("e") + " tail"), (7, text("b"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_per_component(df).collect()), key=str)
    assert kept == sorted([(None, text("a")), (7, text("b")), (None, text("c")), (5, text("d")), (5, text("e"))], key=str)
