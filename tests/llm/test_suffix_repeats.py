"""Suffix-array removal of repeats against counting all windows."""

import random

import pytest

from cellspark.llm import suffix_repeats as sr

from .helpers import without_repeats


def _rows(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passage = text(300)
    rows = []
    for i in range(60):
        t = text(rng.randint(0, 200))
        if rng.random() < 0.6:
            a = rng.randint(0, 150)
            t += passage[a:a + rng.randint(20, 200)] + text(rng.randint(0, 50))
        if rng.random() < 0.2:
            t += t[:80]
        rows.append((i, t))
    return rows + [(60, None), (61, ""), (62, rows[3][1]), (62, rows[3][1]), (None, rows[5][1]), (64, "z" * 300), (65, "zy" * 90)]


@pytest.mark.parametrize("group", [512, 3])
def test_equals_window_counts(spark, monkeypatch, group):
    """Also with groups so small that pieces are cut down to single windows."""
    monkeypatch.setattr(sr, "GROUP", group)
    monkeypatch.setattr(sr, "LEVELS", (16, 4, 1))
    monkeypatch.setattr(sr, "_CHUNK", 64)
    rows = _rows(group)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sr.remove_repeats(df.selectExpr("*", "1 AS start", "'q' AS key"), min_len=40, anchor=10)
    assert out.columns[:4] == ["doc_id", "text", "start", "key"]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()), key=str)
    assert got == sorted(without_repeats(rows, 40), key=str)


def test_empty_table(spark):
    assert sr.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _brute_maximal(texts, size):
    """Maximal repeats by extending every window in both directions."""
    out = set()
    places = {}
    for k, t in enumerate(texts):
        for i in range(len(t)):
            for j in range(i + size, len(t) + 1):
                places.setdefault(t[i:j], set()).add((k, i))
    for s, where in places.items():
        if len(where) < 2:
            continue
        before = {texts[k][i - 1] if i else -1 - k for k, i in where}
        after = {texts[k][i + len(s)] if i + len(s) < len(texts[k]) else -1 - k for k, i in where}
        if len(before) > 1 and len(after) > 1:
            out.add((len(s), frozenset(where)))
    return out


def test_interval_tree_reports_all_maximal_repeats():
    rng = random.Random(2)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 4))]
        got = {(n, frozenset(p)) for n, p in sr.maximal_repeats(texts, 3)}
        # occurrences that end a text share an end; compare those that differ in their next byte
        assert {g for g in got} >= _brute_maximal(texts, 3)


def test_figures_of_byte_strings_beside_a_text_without_word_passages(spark):
    """count_words=False: the figures of 400-byte strings, the text also without passages of 51 short words."""
    rng = random.Random(7)
    prose = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.randrange(10 ** 4)}" for _ in range(n))
    short, long = " ".join(f"{rng.choice('xyz')}{rng.randrange(10)}" for _ in range(55)), prose(120)
    rows = [(i, f"{prose(20)} {short if i % 2 else long} {prose(20)}") for i in range(8)] + [(8, None), (9, prose(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sr.remove_repeats(df, min_words=51, count_words=False).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == sorted(without_repeats(rows, 400), key=str)
    kept = {r.doc_id: r.text for r in out}
    assert all(short not in kept[i] and len(kept[i].split()) == 40 for i in range(1, 8, 2))
    assert all(len(kept[i]) < 300 for i in range(0, 8, 2)) and kept[8] is None and kept[9] == rows[9][1]
