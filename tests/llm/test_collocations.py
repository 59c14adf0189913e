"""Phrase collocations against plain counting."""

import collections
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from cellspark.llm import collocations

from .helpers import LOWER


def brute(rows, max_words, min_count, top=2000):
    count, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, max_words + 1):
                count.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    frequent = {k: f for k, f in count.items() if f >= min_count}
    scored = collections.defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        if any(g >= a and other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for (other, q), g in frequent.items()):
            continue
        s, k = min((1000 * a * total[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p)))
        scored[lang].append((s, a, " ".join(p), count[lang, p[:k]], count[lang, p[k:]]))
    out = set()
    for lang, found in scored.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out |= {(lang, i, p, a, left, right, total[lang], s) for i, (s, a, p, left, right) in enumerate(found[:top], 1)}
    return out


def _rows(seed, n=60):
    rng = random.Random(seed)
    fixed = ["New York city", "in spite of", "one two three four five six", "ça va bien"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice("abcdefgh") * rng.randint(1, 2))
            parts.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ", " "]))
        rows.append((rng.choice(["en", "fr", None, "und"]), "".join(parts)))
    return rows


def _got(df, **kw):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, **kw).collect()}


@pytest.mark.parametrize(("head", "block", "top"), [(1 << 17, 1 << 18, 2000), (0, 60, 2000), (1 << 17, 30, 3)])
def test_phrases_equal_plain_counting(spark, monkeypatch, head, block, top):
    """Also with ids looked up by joins, and with blocks that end within texts."""
    monkeypatch.setattr(collocations, "HEAD", head)
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = _rows(block) + [("en", " ".join("pqrs"[i % 4] for i in range(400)))]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, 5, 4, top)
    assert len(want) > 5
    assert _got(df, max_words=5, min_count=4, top=top) == want


def test_edge_cases(spark):
    long = "alpha beta gamma " * 120_000  # over a MiB, cut while tokenising
    rows = [(None, None), ("en", ""), (None, "\n\t ."), ("en", long), ("en", long), ("fr", "x" * 1_200_000), ("de", "A a A a A a"), ("de", "A a A a A a"), (None, "und a b"), ("und", "UND a b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, score int, block string")
    want = brute(rows[:3] + rows[5:], 3, 2) | brute([("en", long), ("en", long)], 3, 2)
    assert _got(df, max_words=3, min_count=2) == want
    assert _got(df.limit(0)) == set()
    assert _got(df, max_words=3, min_count=10 ** 9) == set()


def test_scores_beyond_64_bits(spark):
    """Products of counts pass 64 bits; the division stays exact."""
    a, n, left, right = 3_000_000_007, 9_000_000_000_000_011, 5_000_000_021, 7_000_000_033
    row = spark.range(1).selectExpr(f"(cast(1000 as decimal(38,0)) * cast({a} as decimal(38,0)) * cast({n} as decimal(38,0))) div "
                                    f"(cast({left} as decimal(38,0)) * cast({right} as decimal(38,0))) as s").first()
    assert row.s == 1000 * a * n // (left * right)


def test_tiles_equal_a_counter():
    rng = np.random.default_rng(4)
    t = collocations.TILE
    for n, most in ((0, 5), (10, 5), (200_000, 300), (100_000, 5000), (100_000, 400_000)):
        a, b = (np.minimum(rng.zipf(1.3, n), most).astype(np.int64) - 1 for _ in range(2))
        side = most // t + 1
        got, rows = {}, 0
        for cell, count in collocations.tile_counts(a, b, side):
            assert (np.diff(cell) > 0).all()
            for row in collocations._stripes(cell, count):
                rows += 1
                for c, f in zip(*collocations._summed(*[[x] for x in collocations._cells(*row)]), strict=True):
                    tile, p = divmod(int(c), t * t)
                    got[tile // side * t + p // t, tile % side * t + p % t] = int(f)
        assert got == dict(collections.Counter(zip(a.tolist(), b.tolist(), strict=True)))
        assert rows <= max(1, len(got))


def test_compact_keeps_all_pairs():
    rng = random.Random(2)
    for _ in range(300):
        x = np.array([rng.choice([-1, -1, 1, 2]) for _ in range(rng.randint(1, 14))], np.int64)
        owned = rng.randint(0, len(x))
        y, own = collocations.compact(x, owned)
        pairs = lambda z, k: [(a, b) for i, (a, b) in enumerate(zip(z[:-1], z[1:], strict=True)) if i < k and a >= 0 and b >= 0]
        assert pairs(x.tolist(), owned) == pairs(y.tolist(), own)
        assert pairs(x.tolist(), 99) == pairs(y.tolist(), 99)


def test_readers_hold_few_blocks(spark, monkeypatch):
    """Row groups of written blocks hold a few blocks, whatever a task's share of the texts is, and
    codes are bytes, which are read without a level per place."""
    monkeypatch.setattr(collocations, "BLOCK", 1 << 12)
    monkeypatch.setattr(collocations, "GROUP_BYTES", 1 << 16)
    rng = random.Random(8)
    rows = [("en", " ".join(rng.choices([f"w{i}" for i in range(600)], k=3000))) for _ in range(120)]
    tables, real = [], collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, *a: tables.append(real(df, *a)) or tables[-1])
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found = [tuple(r) for r in collocations.phrases(df, max_words=3, min_count=2)[0].select("phrase", "a").collect()]
    assert len(found) > 600
    seen = 0
    for t in tables:
        if "codes" in t.columns:
            assert dict(t.dtypes)["codes"] == "binary"
            for f in t.inputFiles():
                meta = pq.ParquetFile(f.removeprefix("file:")).metadata
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                assert all(g.num_rows <= 12 for g in groups), [g.num_rows for g in groups]
                seen += len(groups)
    assert seen >= 20
