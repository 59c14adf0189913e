"""BPE, chat, decontamination, line quality, language, quality and licences."""

import random

import pytest
from tokenizers import Tokenizer

from cellspark.llm import bpe, chat, decontaminate, language, licenses, line_quality, quality_pu
from cellspark.llm.queries import VOCABULARY

from .helpers import base_counts, edit_distance


def _texts(seed, n=300):
    rng = random.Random(seed)
    alphabet = "aaabcehtnis     \n\t'srdé漢😀\x1c\x85 ​0123.,!?"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", None, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "x" * 3000, " " * 50, "the  end ", "don't we'll"]


def test_bpe_equals_library_and_round_trips(spark):
    library = Tokenizer.from_file(VOCABULARY)
    rows = list(enumerate(_texts(1)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ids", "text AS decoded")
    out = bpe.decode(bpe.encode(df, VOCABULARY), VOCABULARY)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for r in out.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), VOCABULARY).collect() == []
    odd = spark.createDataFrame([([564],), (None,), ([],)], "ids array<int>")  # half a character
    assert [r.decoded for r in bpe.decode(odd, VOCABULARY).collect()] == [library.decode([564], skip_special_tokens=False), "", ""]


def test_chat_reads_back(spark):
    import hashlib

    odd = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi ### x"), (1, 1, "assistant", "</turn>\\\\"), (1, 1, "assistant", "</turn>\\\\"), (2, None, None, None),
            (None, 0, "sys:tem", "<|endoftext|> é"), (-7, 0, "user", odd), (-7, 1, "assistant", odd), (3, 5, "assistant", ""), (3, 2, "user", "x" * 5000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    formatted = chat.format_turns(df, VOCABULARY)
    got = {r.conv_id: r for r in chat.digests(chat.read_turns(formatted, VOCABULARY)).collect()}
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.read_turns(chat.format_turns(df.limit(0), VOCABULARY), VOCABULARY)).collect() == []


def test_token_spans_are_prefix_sums(spark):
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(6)], "conv_id long, turn long, role string, text string")
    at = 0
    for r in sorted(chat.format_turns(df, VOCABULARY).collect(), key=lambda r: r.seq):
        assert r.token_start == at
        assert (r.loss_end > r.loss_start) == (r.seq % 2 == 1)
        assert at < r.loss_start <= r.loss_end < at + len(r.ids)
        at += len(r.ids)


def test_myers_equals_table():
    rng = random.Random(3)
    for _ in range(400):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        want, limit = edit_distance(p, t), rng.randint(0, 5)
        got = decontaminate.best_match(decontaminate.masks(p), len(p), t, limit)
        if want < len(p):
            assert (got[0] if got else None) == (want if want <= limit else None)


def test_decontamination_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"v{i:02d}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(10, 25)))) for i in range(12)] + [(12, None), (13, ""), (14, "short"), (0, None)]
    docs = []
    for i in range(80):
        w = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            item = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, 4)):
                item[rng.randrange(len(item))] = rng.choice("abz")
            w.insert(rng.randint(0, len(w)), "".join(item).title())
        docs.append((i, "  ".join(w)))
    docs += [(80, None), (81, ""), (None, items[0][1])]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)  # several blocks
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    out = decontaminate.with_matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    for r in out:
        plain = decontaminate.normalise(r.text)
        want = {}
        for i, t in items:
            t = decontaminate.normalise(t)
            if len(t) >= 30 and (e := edit_distance(t, plain)) <= int(0.06 * len(t)):
                want[i] = e
        assert {m.item_id: m.errors for m in r.matches} == want
    none = decontaminate.with_matches(df, spark.createDataFrame([], "item_id long, text string")).collect()
    assert all(r.matches == [] for r in none)


PROSE = "The quick brown fox jumps over the lazy dog near the river bank today.\nIt was a calm and sunny day for all of them here."
JUNK = "BUY!! NOW!! CHEAP!! WIN!! BUY!! ALL!! NOW!! GO!! NOW!! YES!!\nfree*** cash$$$ now%%% click&&& here### win*** big$$$ one%%% two&&&"


def test_line_quality(spark):
    texts = [(i, f"{PROSE} {i}") for i in range(40)] + [(i, f"{JUNK} {i}") for i in range(40, 60)] + [
        (60, None), (61, ""), (62, "\n\n \t"), (63, "a b c"), (64, "same words again and again here now ok\n" * 9), (None, PROSE)]
    docs = spark.createDataFrame([(*t, True) for t in texts], "doc_id long, text string, kept boolean")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(0, 60, 2)] + [(1, None)], "doc_id long, quality int")
    out = line_quality.label_lines(docs, line_quality.train(docs, labels)).collect()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.text is not None and r.text.startswith("The quick"))
    unlabelled = line_quality.train(docs, labels.limit(0))
    assert all(r.kept != r.base_failed for r in line_quality.label_lines(docs, unlabelled).collect())
    assert line_quality.label_lines(docs.limit(0), unlabelled).collect() == []


def test_viterbi_is_the_best_path():
    import itertools

    rng = random.Random(6)
    for _ in range(50):
        n = rng.randint(1, 6)
        codes, words = [rng.randrange(4) for _ in range(n)], [1] * n
        score = [[rng.uniform(-1, 1), rng.uniform(-1, 1)] for _ in range(4)]
        move, start = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)], [rng.uniform(-1, 1) for _ in range(2)]

        def total(path):
            return start[path[0]] + sum(score[c][s] for c, s in zip(codes, path, strict=True)) + sum(move[a][b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert total(line_quality.viterbi(codes, words, score, move, start)) == pytest.approx(total(best))


def test_language(spark):
    en, de = "the cat and the dog are in the house with them", "der hund und die katze sind in dem haus mit ihnen"
    rows = [(i, en, "en") for i in range(5)] + [(i, de, "de") for i in range(5, 10)] + [(10, "das haus", None), (11, None, "en"), (12, "12 ?!", "de"), (13, "", None)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, lang string, score double")
    model = language.train(docs)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (0, 7, 10, 11, 12, 13)] == ["en", "de", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    # unseen words fall back to n-grams
    fall = spark.createDataFrame([("häuser katzen",), ("cats houses with",)], "text string")
    assert [r.lang_pred for r in language.identify(fall, model).collect()] == ["de", "en"]
    none = language.train(docs.where("lang IS NULL"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []


def test_quality_pu(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        w = [rng.choice("alpha beta gamma delta omega sigma".split()) + str(rng.randrange(50)) for _ in range(rng.randint(20, 60))]
        bad = i % 4 == 0
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + ".", int(not bad)))
    rows += [(400, None, None), (401, "", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if q == 1 and i % 3 == 0], "doc_id long, quality int")
    model = quality_pu.train(docs, labels)
    assert 0.3 < model["prior"] <= 0.8  # 200 of 302 unlabelled are good
    out = {r.doc_id: r for r in quality_pu.score(docs, model).collect()}
    right = sum(out[i].predicted == q for i, _, q in rows if q is not None)
    assert right >= 0.95 * 400
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert all(r.score == 0.5 for r in quality_pu.score(docs, quality_pu.train(docs, labels.limit(0))).collect())
    assert quality_pu.score(docs.limit(0), model).collect() == []


def test_licenses_equal_brute_force(spark):
    import re

    rng = random.Random(8)

    def pairs(text):
        w = " ".join(re.findall(r"[^\W_]+", text.lower())).split()
        return set(zip(w, w[1:]))

    docs = []
    for i in range(60):
        _, text = rng.choice(licenses.TEMPLATES)
        w = text.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["the", "License", "foo"])
        docs.append((i, "Some words before it.\n" + " ".join(w) + "\n\nx"))
    docs += [(60, None), (61, ""), (62, "MIT"), (0, docs[0][1]), (None, "Released under the MIT License!")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, line int, size string")
    got = {(r.doc_id, r.line, r.template): r.dice for r in licenses.scan(df).collect()}
    want = {}
    for d, t in docs:
        for line, x in enumerate((t or "").split("\n")):
            for k, (_, template) in enumerate(licenses.TEMPLATES):
                a, b = pairs(x), pairs(template)
                if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
                    want[d, line, k] = round(2 * len(a & b) / (len(a) + len(b)), 6)
    assert got == want
    assert licenses.scan(df.limit(0)).collect() == []


def test_language_equals_brute_force_and_keeps_rare_languages(spark, monkeypatch):
    import math
    from collections import Counter

    rng = random.Random(9)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    vocabulary = {"aa": [word("abcdefgh") for _ in range(80)], "bb": [word("efghijkl") for _ in range(80)], "cc": [word("abcijklé") for _ in range(20)]}
    rows = []
    for i in range(120):
        lang = rng.choice(["aa", "aa", "aa", "bb", "bb", "cc"])
        w = [rng.choice(vocabulary[lang]) for _ in range(rng.randint(1, 30))] + [word("abcdefghijklémnopq") for _ in range(rng.randint(0, 4))]
        rows.append((i, " ".join(w), lang if i % 3 else None))
    rows += [(120, rows[0][1], None), (None, "ǅ zzz", None), (121, None, "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {n: Counter() for n in range(5)}
    for _, t, lang in rows:
        for w in (t or "").split() if lang else ():
            counts[0][w, lang] += 1
            for n in range(1, 5):
                counts[n].update((g, lang) for g in language.grams(w, n))
    totals = Counter()
    for n, c in counts.items():
        for (_, lang), k in c.items():
            totals[n, lang] += k
    langs = sorted(vocabulary)

    def vector(n, f):
        return [min(7.0, -math.log10(counts[n][f, x] / totals[n, x])) if counts[n][f, x] else 7.0 for x in langs]

    def scored(w):
        if any(counts[0][w, x] for x in langs):
            return vector(0, w)
        for n in range(4, 0, -1):
            found = [vector(n, g) for g in language.grams(w, n) if any(counts[n][g, x] for x in langs)]
            if found:
                return [sum(v) / len(found) for v in zip(*found, strict=True)]
        return [7.0] * len(langs)

    for frequent in (150_000, 20, 0):
        monkeypatch.setattr(language, "FREQUENT", frequent)
        for r in language.identify(docs, language.train(docs)).collect():
            w = (r.text or "").lower().split()
            if not w:
                assert (r.lang_pred, r.score) == ("und", 0.0)
                continue
            mean = [sum(v) / len(w) for v in zip(*map(scored, w), strict=True)]
            assert r.score == pytest.approx(1 / sum(10 ** (min(mean) - m) for m in mean), abs=1e-5)
            assert mean[langs.index(r.lang_pred)] == pytest.approx(min(mean), abs=1e-5)


def test_language_rare_beside_a_large_one(spark):
    """More words of a large language than one task could hold: a rare language's words still count."""
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(7))
    large = [" ".join(word() for _ in range(1000)) for _ in range(170)]
    rare = " ".join(word() for _ in range(40))
    rows = [(t, "aa") for t in large * 2] + [(rare, "bb")]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    assert language.identify(spark.createDataFrame([(rare,)], "text string"), model).first().lang_pred == "bb"


def test_a_word_seen_once_decides_however_large_the_corpus(spark):
    """With over 10 ** 7 words of a language, its rarest word still scores better than a word it lacks."""
    words = spark.createDataFrame([(0, "rare", "aa", 1), (0, "both", "aa", 20_000), (0, "both", "bb", 1)], "n int, feature string, lang string, count long")
    v = {r.feature: r.v for r in language._by_feature(words, {0: {"aa": 20_000_000, "bb": 1000}}, ["aa", "bb"]).collect()}
    assert v["rare"][0] < v["rare"][1]
    assert v["rare"][0] == pytest.approx(7.30103, abs=1e-5)
    assert v["both"] == pytest.approx([3.0, 3.0], abs=1e-6)


def test_short_benchmark_items_match_exactly_and_as_whole_words(spark):
    items = spark.createDataFrame([(1, "Two plus two"), (2, "pi"), (3, "..."), (4, None)], "item_id long, text string")
    texts = ["what is TWO, plus two?", "two plus twos", "two plus tw", "apian pie", "the value of pi", "pi", "", None]
    docs = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    got = {r.doc_id: [(m.item_id, m.errors, m.stop) for m in r.matches] for r in decontaminate.with_matches(docs, items).collect()}
    assert got == {0: [(1, 0, 20)], 1: [], 2: [], 3: [], 4: [(2, 0, 15)], 5: [(2, 0, 2)], 6: [], 7: []}
    assert decontaminate.with_matches(docs.limit(0), items).collect() == []
