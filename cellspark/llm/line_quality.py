"""Quality rules by line sequence labelling.

A text's lines (cut at \\n) are a sequence; a linear-chain conditional random
field marks each as content or boilerplate by Viterbi decoding, and the share of
words that stand in content lines decides whether the text is kept.  Two plain
rules reject a text beforehand: fewer than 20 words, or more than 30 % of its
words in 8-word windows that occur twice or more in it.

The field's states are boilerplate (0) and content (1).  A line is described by
a few yes/no features, packed into one small number; its emission scores, the
transition scores and the start scores are learned by maximum likelihood from the
lines of a bounded sample of labelled texts, where a line's state is the quality
label of its text (lines are not labelled one by one).

Defined results: a null or blank text has no words and fails the base rules; a
line without words takes its state from its neighbours; a text whose lines hold
no words has content share 0; without labelled texts ``train`` returns weights of
zero with a start score for content, which keeps what the base rules keep; other
columns pass through, result columns replace columns of their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import sampled
from ._text import mix, word_hashes

#: About so many labelled texts, of at most so many characters each, are used to fit the field.
SAMPLE_TEXTS, SAMPLE_CHARS = 4000, 20_000
#: Bits of a line's features.
N_FEATURES = 11
#: Base rules: least words, largest percentage of words in repeated windows, window length.
MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
_NO_SYMBOLS = str.maketrans("", "", SYMBOLS)


def line_code(line: str, seen: set[str]) -> tuple[int, int]:
    """Features of a line as bits, and its number of words; remembers the line."""
    words = line.split()
    n = len(words)
    if not n:
        return 0, 0
    size = len(line)
    symbols = size - len(line.translate(_NO_SYMBOLS))
    distinct = len(set(words))
    code = 1
    if n <= 2:
        code |= 2
    if n >= 8:
        code |= 4
    if symbols * 50 > size:
        code |= 8
    if symbols * 12 > size:
        code |= 16
    if "!!" in line:
        code |= 32
    if line.isupper() and size > 3:
        code |= 64
    if line in seen:
        code |= 128
    if n >= 4 and distinct * 10 < n * 6:
        code |= 256
    if n >= 8 and distinct * 10 < n * 3:
        code |= 512
    if line.rstrip().endswith((".", "!", "?", "…", "。")):
        code |= 1024
    seen.add(line)
    return code, n


def line_codes(text: str) -> tuple[list[int], list[int]]:
    seen: set[str] = set()
    codes, words = [], []
    for line in text.split("\n"):
        c, n = line_code(line, seen)
        codes.append(c)
        words.append(n)
    return codes, words


# ---- the field -------------------------------------------------------------

def emissions(weights: np.ndarray) -> np.ndarray:
    """Scores (2 ** N_FEATURES, 2) of every feature pattern."""
    bits = (np.arange(1 << N_FEATURES)[:, None] >> np.arange(N_FEATURES)[None, :]) & 1
    return bits @ weights


def fit(sequences: list[list[int]], states: list[int], rounds: int = 120, rate: float = 0.2, l2: float = 1e-3) -> dict:
    """Maximum likelihood by gradient ascent (Adam); all lines of sequence i have
    the state states[i].  Sequences are padded into one array and the forward and
    backward recursions run over all of them at once."""
    model = {"emit": np.zeros((N_FEATURES, 2)), "move": np.zeros((2, 2)), "start": np.zeros(2)}
    if not sequences or len(set(states)) < 2:
        model["start"][1] = 1.0
        return model
    sizes = np.array([len(s) for s in sequences])
    by = np.argsort(-sizes, kind="stable")
    sizes, y = sizes[by], np.array(states)[by]
    longest = int(sizes[0])
    x = np.zeros((len(by), longest), np.int64)
    for row, i in enumerate(by):
        x[row, :sizes[row]] = sequences[i]
    alive = [int((sizes > t).sum()) for t in range(longest)]  # sequences that reach step t come first
    bits = ((np.arange(1 << N_FEATURES)[:, None] >> np.arange(N_FEATURES)[None, :]) & 1).astype(float)
    lines = sizes.sum()
    balance = np.where(y == 1, 0.5 / max(1, sizes[y == 1].sum()), 0.5 / max(1, sizes[y == 0].sum())) * lines
    # what the labels say
    seen = {"emit": np.zeros((1 << N_FEATURES, 2)), "move": np.zeros((2, 2)), "start": np.zeros(2)}
    for state in (0, 1):
        rows = np.flatnonzero(y == state)
        for row in rows:
            np.add.at(seen["emit"][:, state], x[row, :sizes[row]], balance[row])
        seen["move"][state, state] = ((sizes[rows] - 1) * balance[rows]).sum()
        seen["start"][state] = balance[rows].sum()
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    for t in range(1, rounds + 1):
        score = bits @ model["emit"]
        e = score[x]
        a = np.zeros((len(by), longest, 2))
        b = np.zeros((len(by), longest, 2))
        a[:, 0] = model["start"] + e[:, 0]
        for i in range(1, longest):
            n = alive[i]
            a[:n, i] = np.logaddexp(a[:n, i - 1, :1] + model["move"][0], a[:n, i - 1, 1:] + model["move"][1]) + e[:n, i]
        for i in range(longest - 2, -1, -1):
            n = alive[i + 1]
            z = b[:n, i + 1] + e[:n, i + 1]
            b[:n, i] = np.logaddexp(model["move"][:, 0] + z[:, :1], model["move"][:, 1] + z[:, 1:])
        total = np.logaddexp(*a[np.arange(len(by)), sizes - 1].T)
        want = {"emit": np.zeros((1 << N_FEATURES, 2)), "move": np.zeros((2, 2)), "start": np.zeros(2)}
        for i in range(longest):
            n = alive[i]
            p = np.exp(a[:n, i] + b[:n, i] - total[:n, None]) * balance[:n, None]
            np.add.at(want["emit"], x[:n, i], p)
            if i == 0:
                want["start"] = p.sum(axis=0)
            else:
                pair = a[:n, i - 1, :, None] + model["move"] + (e[:n, i] + b[:n, i])[:, None, :]
                want["move"] += (np.exp(pair - total[:n, None, None]) * balance[:n, None, None]).sum(axis=0)
        slope = {"emit": bits.T @ (seen["emit"] - want["emit"]), "move": seen["move"] - want["move"], "start": seen["start"] - want["start"]}
        for k in model:
            g = slope[k] / lines - l2 * model[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model[k] = model[k] + rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return model


def viterbi(codes: list[int], words: list[int], score: list, move, start) -> list[int]:
    """Most likely states of a sequence; lines without words add no score."""
    a, b = start
    back = []
    (m00, m01), (m10, m11) = move
    opened = False
    for c, n in zip(codes, words, strict=True):
        if n:
            e0, e1 = score[c]
        else:
            e0 = e1 = 0.0
        if opened:
            if n:
                x0, y0, x1, y1 = a + m00, b + m10, a + m01, b + m11
                back.append((0 if x0 >= y0 else 1, 0 if x1 > y1 else 1))
                a, b = max(x0, y0) + e0, max(x1, y1) + e1
            else:
                back.append((0, 1))
        else:
            a, b = a + e0, b + e1
            opened = True
    state = 1 if b >= a else 0
    out = [state]
    for p in reversed(back):
        state = p[state]
        out.append(state)
    out.reverse()
    return out


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\x0b\x0c\r"):
            seen.add(line)
    w = word_hashes(text, lower=False)
    n, repeated = len(w), 0
    m = n - WINDOW + 1
    if m > 1:
        x = np.zeros(m, np.uint64)
        for j in range(WINDOW):
            x = mix(x + w[j:m + j])
        _, at, times = np.unique(x, return_inverse=True, return_counts=True)
        twice = times[at] > 1
        if twice.any():
            cover = np.zeros(n + 1, np.int64)
            hits = np.flatnonzero(twice)
            np.add.at(cover, hits, 1)
            np.add.at(cover, hits + WINDOW, -1)
            repeated = int((np.cumsum(cover)[:n] > 0).sum())
    return n, chars, symbols, dup, repeated


# ---- Spark -----------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict:
    """Fit the field on about ``texts`` labelled texts at most, half of each label,
    chosen by the hash of their id (a bounded, documented sample; only line
    feature codes come to the driver)."""

    @F.arrow_udf("array<int>")
    def coded(column: pa.Array) -> pa.Array:
        return pa.array([line_codes(t.as_py() or "")[0] for t in column], pa.list_(pa.int32()))

    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("label"))
    docs = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    rows = []
    for label in (0, 1):
        part = sampled(docs, known.where(F.col("label") == label), id_col, texts // 2).where(F.length("text").between(1, chars))
        found = part.select(F.xxhash64(id_col, "text").alias("h"), coded("text").alias("codes")).collect()
        rows += [(label, r["codes"]) for r in sorted(found, key=lambda r: (r["h"], r["codes"]))]
    keep = [(y, [c for c in codes if c]) for y, codes in rows]
    keep = [(y, codes) for y, codes in keep if codes]
    return fit([codes for _, codes in keep], [y for y, _ in keep])


def label_lines(docs: DataFrame, model: dict, text_col: str = "text", min_share: float = 0.5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, content_share (words in content lines by words) and kept."""
    score = emissions(model["emit"]).tolist()
    move, start = model["move"].tolist(), model["start"].tolist()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
                 "base_failed:boolean,content_share:double,kept:boolean>")
    def judged(column: pa.Array) -> pa.Array:
        out = []
        for t in column:
            text = t.as_py() or ""
            counts = base_counts(text)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEATED * counts[0]
            codes, words = line_codes(text)
            states = viterbi(codes, words, score, move, start)
            share = sum(n for n, s in zip(words, states, strict=True) if s) / (sum(words) or 1)
            out.append(dict(zip(names, counts, strict=True)) | {"base_failed": failed, "content_share": share, "kept": not failed and share >= min_share})
        return pa.array(out, pa.struct([(n, pa.int64()) for n in names] + [
            ("base_failed", pa.bool_()), ("content_share", pa.float64()), ("kept", pa.bool_())]))

    rows = docs.withColumn("_judged", judged(F.col(text_col).cast("string")))
    return rows.withColumns({n: F.col(f"_judged.{n}") for n in [*names, "base_failed", "content_share", "kept"]}).drop("_judged")
