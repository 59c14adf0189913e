"""Quality scores by positive-unlabelled learning.

Trusted positives are texts labelled good; everything else is unlabelled, a mixture
of good and bad in unknown proportion.  The score is a logistic function of binned
shape features of the whole text and is fitted by minimising the non-negative
unbiased risk (sigmoid loss l, class prior p):

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)])

When the bracket turns negative (the model is fitting noise), its gradient is
followed backwards instead, as the non-negative estimator prescribes.

The class prior is estimated, not given: a first model tells positives from
unlabelled texts; among its highest scores, the share of unlabelled texts over the
share of positives above a threshold bounds the prior from above, and the best
threshold, with a confidence margin, gives the estimate.

Fitting uses a bounded sample of rows (SAMPLE_POSITIVES and SAMPLE_UNLABELLED,
chosen by the hash of the id); only their feature vectors come to the driver.
Scoring covers every row.

Defined results: null and empty texts have all features 0 and get a score like any
other; labels other than 1 are not used; without positives or unlabelled texts every
score is the prior 0.5; result columns replace columns of their names and every
other column passes through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import sampled
from .line_quality import SYMBOLS, base_counts

#: Rows of each kind that the model is fitted on, about, at most.
SAMPLE_POSITIVES, SAMPLE_UNLABELLED = 6000, 12000
#: Most quantile bins of a feature; fewer are used on a small sample, of ROWS_A_BIN rows at least.
BINS, ROWS_A_BIN = 12, 60
FEATURES = ("log_words", "symbols", "exclaims", "upper", "digits", "pipes", "distinct", "top_word", "repeated",
            "same_lines", "word_length", "line_words", "ended", "other", "adjacent")


def features(text: str | None) -> list[float]:
    """Shape of a text: no words' identity, language or source enters."""
    text = text or ""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    _, chars, symbols, dup, repeated = base_counts(text)
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(map(str.isupper, words))
    times: dict[str, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    digits = sum(map(text.count, "0123456789"))
    ended = sum(1 for x in lines if x.rstrip().endswith((".", "!", "?")))
    return [float(np.log1p(n)), symbols / size, text.count("!") / n, upper / n, digits / size, text.count("|") / n,
            len(times) / n, max(times.values()) / n, repeated / n, dup / len(lines), chars / n, n / len(lines),
            ended / len(lines), sum(map(text.count, SYMBOLS + "=_~^@{}[]\\/")) / n, sum(map(str.__eq__, words, words[1:])) / n]


# ---- the model -------------------------------------------------------------

def _binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One column of a constant, then for each feature the thresholds it exceeds."""
    return np.concatenate([np.ones((len(x), 1))] + [x[:, [j]] > edges[j][None, :] for j in range(x.shape[1])], axis=1)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150) -> np.ndarray:
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    for t in range(1, rounds + 1):
        g = x.T @ (weight * (_sigmoid(x @ w) - y)) + 1e-3 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores that were not fitted on
    these rows: the smallest ratio of tail shares, each with a margin for its size."""
    cuts = np.unique(np.quantile(positive, np.linspace(0.02, 0.98, 97)))
    p = (positive[:, None] >= cuts[None, :]).mean(axis=0)
    u = (unlabelled[:, None] >= cuts[None, :]).mean(axis=0)
    margin = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = int(np.argmin((u + margin) / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 400, rate: float = 0.05) -> dict:
    """Model from feature rows of positives and unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        return {"edges": np.zeros((len(FEATURES), 1)), "weights": np.zeros(1 + len(FEATURES)), "prior": 0.5}
    both = np.concatenate([positive, unlabelled])
    bins = int(np.clip(len(both) // ROWS_A_BIN, 5, BINS))
    edges = np.quantile(both, np.linspace(0, 1, bins + 1)[:-1], axis=0).T
    # rare extremes need their own thresholds: what few texts have is what tells bad ones
    far = np.quantile(both, [0.97, 0.99], axis=0).T
    edges = np.concatenate([edges, far], axis=1)
    xp, xu = _binned(positive, edges), _binned(unlabelled, edges)
    half_p, half_u = np.arange(len(xp)) % 2 == 0, np.arange(len(xu)) % 2 == 0
    if len(xp) > 3 and len(xu) > 3:
        x = np.concatenate([xp[half_p], xu[half_u]])
        y = np.concatenate([np.ones(half_p.sum()), np.zeros(half_u.sum())])
        w = _logistic(x, y, np.where(y == 1, 0.5 / half_p.sum(), 0.5 / half_u.sum()))
        prior = estimate_prior(xp[~half_p] @ w, xu[~half_u] @ w)
    else:
        prior = 0.5
    w, m, v = (np.zeros(xp.shape[1]) for _ in range(3))
    for t in range(1, rounds + 1):
        gp, gu = xp @ w, xu @ w
        sp, su = _sigmoid(gp), _sigmoid(gu)  # loss of -g on a row is sigmoid(g)
        negative = su.mean() - prior * sp.mean()
        d_pos = xp.T @ (-sp * (1 - sp)) / len(xp)
        d_neg = xu.T @ (su * (1 - su)) / len(xu) - prior * (xp.T @ (sp * (1 - sp))) / len(xp)
        g = prior * d_pos + d_neg if negative >= 0 else -d_neg
        g = g + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return {"edges": edges, "weights": w, "prior": prior}


def scores(model: dict, rows: np.ndarray) -> np.ndarray:
    return _sigmoid(_binned(rows, model["edges"]) @ model["weights"])


# ---- Spark -----------------------------------------------------------------

def _sample(docs: DataFrame, ids: DataFrame, id_col: str, bound: int) -> np.ndarray:
    """Feature rows of the texts of about ``bound`` of the ids at most."""

    @F.arrow_udf("array<double>")
    def shape(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    got = sampled(docs, ids, id_col, bound).select(F.xxhash64(id_col, "text").alias("h"), shape("text").alias("x")).toArrow()
    return np.array(got.sort_by("h").column("x").to_pylist(), float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          positives: int = SAMPLE_POSITIVES, unlabelled: int = SAMPLE_UNLABELLED) -> dict:
    """Fit on rows of ``docs``: those with label 1 are the positives, those without any
    label are the unlabelled texts (all rows if every text is labelled)."""
    label = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("label"))
    docs = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    free = docs.select(id_col).join(label, id_col, "left_anti")
    if free.isEmpty():
        free = docs.select(id_col)
    return fit(_sample(docs, label.where("label = 1"), id_col, positives), _sample(docs, free, id_col, unlabelled))


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on)."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        rows = np.array([features(t.as_py()) for t in texts], float).reshape(-1, len(FEATURES))
        return pa.array(scores(model, rows), pa.float64())

    rows = docs.withColumn("score", scored(F.col(text_col).cast("string")))
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
