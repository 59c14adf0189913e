"""Language identification by word-first backoff.

A text's words (lower-cased runs of letters) are scored for every language.  A word
that the model knows scores the negative logarithm of its relative frequency in
each language.  An unseen word falls back to its character 4-grams (with a blank
at both ends); if none of them is known to 3-grams, and so on down to single
characters, the first length with a known n-gram scoring the mean of those it
knows.  What a language lacks scores more than anything counted.  The language with the lowest
mean over the words wins.

Learning counts every word of every training text: words are counted per batch and
summed by Spark, n-grams are counted from the distinct words.  The model is two
written tables that hold every counted feature with its scores by language, so it
grows with the input and no language competes with another for room.  The scores of
the FREQUENT most frequent words are sent to the tasks, which add them up for each
text; the other words of a text are joined with the written scores, and words that
the model lacks are scored once each by joining their n-grams.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
texts with a null language are not learned from; without any training text every
prediction is ``und``; equal language scores go to the first name; result columns
replace columns of their names and every other column passes through.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, small_side

#: Words whose scores are sent to the tasks, and their longest; all others are joined.
FREQUENT, SENT_CHARS = 150_000, 40
#: Longest character n-gram, score of a feature that a language lacks.
LONGEST, PENALTY = 4, 7.0


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a column one after the other, and n + 1 offsets."""
    split = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\PL+")
    at = split.offsets.to_numpy().astype(np.int64)
    flat = split.flatten()
    keep = pc.not_equal(flat, "")
    ends = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    return flat.filter(keep), ends[at - at[0]]


def grams(word: str, n: int) -> list[str]:
    word = f" {word} " if n > 1 else word
    return [word[i:i + n] for i in range(len(word) - n + 1)]


def _word_counts(docs: DataFrame) -> DataFrame:
    """(n = 0, feature, lang, count) of the words of (text, lang) rows."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                flat, ends = words_of(part.column("text"))
                if not len(flat):
                    continue
                names = part.column("lang").dictionary_encode()
                lang = np.repeat(names.indices.to_numpy(zero_copy_only=False), np.diff(ends)).astype(np.int64)
                flat = flat.dictionary_encode()
                key, count = np.unique(flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(names.dictionary) + lang, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(key), np.int32)), flat.dictionary.take(pa.array(key // len(names.dictionary))),
                     names.dictionary.take(pa.array(key % len(names.dictionary))), pa.array(count)], names=["n", "feature", "lang", "count"])

    return docs.mapInArrow(run, "n int, feature string, lang string, count long").groupBy("n", "feature", "lang").agg(F.sum("count").alias("count"))


def _gram_counts(counts: DataFrame) -> DataFrame:
    """(n, feature, lang, count) of the character n-grams of counted words."""

    def run(batches):
        for batch in batches:
            found: dict = defaultdict(int)
            for word, lang, count in zip(*(batch.column(c).to_pylist() for c in ("feature", "lang", "count")), strict=True):
                for n in range(1, LONGEST + 1):
                    for g in grams(word, n):
                        found[n, g, lang] += count
            if found:
                n, feature, lang = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(feature), pa.array(lang), pa.array(list(found.values()), pa.int64())],
                                                 names=["n", "feature", "lang", "count"])

    return counts.mapInArrow(run, "n int, feature string, lang string, count long").groupBy("n", "feature", "lang").agg(F.sum("count").alias("count"))


def _by_feature(counts: DataFrame, totals: dict, langs: list[str]) -> DataFrame:
    """(n, feature, count, v) with the scores v in the order of ``langs``."""

    absent = F.element_at(F.create_map(*[F.lit(x) for n, t in totals.items() for x in (n, _absent(t))]), F.col("n"))

    def score(lang):
        total = F.element_at(F.create_map(*[F.lit(x) for n, t in totals.items() if t.get(lang) for x in (n, float(t[lang]))]), F.col("n"))
        found = F.max(F.when(F.col("lang") == lang, -F.log10(F.col("count") / total)))
        return F.coalesce(found, F.max(absent)).cast("float")

    return counts.groupBy("n", "feature").agg(F.sum("count").alias("count"), F.array(*[score(lang) for lang in langs]).alias("v"))


def _absent(totals: dict[str, int]) -> float:
    """The score of a feature that a language lacks: above that of any counted feature of
    any language, however many there are, and PENALTY at least."""
    return max(PENALTY, 1 + math.log10(max(totals.values(), default=1)))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model: languages, and the written tables of words and of n-grams with
    their scores by language."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    words = materialize(_word_counts(known))
    counts = materialize(_gram_counts(words))
    totals: dict = defaultdict(dict)
    for r in words.union(counts).groupBy("n", "lang").agg(F.sum("count").alias("total")).collect():
        totals[r["n"]][r["lang"]] = r["total"]
    langs = sorted(totals[0])
    if not langs:
        return {"langs": langs}
    return {"langs": langs, "words": materialize(_by_feature(words, totals, langs).drop("n")),
            "grams": materialize(_by_feature(counts, totals, langs).drop("count"))}


def _frequent(words: DataFrame) -> DataFrame:
    """At most FREQUENT words: those of the highest counts, from the numbers of words
    by power of 2 ** (1 / 4), so that no table is sorted in one task."""
    words = words.where(F.length("feature") <= SENT_CHARS)
    step = F.floor(F.log2(F.col("count")) * 4).cast("int")
    sizes = {r["step"]: r["words"] for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()}
    least, room = max(sizes, default=0) + 1, FREQUENT
    for s in sorted(sizes, reverse=True):
        room -= sizes[s]
        if room < 0:
            break
        least = s
    return words.where(step >= least)


def _added(texts: DataFrame, frequent: DataFrame, width: int) -> DataFrame:
    """(key, n, total, rest) of (key, text) rows: number of words, sums of the scores of
    the frequent ones, and the other words with their counts."""
    rows = frequent.select("feature", "v").toArrow()
    scores = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    sent = texts.sparkSession.sparkContext.broadcast(({w: i for i, w in enumerate(rows.column("feature").to_pylist())},
                                                      np.vstack([scores, np.zeros((1, width), np.float32)])))

    def run(batches):
        index, scores = sent.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                flat, ends = words_of(part.column("text"))
                n = np.diff(ends)
                flat = flat.dictionary_encode()
                code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.array([index.get(w, -1) for w in flat.dictionary.to_pylist()], np.int64)
                total = np.zeros((len(flat) + 1, width))
                if len(flat):
                    np.cumsum(scores[at[code]], axis=0, dtype=np.float64, out=total[1:])
                total = total[ends[1:]] - total[ends[:-1]]
                size = max(len(flat.dictionary), 1)
                other = np.flatnonzero(at[code] < 0)
                pair, times = np.unique(np.repeat(np.arange(len(n)), n)[other] * size + code[other], return_counts=True)
                rest = pa.StructArray.from_arrays([flat.dictionary.take(pa.array(pair % size)), pa.array(times, pa.int64())], names=["word", "times"])
                cut = np.searchsorted(pair, np.arange(len(n) + 1) * size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * width, pa.int32()), pa.array(total.ravel())),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rest)], names=["key", "n", "total", "rest"])

    return texts.mapInArrow(run, "key long, n long, total array<double>, rest array<struct<word:string,times:long>>")


def _word_scores(asked: DataFrame, model: dict) -> DataFrame:
    """(word, v) of the distinct words of ``asked``: the model's, or the mean of those
    of its longest known n-grams, or PENALTY."""
    langs = model["langs"]
    found = materialize(asked.join(model["words"].select(F.col("feature").alias("word"), "v"), "word", "left"))
    out, left = found.where("v IS NOT NULL"), found.where("v IS NULL").select("word")
    for n in range(LONGEST, 0, -1):
        if left.isEmpty():
            return out
        table = small_side(model["grams"].where(F.col("n") == n).select(F.col("feature").alias("gram"), "v"),
                           F.octet_length("gram") + 4 * len(langs) + 16)
        padded = F.concat(F.lit(" "), "word", F.lit(" ")) if n > 1 else F.col("word")
        parts = left.where(F.length(padded) >= n).select("word", F.explode(
            F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, F.lit(n)))).alias("gram"))
        means = [F.avg(F.col("v")[i].cast("double")).cast("float") for i in range(len(langs))]
        backed = materialize(parts.join(table, "gram").groupBy("word").agg(F.array(*means).alias("v")))
        out = out.union(backed)
        left = materialize(left.join(backed, "word", "left_anti"))
    return out.union(left.withColumn("v", F.array(*[F.lit(PENALTY).cast("float")] * len(langs))))


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the share of the predicted language in the
    scores taken as the likelihoods of one average word (0 to 1)."""
    langs = model["langs"]
    if not langs:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("key"), text.alias("text"))
    # equal texts have equal predictions: from here on a text is its hash
    added = materialize(materialize(_added(texts, _frequent(model["words"]), len(langs))).dropDuplicates(["key"]))
    rest = materialize(added.select("key", F.explode("rest").alias("r")).select("key", "r.word", "r.times"))
    scores = materialize(_word_scores(rest.select("word").distinct(), model))
    scores = small_side(scores, F.octet_length("word") + 4 * len(langs) + 16)
    sums = [F.sum(F.col("times") * F.col("v")[i].cast("double")).alias(f"s{i}") for i in range(len(langs))]
    more = rest.join(scores, "word").groupBy("key").agg(*sums)
    mean = F.array(*[(F.col("total")[i] + F.coalesce(F.col(f"s{i}"), F.lit(0.0))) / F.col("n") for i in range(len(langs))])
    near = F.transform("mean", lambda x: F.round(x, 9))
    best = F.array_position(near, F.array_min(near)).cast("int")
    share = 1 / F.aggregate("mean", F.lit(0.0), lambda s, x: s + F.pow(F.lit(10.0), F.array_min("mean") - x))
    judged = added.select("key", "n", "total").where("n > 0").join(more, "key", "left").select("key", mean.alias("mean"))
    judged = materialize(judged.select(F.col("key").alias("_found"), F.element_at(F.array(*map(F.lit, langs)), best).alias("_lang"), share.alias("_share")))
    rows = docs.withColumn("_text", F.xxhash64(text)).join(small_side(judged), F.col("_text") == F.col("_found"), "left")
    return rows.withColumns({"lang_pred": F.coalesce("_lang", F.lit("und")), "score": F.coalesce("_share", F.lit(0.0))}).drop(
        "_text", "_found", "_lang", "_share")
