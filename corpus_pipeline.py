"""The corpus pipeline: filter, de-duplicate, decontaminate and encode documents.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import bpe, decontaminate, line_quality, ngram_join, suffix_repeats
from cellspark.llm._shared import bound_batches, materialize, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text, and the other columns as one: an operator's columns may have any
    of their names."""
    bound_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.struct(F.lit(0))).alias("_rest_of_row"))


def _unpacked(out: DataFrame, docs: DataFrame, *more, without: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` in their order, with the id and text of ``out``."""
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("_rest_of_row")[c].alias(c) for c in docs.columns if c not in without], *more)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly content; the others go (operator 9)."""
    model = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return _unpacked(line_quality.label_lines(_packed(docs), model).where("kept"), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard
    similarity of 0.8 or more (operator 1)."""
    return _unpacked(ngram_join.one_per_component(_packed(docs), k=5, num=8, den=10), docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes or more, or of over 50 words, that also
    stand elsewhere; n_chars is that of the new text (operator 4)."""
    out = _unpacked(suffix_repeats.remove_repeats(_packed(docs), min_len=400, min_words=51), docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 3)."""
    found = decontaminate.with_matches(_packed(docs), table(spark, sf_dir, "benchmark"), out_col="_matches")
    return _unpacked(found.where(F.size("_matches") == 0), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, its text as decoded from them (operator 7); columns
    n_tokens and ids of the documents give way."""
    out = bpe.decode(bpe.encode(_packed(docs), VOCABULARY), VOCABULARY, out_col="text")
    return _unpacked(out, docs, F.size("ids").cast("long").alias("n_tokens"), "ids", without=("n_tokens", "ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL cannot express the labelling, suffix-array and tokenizer stages; tests/llm
#: holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
