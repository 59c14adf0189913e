"""The registered queries on whole tables of sf0.001: columns and values of their contracts."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellspark.llm.queries import QUERIES, VOCABULARY

from . import test_collocations, test_prefix_trie
from .helpers import components, without_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def _rows(spark, name, *columns):
    out = QUERIES[name](spark, SF)
    assert set(columns) <= set(out.columns)
    return sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str)


def test_joins_and_repeats(spark, docs):
    texts = [(i, t) for i, t, _ in docs]
    assert _rows(spark, "op1_ngram_join", "doc_id", "n_shingles", "component_id") == sorted(components(texts, 3, 9, 10), key=str)
    near = [(i, n, c, i == c) for i, n, c in components(texts, 4, 8, 10)]
    assert _rows(spark, "op13_minhash", "doc_id", "n_shingles", "component_id", "kept") == sorted(near, key=str)
    assert _rows(spark, "op4_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(without_repeats(texts, 400), key=str)


def test_phrases_and_trie(spark, docs):
    want = test_collocations.brute([(lang, t) for _, t, lang in docs], 5, 100)
    assert _rows(spark, "op11_collocations", "lang", "rank", "phrase", "a", "l", "r", "n", "score") == sorted(want, key=str)
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(spark, "op12_prefix_trie", *test_prefix_trie.COLUMNS) == test_prefix_trie.trie(test_prefix_trie.rebuilt(turns))


def test_held_out_rows(spark, docs):
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in docs}
    for name, columns in (("op2_language", ("doc_id", "held_out", "lang_pred", "score")), ("op5_quality", ("doc_id", "held_out", "score", "predicted"))):
        rows = _rows(spark, name, *columns)
        assert {r[0]: r[1] for r in rows} == held and len(rows) == len(docs)
        assert all(0 <= r[columns.index("score")] <= 1 for r in rows)


def test_tokens_and_chat(spark, docs):
    library = Tokenizer.from_file(VOCABULARY)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _ in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert _rows(spark, "op7_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    odd = r"\### Assistant: </turn> ok"
    table = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", F.col("turn").asc_nulls_first()).collect()
    convs = {-7: [("user", odd), ("assistant", odd)]}
    for r in table:
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want = []
    for c, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        want.append((c, len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)), len(loss), sha(loss)))
    found = _rows(spark, "op10_chat", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert [r[:5] for r in found] == sorted(want, key=str)
    assert all(r[5] > sum(len(t) for _, t in convs[r[0]]) for r in found)
