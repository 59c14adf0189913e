"""The registered queries opN_<name>, each on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, decontaminate, language, licenses, line_quality, minhash, ngram_join, prefix_trie, quality_pu, suffix_repeats, warc
from ._shared import held_out, materialize, table

#: Vocabulary file of operators 7 and 10; every executor has it at this path.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    docs = table(spark, sf_dir, "documents")
    return ngram_join.jaccard_components(docs, k=3, num=90, den=100).drop("sid", "text_key", "node")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document from a model of those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~held_out()))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a few edits, with the items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.errors", "m.stop")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 400-byte strings that occur elsewhere too make up of each document; kept_text is
    the text without them, and kept_bytes its length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_repeats.remove_repeats(docs, min_len=400)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", text.alias("kept_text"), F.octet_length(text).cast("long").alias("kept_bytes"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with a model of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality_pu.train(docs.where(~held_out()), labels.where(~held_out()))
    return quality_pu.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that state a licence."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC bundles and read them back."""
    folder = warc.new_folder(spark)
    index = materialize(warc.write(warc.plan_records(table(spark, sf_dir, "pages")), folder))
    return warc.read(index, folder).drop("payload")


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document by its lines; the field learns from rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_quality.train(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return line_quality.label_lines(docs, model).drop("text")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that holds the template's own control
    strings, and read them back."""
    odd = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                              "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.read_turns(chat.format_turns(rows, VOCABULARY), VOCABULARY))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), max_words=5, min_count=100, inside_share=100, top=2000)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt on the first turns of another."""
    return prefix_trie.trie(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their 4-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, num=80, den=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_licenses": op6_licenses,
    "op7_bpe": op7_bpe,
    "op8_warc": op8_warc,
    "op9_line_quality": op9_line_quality,
    "op10_chat": op10_chat,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_minhash": op13_minhash,
}

ORACLE: dict[str, str] = {
    "op6_licenses": licenses.scan_sql(),
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS top FROM p GROUP BY html),
d AS (SELECT p.page_id, encode(p.html) AS raw, sha1(p.html) AS hex, g.top FROM p JOIN g USING (html)),
b AS (SELECT *, list_transform(range(0, 20), lambda i: CAST('0x' || substr(hex, CAST(2 * i + 1 AS INTEGER), 2) AS INTEGER)) AS bytes FROM d)
SELECT page_id, octet_length(raw) AS payload_bytes,
       list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           ((bytes[CAST(1 + k * 5 // 8 AS INTEGER)] * 256 + coalesce(bytes[CAST(2 + k * 5 // 8 AS INTEGER)], 0))
            >> CAST(11 - (k * 5) % 8 AS INTEGER)) & 31) AS INTEGER), 1) FOR k IN range(0, 32)], lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b""",
    "op11_collocations": """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[CAST(i AS INTEGER):CAST(i + m - 1 AS INTEGER)], ' ') AS phrase
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m))),
n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
s AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n.n,
             (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
      FROM c JOIN n USING (lang)
      JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.phrase = array_to_string(c.w[1:CAST(c.k AS INTEGER)], ' ')
      JOIN f y ON y.lang = c.lang AND y.m = c.m - c.k AND y.phrase = array_to_string(c.w[CAST(c.k + 1 AS INTEGER):], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM f o WHERE o.lang = b.lang AND o.m > b.m AND 100 * o.f >= 100 * b.a AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
    "op12_prefix_trie": """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(turn ORDER BY pos) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, conv_id - conv_id % 5 AS base, CAST(xor(4294967295, list_reduce(
        flatten([[CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END,
        CAST(4294967295 AS BIGINT))) % 9 AS BIGINT) AS h FROM own),
c AS (SELECT x.conv_id, list_concat(coalesce(b.turns[1:x.h], []), x.turns[x.h + 1:]) AS turns
      FROM h x LEFT JOIN own b ON b.conv_id = x.base),
p AS (SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS ended FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             string_agg(CASE WHEN ended THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ids,
             (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(path[depth].text)) END AS saved
      FROM p GROUP BY path, depth),
s AS (SELECT a.path, sum(b.saved) AS saved_tokens, count(*) FILTER (NOT EXISTS (SELECT 1 FROM n k WHERE k.depth = b.depth + 1 AND k.path[1:b.depth] = b.path)) AS n_leaves,
             count(*) FILTER (b.depth = a.depth + 1) AS n_children
      FROM n a JOIN n b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path GROUP BY a.path)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN n q ON q.depth = n.depth - 1 AND q.path = n.path[1:n.depth - 1]""",
    "op13_minhash": """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[CAST(i AS INTEGER):CAST(i + 3 AS INTEGER)], ' ') FOR i IN range(1, len(w) - 2)] END)) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
         JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
         GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(r.low, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)""",
}
