"""The pipeline against a brute-force version of its five stages."""

import random
import tempfile

from tokenizers import Tokenizer

import corpus_pipeline
from cellspark.llm import decontaminate

from .helpers import base_counts, components, edit_distance


def _tables(spark, folder):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "blmnprst" for b in ("ao", "ei", "ou", "ia") for c in "dgknrst"]
    prose = lambda n: ". ".join(" ".join(rng.choice(words) for _ in range(12)).capitalize() for _ in range(n)) + "."
    passage = prose(9)
    items = [(i, prose(3)) for i in range(4)]
    docs = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            t = " ".join(w.upper() + "!!" for w in prose(6).split())  # junk
        elif kind == 1:
            t = prose(8) + " " + items[i % 4][1] + " " + prose(2)  # holds an item
        elif kind == 2:
            t = prose(5) + "\n" + passage + "\n" + prose(4)  # a passage that many share
        elif kind == 3 and docs:
            w = docs[-3][1].split(" ")  # near copy of a clean text
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        else:
            t = prose(10)
        docs.append((i, t, "en", "s", len(t)))
    docs += [(60, None, "en", "s", 0), (61, "", None, None, None), (62, "too short", "en", "s", 9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 0)) for i in range(0, 60)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def _expected(docs, items):
    kept = []
    for i, t, *_ in docs:
        n, _, _, _, repeated = base_counts(t)
        if n >= 20 and 100 * repeated <= 30 * n and not t.isupper():
            kept.append((i, t))
    kept = [r for r, (i, _, low) in zip(kept, components(kept, 5, 8, 10), strict=True) if i == low]
    counts = {}
    for _, t in kept:
        b = t.encode()
        for x in range(len(b) - 399):
            counts[b[x:x + 400]] = counts.get(b[x:x + 400], 0) + 1
    out = []
    for i, t in kept:
        b = t.encode()
        gone = bytearray(len(b))
        for x in range(len(b) - 399):
            if counts[b[x:x + 400]] > 1:
                gone[x:x + 400] = b"\1" * 400
        out.append((i, bytes(c for c, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")))
    plain = [decontaminate.normalise(t) for _, t in items]
    out = [(i, t) for i, t in out if not any(edit_distance(p, decontaminate.normalise(t)) <= int(0.06 * len(p)) for p in plain)]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    return sorted((i, t, len(t), tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in out)


def test_pipeline_equals_brute_force(spark):
    folder = tempfile.mkdtemp(prefix="cellspark-pipeline-")
    docs, items = _tables(spark, folder)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"]
    rows = out.collect()
    assert sorted((r.doc_id, r.text, r.n_chars, tuple(r.ids)) for r in rows) == _expected(docs, items)
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_on_an_empty_table(spark):
    folder = tempfile.mkdtemp(prefix="cellspark-pipeline-")
    _tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_columns_with_the_operators_names_pass_through(spark):
    """Columns that are named like what the operators add keep their values, in every stage."""
    folder = tempfile.mkdtemp(prefix="cellspark-pipeline-")
    _tables(spark, folder)
    odd = {"kept": "'as it was'", "n_words": "-1", "n_bytes": "'b'", "Text_Key": "7", "_key": "8", "sid": "'s'", "_matches": "array(1)", "decoded": "'d'"}
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id IS NOT NULL").selectExpr("*", *[f"{v} AS {c}" for c, v in odd.items()])
    want = docs.selectExpr(*[f"{v} AS {c}" for c, v in odd.items()]).first()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert [f.dataType for f in out.schema.fields][5:5 + len(odd)] == [f.dataType for f in docs.schema.fields][5:]
        rows = out.select(*odd).distinct().collect()
        assert rows == [want], name


def test_suffix_dedup_counts_words(spark):
    """Passages of 51 words go however few bytes they have; passages of 50 words stay."""
    rng = random.Random(12)
    prose = lambda n, k: [f"{rng.choice('bcdfg')}{rng.randrange(10 ** k)}" for _ in range(n)]
    passages = [prose(51, 1), prose(50, 2), prose(60, 4), prose(51, 5)]
    docs = []
    for i in range(40):
        p = passages[i % 4]
        w = prose(rng.randint(0, 70), 6) + p + prose(rng.randint(0, 70), 6)
        docs.append((None if i in (36, 37) else i, rng.choice([" ", "\n", "  "]).join(w)))
    docs += [(40, None), (41, ""), (42, " ".join(passages[0][:50]))]
    count = {}
    for _, t in docs:
        w = (t or "").split()
        for x in range(len(w) - 50):
            count[tuple(w[x:x + 51])] = count.get(tuple(w[x:x + 51]), 0) + 1
    want = []
    for i, t in docs:
        w = (t or "").split()
        gone = {y for x in range(len(w) - 50) if count[tuple(w[x:x + 51])] > 1 for y in range(x, x + 51)}
        want.append((i, [x for y, x in enumerate(w) if y not in gone]))
    df = spark.createDataFrame([(*d, None) for d in docs], "doc_id long, text string, n_chars long")
    got = [(r.doc_id, (r.text or "").split()) for r in corpus_pipeline.suffix_dedup(spark, df, "").collect()]
    short = [(i, w) for i, w in want if i is None or i % 4 < 2 or i > 39]  # repeats of 400 bytes have partial words at their ends
    assert sorted((g for g in got if g[0] is None or g[0] % 4 < 2 or g[0] > 39), key=str) == sorted(short, key=str)
    long = {i: w for i, w in want if i is not None and i % 4 > 1 and i <= 39}
    assert all(len(w) <= len(long[i]) and not set(passages[i % 4]) & set(w) for i, w in got if i in long)
