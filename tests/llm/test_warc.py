"""WARC bundles: round trip, random access, revisits."""

import base64
import hashlib

from pyspark.sql import functions as F

from cellspark.llm import warc
from cellspark.llm._shared import materialize


def _rows():
    rows = [(i, f"http://x/{i}", f"<p>page {i % 7}</p>" * (i % 5 + 1)) for i in range(60)]
    return rows + [(60, None, None), (61, "http://x/\r\nWARC-Type: é", ""), (5, "http://y", "<p>again</p>"), (None, "u", "<p>page 0</p>"),
                   (None, "u", "nothing else"), (70, "u", "é" * 3000), (70, "u", "é" * 3000)]


def _expected(rows):
    top = {}
    for p, _, h in rows:
        h = (h or "").encode()
        top[h] = max((x for x in (top.get(h), p) if x is not None), default=None)
    out = []
    for p, _, h in rows:
        h = (h or "").encode()
        revisit = top[h] is not None and p != top[h]
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if revisit else "response", top[h] if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = _rows()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, bundle string")
    folder = warc.new_folder(spark)
    index = materialize(warc.write(warc.plan_records(pages), folder, frame_bytes=2000, bundle_bytes=4000))
    assert index.select("bundle").distinct().count() > 1
    back = warc.read(index, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == _expected(rows)
    # one record needs one frame
    fs, path = warc.filesystem(folder)
    one = index.where("page_id = 70").first()
    bundle = warc.Bundle(fs.open_input_file(f"{path}/{one.bundle}"))
    assert warc.parse(bundle.read(one.frame, one.start, one.length))["payload"] == ("é" * 3000).encode()


def test_small_payloads_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    plan = {r.page_id: r.revisit for r in warc.plan_records(pages, min_bytes=5).collect()}
    assert plan == {1: False, 2: False, 3: True, 4: False}
    folder = warc.new_folder(spark)
    index = materialize(warc.write(warc.plan_records(pages.where(F.lit(False))), folder))
    assert index.collect() == []
    assert warc.read(index, folder).collect() == []
