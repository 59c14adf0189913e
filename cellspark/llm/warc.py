"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames, each compressed on its own, and a bundle ends with
a seek table (a skippable frame, as the seekable format of Zstandard lays it out).
The index maps every record to its bundle, frame and place inside the frame, so one
record is read by decompressing one frame.

Equal payloads are written once: the record with the largest page id is the response,
the others are revisit records that name it.  Payload digests are found and compared
by Spark; each task then writes its rows as bundles of bounded size into a folder
that all executors share, under a name of its own.  A bundle counts only if the
index that Spark keeps names it, so a task that runs twice leaves a stray file and
no second record.

Defined results: a null html is an empty payload; a null or unusual url is written
percent-encoded or left out; rows of equal page id and payload are records of their
own, all responses if they have the largest id; null page ids revisit the record
with an id, or are responses if no equal payload has an id; payloads of fewer than
``min_bytes`` bytes are always responses; an empty table gives no bundle and an
empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of records in a frame, and of compressed frames in a bundle, at which the next one begins.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 128 << 20
#: Fixed values of the seekable format: magic of the skippable frame, and of its footer.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, record_type string, bundle string, frame int, start int, length int"


def filesystem(uri: str):
    """(file system, path) of a folder that executors share: local, HDFS or an
    object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records ---------------------------------------------------------------

def record(page_id, url, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record.  A revisit has the headers of its payload but no payload."""
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        block = http
    else:
        block = http + payload
    head.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The headers, HTTP headers and payload of a record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = top.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"head": head, "http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


# ---- bundles ---------------------------------------------------------------

def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer of a bundle: (compressed, plain) sizes of its frames."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


class Bundle:
    """A bundle opened for reading: only its footer is read at first."""

    def __init__(self, file) -> None:
        import zstandard

        self.file, self.plain = file, zstandard.ZstdDecompressor()
        size = file.size()
        count, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        each = 12 if flags & 0x80 else 8
        table = file.read_at(count * each, size - 9 - count * each)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, i * each)
            self.frames.append((at, packed, plain))
            at += packed
        self.held = (-1, b"")

    def read(self, frame: int, start: int, length: int) -> bytes:
        if self.held[0] != frame:
            at, packed, plain = self.frames[frame]
            self.held = (frame, self.plain.decompress(self.file.read_at(packed, at), max_output_size=plain))
        return self.held[1][start:start + length]


# ---- Spark -----------------------------------------------------------------

def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, revisit) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    groups = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha")
              .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(groups, "sha", "left").drop("sha")
    if min_bytes:
        rows = rows.withColumn("refers_to", F.when(F.octet_length("html") >= min_bytes, F.col("refers_to")))
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return rows.withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("refers_to")))


def write(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES,
          bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write planned records as bundles into ``folder`` (a URI that all executors
    reach).  The result is the index; it writes when it is evaluated, so evaluate it
    once, into a table."""

    def run(batches):
        import zstandard

        fs, path = filesystem(folder)
        pack = zstandard.ZstdCompressor(level=3)
        state = {"out": None}

        def close():
            if state["out"] is not None:
                state["out"].write(seek_table(state["frames"]))
                state["out"].close()
                state["out"] = None

        def flush():
            """Close the open frame; yields its index rows."""
            rows, data = state["rows"], b"".join(state["parts"])
            packed = pack.compress(data)
            state["out"].write(packed)
            state["frames"].append((len(packed), len(data)))
            state["written"] += len(packed)
            state["rows"], state["parts"], state["size"] = [], [], 0
            if state["written"] >= bundle_bytes:
                close()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()], strict=True)],
                names=["page_id", "record_type", "bundle", "frame", "start", "length"])

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")), strict=True):
                if state["out"] is None:
                    fs.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    state |= {"name": name, "out": fs.open_output_stream(f"{path}/{name}", compression=None), "frames": [], "written": 0, "rows": [], "parts": [], "size": 0}
                data = record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), revisit.as_py(), date)
                state["rows"].append((page_id.as_py(), "revisit" if revisit.as_py() else "response", state["name"], len(state["frames"]), state["size"], len(data)))
                state["parts"].append(data)
                state["size"] += len(data)
                if state["size"] >= frame_bytes:
                    yield flush()
        if state["out"] is not None:
            if state["rows"]:
                yield flush()
            close()

    return records.mapInArrow(run, INDEX)


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of a written index read back from their bundles: page_id, payload (null for a
    revisit), payload_bytes, payload_digest, record_type, refers_to.  Index rows of a
    bundle are sorted, so each frame is decompressed once."""

    def run(batches):
        fs, path = filesystem(folder)
        name, bundle = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(lo, 256).to_pylist():
                    if r["bundle"] != name:
                        if bundle is not None:
                            bundle.file.close()
                        name, bundle = r["bundle"], Bundle(fs.open_input_file(f"{path}/{r['bundle']}"))
                    x = parse(bundle.read(r["frame"], r["start"], r["length"]))
                    head, revisit = x["head"], x["head"]["WARC-Type"] == "revisit"
                    stated = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest(x["payload"]) != stated:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
                    ids = [head[k][len("<urn:page:"):-1] if k in head else "None" for k in ("WARC-Record-ID", "WARC-Refers-To")]
                    out.append((None if ids[0] == "None" else int(ids[0]), None if revisit else x["payload"],
                                int(x["http"]["Content-Length"]) if revisit else len(x["payload"]), stated, head["WARC-Type"],
                                None if ids[1] == "None" else int(ids[1])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True), [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()], strict=True)],
                        names=["page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if bundle is not None:
            bundle.file.close()

    # index rows are small and bundles large: one partition per bundle, which Spark does not merge
    bundles = max(1, index.select("bundle").distinct().count())
    return (index.repartition(bundles, "bundle").sortWithinPartitions("bundle", "frame", "start")
            .mapInArrow(run, "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def new_folder(spark: SparkSession) -> str:
    """A folder for bundles below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
