"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding whole WARC records, then two
skippable frames that any Zstandard reader passes over: the record index (record id, frame, offset and
length inside the frame) and the seek table of the public seekable format (compressed and
plain size and checksum of every frame).
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.llm.shared import put_file, read_file, run_folder

# Fixed values of the seekable format: skippable magic, footer magic; and our index frame.
SKIPPABLE_TABLE, FOOTER, SKIPPABLE_INDEX = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
_SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
_INDEX = np.dtype([("page_id", "<i8"), ("frame", "<u4"), ("offset", "<u8"), ("length", "<u8")])
#: Content up to this many bytes is stored again rather than referred to.
LEAST_REVISIT = 1000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = -(1 << 63)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int,
           refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    body = http + payload if refers_to is None else http
    name = "none" if page_id is None else page_id
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        # A line break in an address must not start a new header line.
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(body)}"]
    return "WARC/1.1\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload digest and size, payload of a record.

    The digest of a response is taken anew from the payload and must agree with the header.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    got = dict(x.split(": ", 1) for x in lines[1:])
    http, _, payload = rest[:int(got["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = got["WARC-Payload-Digest"].removeprefix("sha1:")
    if got["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{got['WARC-Record-ID']}: payload differs from its digest")

    def number(name: str) -> int | None:
        value = got.get(name, "<urn:page:none>")[10:-1]
        return None if value == "none" else int(value)

    return {"page_id": number("WARC-Record-ID"), "url": got.get("WARC-Target-URI"),
            "record_type": got["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "payload_digest": digest, "payload_bytes": size,
            "payload": payload if got["WARC-Type"] == "response" else None}


def bundle(records: Iterator[tuple[int | None, bytes]], frame_bytes: int = 1 << 19, level: int = 6) -> Iterator[bytes]:
    """The bytes of a bundle, part by part, from (page_id, record)."""
    import xxhash
    import zstandard

    press, seek, index, held, size = zstandard.ZstdCompressor(level, write_content_size=True), [], [], [], 0

    def frame() -> bytes:
        nonlocal held, size
        plain = b"".join(held)
        packed = press.compress(plain)
        seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        held, size = [], 0
        return packed

    for page_id, raw in records:
        index.append((NO_ID if page_id is None else page_id, len(seek), size, len(raw)))
        held.append(raw)
        size += len(raw)
        if size >= frame_bytes:
            yield frame()
    if held:
        yield frame()
    listed = press.compress(np.array(index, _INDEX).tobytes())
    yield struct.pack("<II", SKIPPABLE_INDEX, len(listed)) + listed
    table = np.array(seek, _SEEK).tobytes() + struct.pack("<IBI", len(seek), 0x80, FOOTER)
    yield struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table


class Bundle:
    """Reads single records or frames of a bundle that can seek."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, io.SEEK_END)
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER or flags != 0x80:
            raise ValueError("not a seekable bundle")
        file.seek(end - 9 - n * _SEEK.itemsize)
        self.seek = np.frombuffer(file.read(n * _SEEK.itemsize), _SEEK)
        self.begin = np.concatenate([[0], np.cumsum(self.seek["packed"].astype(np.int64))])

    def index(self) -> np.ndarray:
        """(page_id, frame, offset, length) of every record."""
        import zstandard

        self.file.seek(int(self.begin[-1]))
        magic, size = struct.unpack("<II", self.file.read(8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("the record index is missing")
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self.file.read(size)), _INDEX)

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        self.file.seek(int(self.begin[k]))
        plain = zstandard.ZstdDecompressor().decompress(self.file.read(int(self.seek["packed"][k])))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.seek["check"][k]:
            raise ValueError(f"frame {k}: checksum differs")
        return plain

    def records(self) -> Iterator[dict]:
        """All records, a frame in memory at a time."""
        index = self.index()
        cut = np.searchsorted(index["frame"], np.arange(len(self.seek) + 1))
        for k in range(len(self.seek)):
            plain = self.frame(k)
            for r in index[cut[k]:cut[k + 1]]:
                yield parse(plain[int(r["offset"]):int(r["offset"] + r["length"])])

    def fetch(self, page_id: int) -> dict | None:
        """One record; only its frame is decompressed."""
        index = self.index()
        at = np.flatnonzero(index["page_id"] == page_id)
        if not len(at):
            return None
        r = index[at[0]]
        plain = self.frame(int(r["frame"]))
        return parse(plain[int(r["offset"]):int(r["offset"] + r["length"])])


def write_archives(
    pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
    html: str = "html", date: str = "2020-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page as a WARC record into bundles of the shared folder.

    The project keeps no crawled pages, so the operator is general: any table with an integer id, an
    address and the page text (null: empty).  Of pages with equal content of ``LEAST_REVISIT`` bytes
    or more that with the largest id is the response, and the others refer to it; equal means
    equal in SHA-1 and length.  Rows that share the largest id are all responses, and so are rows
    without an id unless an id has their content.  Returns the stored list of bundles: path,
    n_records, n_bytes.

    Pages are dealt out by their digest for one join with the responses; adaptive execution splits
    a digest that many pages share.  A task writes its bundle under a name of its own and only
    the winner's name is listed.
    """
    folder = folder or run_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("k"), F.col(url).alias("u"), payload.alias("p")).withColumns(
        {"digest": F.sha1("p"), "size": F.octet_length("p").cast("long")})
    newest = pages.select(F.col(page_id).cast("long").alias("k"), payload.alias("p")).where(
        F.octet_length("p") >= LEAST_REVISIT).groupBy(
        F.sha1("p").alias("digest"), F.octet_length("p").cast("long").alias("size")).agg(F.max("k").alias("newest"))
    told = rows.join(newest, ["digest", "size"], "left").select(
        "k", "u", "digest", "size",
        F.when((F.col("k") != F.col("newest")) | (F.col("k").isNull() & F.col("newest").isNotNull()),
               F.col("newest")).alias("refers"),
    "p").withColumn("p", F.when(F.col("refers").isNull(), F.col("p")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = {"records": 0}

        def records():
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    for r in batch.slice(at, 64).to_pylist():
                        done["records"] += 1
                        yield r["k"], record(r["k"], r["u"], r["p"] or b"", r["digest"], r["size"], r["refers"], date)

        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        size = put_file(path, bundle(records()))
        if done["records"]:
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [done["records"]], "n_bytes": [size]})

    return materialized(told.mapInArrow(run, "path string, n_records long, n_bytes long"))


def read_archives(bundles: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of bundles: page_id, payload_bytes, payload_digest, record_type, refers_to, url,
    and the payload on request (null for a revisit).  No bundle, no row."""
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}
    kinds |= {"payload": pa.binary()} if with_payload else {}
    ddl = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string" + ", payload binary" * with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with read_file(path) as f:
                    held = []
                    for r in Bundle(f).records():
                        held.append(r)
                        if len(held) == 256:
                            yield _batch(held, kinds)
                            held = []
                    yield _batch(held, kinds)

    return bundles.select("path").repartition(max(1, bundles.count())).mapInArrow(run, ddl)


def _batch(rows: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kinds.items()], names=list(kinds))
