"""WARC records in seekable Zstandard bundles.

Each task writes its records into bundles of independent frames; a skippable frame with the seek table ends each bundle, as
in the published seekable format. The index maps a record's identifier to bundle, frame and offset inside the frame, so one
record is read by decompressing one frame. A page whose payload occurs under a smaller page_id becomes a revisit record,
which holds no payload. Bundles go to a folder that all executors share; a task attempt writes files of its own name, and
only attempts that ended well are in the index, so a lost executor leaves nothing wrong behind.

Defined results: null html is an empty payload; payloads under 100 bytes are never revisits; a null page_id orders after all
others and is written as "null"; rows that repeat a page_id with the same payload are all responses; an empty table writes
no bundle; a record longer than a frame gets a frame of its own; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import n_blocks, new_path, stash, tidy_batches, tune

LEAST_REVISIT = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 27
#: Frames that are read as one piece of work, of FRAME_BYTES each and more where a record is longer.
READ_FRAMES = 16
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, bundle string, frame int, offset long, length long"


def plan(pages: DataFrame) -> DataFrame:
    """pages with digest and refers_to: the smallest page_id of an equal payload where that is another page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    firsts = rows.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    # Written, so that the planner knows its size and broadcasts it only where it is small; else both sides are shuffled.
    return rows.join(stash(firsts, "payloads"), "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record_id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class BundleWriter:
    """One bundle: add() records, close() ends it. At most one frame is held."""

    def __init__(self, uri: str):
        self.uri, self.sizes, self.held, self.held_bytes, self.written = uri, [], [], 0, 0
        where, path = fs.FileSystem.from_uri(uri)
        where.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = where.open_output_stream(path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=3)

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        if self.held_bytes >= FRAME_BYTES:
            self._flush()
        at = len(self.sizes), self.held_bytes
        self.held.append(data)
        self.held_bytes += len(data)
        return at

    def _flush(self) -> None:
        if self.held:
            frame = self.zstd.compress(b"".join(self.held))
            self.out.write(frame)
            self.sizes.append((len(frame), self.held_bytes))
            self.written += len(frame)
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Reads the seek table from a bundle's end and then single frames."""

    def __init__(self, uri: str):
        where, path = fs.FileSystem.from_uri(uri)
        self.file = where.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{uri} has no seek table")
        entries = self.file.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", entries):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """(WARC headers, HTTP headers, payload, end) of the record at an offset; header names in lower case."""
    head_end = data.index(b"\r\n\r\n", at)
    head = _headers(data[at:head_end])
    begin = head_end + 4
    end = begin + int(head["content-length"])
    http_end = data.index(b"\r\n\r\n", begin, end)
    return head, _headers(data[begin:http_end]), data[http_end + 4 : end], end + 4


def _headers(data: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in data.decode().split("\r\n")[1:])}


def write(planned: DataFrame, folder: str) -> DataFrame:
    """Write the archives; the index, one row per record. The index is lazy: stash() it before use."""
    tune(planned.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        bundle = None
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("record_id", "bundle", "frame", "offset", "length")}
            for page_id, url, html, digest, refers_to in zip(*(b[c].to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                if bundle is None or bundle.written >= BUNDLE_BYTES:
                    if bundle:
                        bundle.close()
                    bundle = BundleWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                data = record(page_id, url, html, digest, refers_to)
                frame, offset = bundle.add(data)
                for k, v in zip(out, (record_id(page_id), bundle.uri, frame, offset, len(data)), strict=True):
                    out[k].append(v)
            yield pa.record_batch([pa.array(out["record_id"], pa.string()), pa.array(out["bundle"], pa.string()), pa.array(out["frame"], pa.int32()), pa.array(out["offset"], pa.int64()), pa.array(out["length"], pa.int64())], names=list(out))
        if bundle:
            bundle.close()

    return planned.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(tidy_batches(run), INDEX)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def _row(head, http, payload) -> tuple:
    kind = head["warc-type"]
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else head["warc-payload-digest"].partition(":")[2]
    return _page(head["warc-record-id"]), int(http["content-length"]), digest, kind, _page(head.get("warc-refers-to"))


def read(index: DataFrame) -> DataFrame:
    """All records of the index's bundles, read frame by frame at the places that the seek tables give: page_id, payload_bytes, payload_digest, record_type,
    refers_to. Digests of responses are computed from the payload that was read."""

    def run(batches):
        for b in batches:
            for uri, part in zip(b["bundle"].to_pylist(), b["part"].to_pylist(), strict=True):
                bundle = BundleReader(uri)
                for k in range(part * READ_FRAMES, min((part + 1) * READ_FRAMES, len(bundle.frames))):
                    data, at, rows = bundle.frame(k), 0, []
                    while at < len(data):
                        head, http, payload, at = parse(data, at)
                        rows.append(_row(head, http, payload))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                bundle.close()

    # A row here is READ_FRAMES frames of work. Dealt in turn to a given number of partitions, which adaptive execution leaves
    # as they are; by a key it would merge them, for the rows are few.
    work = index.select("bundle", F.floor(F.col("frame") / READ_FRAMES).cast("int").alias("part")).distinct()
    return work.repartition(n_blocks(index.sparkSession)).mapInArrow(tidy_batches(run), READ)


def fetch(index: DataFrame) -> DataFrame:
    """The payloads of single index rows (filter the index first): record_id, payload. Each reads one frame."""

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                bundle = BundleReader(r["bundle"])
                out.append(parse(bundle.frame(r["frame"]), r["offset"])[2])
                bundle.close()
            yield pa.record_batch([b["record_id"], pa.array(out, pa.binary())], names=["record_id", "payload"])

    return index.mapInArrow(run, "record_id string, payload binary")


def archive(pages: DataFrame) -> DataFrame:
    """Write every page and read the archives back."""
    spark = tune(pages.sparkSession)
    return read(stash(write(plan(pages), new_path(spark, "warc")), "warc-index"))
