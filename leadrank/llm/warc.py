"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with a group of whole
WARC records, and ends with a seek table in a skippable frame: the compressed
and decompressed size of each frame, the number of frames, a descriptor byte and
a magic number. Ordinary Zstandard readers read such a file from end to end. The
index maps each record id to its bundle, its frame and its offset within the
decompressed frame, so one record costs two reads: the footer and one frame.

Of records with equal payloads of at least ``min_bytes``, the one with the
largest key is a response and the others revisit it and carry no payload. Which
one that is comes from an aggregation on payload digests that combines before it
shuffles. Only digests move: what a page is goes back to it as a note, and tasks
write the pages of their own part of the table. A group of copies of any size is
no hot task, as its rows are narrow and Spark may split their join.

Tasks write each bundle whole under a name of their own attempt, and the index
names the bundles that count; a lost executor leaves an unread file at worst.
A null payload is empty. Repeated keys are records of their own with the same
id; null keys and null urls are written as empty header values. An empty table
has no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leadrank.llm.row_notes import FILE, ROW, located, noted, write_notes
from leadrank.llm.shared import batch, put, qualified, read_range, stored, tasks_for

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER, HEADER, ENTRY = "<IBI", "<II", "<II"
#: Bytes of records in a frame and of frames in a bundle, before and after compression.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20
LEVEL = 3
#: Frames that a task reads back, where there are many.
FRAMES_A_TASK = 64
#: One date for all records keeps archives of equal tables equal.
DATE = "1970-01-01T00:00:00Z"
INDEX = "record string, key bigint, bundle string, frame int, offset bigint, length bigint"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def record_bytes(key: int | None, url: str | None, payload: bytes, sha: str, size: int, refers_to: int | None) -> bytes:
    """One record. ``size`` and ``sha`` are those of the full payload; a revisit has no payload of its own."""
    revisit = refers_to is not None
    target = "".join((url or "").split())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-Id: {'' if key is None else key}",
        f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    body = data.index(b"\r\n\r\n", stop + 4) + 4
    return head, data[body:end], end + 4


class Bundle:
    """Frames of one bundle while it is written."""

    def __init__(self) -> None:
        import zstandard

        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.packed = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        place = (len(self.frames), self.held)
        self.open.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.held))
            self.packed += len(frame)
            self.open, self.held = [], 0

    def parts(self) -> Iterator[bytes]:
        self.close_frame()
        yield from self.frames
        entries = b"".join(struct.pack(ENTRY, *s) for s in self.sizes)
        footer = struct.pack(FOOTER, len(self.sizes), 0, SEEKABLE)
        yield struct.pack(HEADER, SKIPPABLE, len(entries) + len(footer)) + entries + footer


def seek_table(folder: str, name: str) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame of a bundle."""
    size = struct.calcsize(FOOTER)
    n, descriptor, magic = struct.unpack(FOOTER, read_range(folder, name, -size))
    if magic != SEEKABLE:
        raise ValueError(f"no seek table: {name}")
    width = struct.calcsize(ENTRY) + 4 * (descriptor >> 7)
    table = read_range(folder, name, -size - n * width)
    out, start = [], 0
    for k in range(n):
        packed, plain = struct.unpack_from(ENTRY, table, k * width)
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(folder: str, name: str, place: tuple[int, int, int]) -> bytes:
    import zstandard

    start, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(read_range(folder, name, start, packed), max_output_size=plain)


def read_record(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record, from its entry in the index."""
    data = read_frame(folder, bundle, seek_table(folder, bundle)[frame])
    return parse_record(data, offset)[:2]


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write a record per page under ``folder`` and return the index."""
    folder = qualified(pages.sparkSession, folder)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = located(pages).select(F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"), body.alias("body"), FILE, ROW)
    digests = rows.select("key", FILE, ROW, F.sha1("body").alias("sha"), F.octet_length("body").alias("size"))
    digests = stored(digests.where(F.col("size") >= min_bytes), "warc-digests")
    # Payloads with one digest and size are equal; single ones need no partner.
    copies = digests.groupBy("sha", "size").agg(F.max("key").alias("last"), F.count(F.lit(1)).alias("n"))
    copies = copies.where((F.col("n") > 1) & F.col("last").isNotNull()).select(F.col("sha").alias("s"), F.col("size").alias("z"), "last")
    linked = digests.join(copies, (F.col("sha") == F.col("s")) & (F.col("size") == F.col("z")))
    notes = write_notes(linked.where(~F.col("key").eqNullSafe(F.col("last"))).select(FILE, ROW, F.col("last").cast("string").alias("note")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, number = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0
        schema = pa.schema(
            [("record", pa.string()), ("key", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
        )
        bundle, entries = Bundle(), []

        def close() -> pa.RecordBatch:
            nonlocal bundle, entries, number
            name = put(folder, f"pages-{part:06d}-{number:04d}-{attempt}.warc.zst", bundle.parts())
            columns = list(zip(*entries, strict=True))
            out = batch(dict(zip(schema.names, [columns[0], columns[1], [name] * len(entries), *columns[2:]], strict=True)), schema)
            bundle, entries, number = Bundle(), [], number + 1
            return out

        for rows_, found in noted(batches, notes):
            for k, (key_, url_, data) in enumerate(zip(*(c.to_pylist() for c in rows_.columns), strict=True)):
                refers = int(found[k]) if k in found else None
                sha, size = digest(data), len(data)
                record = record_bytes(key_, url_, data, sha, size, refers)
                frame, offset = bundle.add(record)
                entries.append((record_id(key_), key_, frame, offset, len(record)))
                if bundle.packed >= BUNDLE_BYTES:
                    yield close()
        if entries:
            yield close()

    # The bundles are written once, when the index is.
    return stored(rows.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, with its full payload's size and digest.

    ``payload`` is null for revisits. The digest of a response is taken from the
    payload that was read and must equal its header. Frames are dealt out, not
    bundles.
    """
    folder = qualified(index.sparkSession, folder)
    frames = index.select("bundle", "frame").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record", pa.string()), ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        tables: dict[str, list] = {}
        for rows in batches:
            for name, number in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                if name not in tables:
                    tables = {name: seek_table(folder, name)}
                data = read_frame(folder, name, tables[name][number])
                out: dict[str, list] = {k: [] for k in schema.names}
                at = 0
                while at < len(data):
                    head, payload, at = parse_record(data, at)
                    revisit = head["WARC-Type"] == "revisit"
                    sha = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (digest(payload) != sha or len(payload) != int(head["X-Payload-Length"])):
                        raise ValueError(f"payload and header of {head['WARC-Record-ID']} differ")
                    out["record"].append(head["WARC-Record-ID"])
                    out["key"].append(int(head["X-Page-Id"]) if head["X-Page-Id"] else None)
                    out["url"].append(head["WARC-Target-URI"])
                    out["record_type"].append(head["WARC-Type"])
                    out["payload_bytes"].append(int(head["X-Payload-Length"]))
                    out["payload_digest"].append(sha)
                    out["refers_to"].append(int(head["X-Refers-To-Page-Id"]) if revisit else None)
                    out["payload"].append(None if revisit else payload)
                yield batch(out, schema)

    # Frames are few small rows, so a number is given: without one they would be merged into one task.
    n = tasks_for(index.sparkSession, frames.count(), FRAMES_A_TASK)
    spread = frames.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return spread.mapInArrow(
        run,
        "record string, key bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary",
    )
