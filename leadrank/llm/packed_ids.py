"""Token ids in fixed-width bit packing.

File format, all numbers little-endian:

* header: magic ``LRPK``, version u32, bits an id u32, ids a block u32,
  documents u64, ids u64, blocks u64
* document table: doc_id i64 each, then a byte each (1: null id), then the
  first id's place in the file u64 each, and one more entry for the end
* block table: byte offset of each block in the file u64
* blocks: ids at the least number of bits that holds the vocabulary; eight ids
  fill as many bytes as an id has bits, so packing and unpacking are a few
  shifts over whole numpy columns

Any run of ids is read from the blocks it touches, without the rest of the file.

Files follow each other in ascending doc_id order (null ids first; repeated ids
in any order among themselves). A null or empty text holds the end id alone. A very long text is encoded whole, in a
group of its own, and may fill a file by itself. An
empty table has no files. Files are written whole under a name of their own per
task attempt; the manifest names those that count.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from leadrank.llm.chunked_ids import GROUP, ByteLevelEncoder as Encoder
from leadrank.llm.shared import groups_of, once, put, qualified, read_range, stored, tasks_for

MAGIC, VERSION = b"LRPK", 1
HEAD = "<4sIIIQQQ"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK_IDS = 8192
#: A file is closed when it holds this many ids.
FILE_IDS = 4_000_000
#: Files that a task reads back, where there are many.
FILES_A_TASK = 16

MANIFEST = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("place", T.IntegerType(), False),
        T.StructField("n_docs", T.LongType(), False),
        T.StructField("n_ids", T.LongType(), False),
    ]
)


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids to ``bits`` bytes, lowest bits first; the last group is filled with zeros."""
    full = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    full[: len(ids)] = ids
    rows = full.reshape(-1, 8)
    out = np.zeros((len(rows), bits), np.uint8)
    for j in range(8):
        at = j * bits
        shifted = rows[:, j] << np.uint64(at % 8)
        for k in range(at // 8, (at + bits - 1) // 8 + 1):
            out[:, k] |= ((shifted >> np.uint64(8 * (k - at // 8))) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes, as uint32."""
    rows = np.frombuffer(data, np.uint8, -(-n // 8) * bits).reshape(-1, bits)
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        at = j * bits
        value = np.zeros(len(rows), np.uint64)
        for k in range(at // 8, (at + bits - 1) // 8 + 1):
            value |= rows[:, k].astype(np.uint64) << np.uint64(8 * (k - at // 8))
        out[:, j] = (value >> np.uint64(at % 8)) & mask
    return out.reshape(-1)[:n]


def file_bytes(doc_ids: list[int | None], ends: list[int], ids: np.ndarray, bits: int) -> Iterator[bytes]:
    """The parts of one file. ``ends``: number of ids up to the end of each document."""
    n, blocks = len(doc_ids), -(-len(ids) // BLOCK_IDS)
    table = HEAD_BYTES + 9 * n + 8 * (n + 1)
    width = BLOCK_IDS // 8 * bits
    yield struct.pack(HEAD, MAGIC, VERSION, bits, BLOCK_IDS, n, len(ids), blocks)
    yield np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    yield bytes(d is None for d in doc_ids)
    yield np.array([0, *ends], "<u8").tobytes()
    yield (table + 8 * blocks + width * np.arange(blocks, dtype="<u8")).astype("<u8").tobytes()
    for k in range(blocks):
        yield pack(ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS], bits)


class PackedFile:
    """Reads documents or runs of ids of one file."""

    def __init__(self, folder: str, name: str) -> None:
        self.folder, self.name = folder, name
        magic, version, self.bits, self.block, n, self.n_ids, blocks = struct.unpack(HEAD, read_range(folder, name, 0, HEAD_BYTES))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no packed file: {name}")
        tables = read_range(folder, name, HEAD_BYTES, 9 * n + 8 * (n + 1) + 8 * blocks)
        raw = np.frombuffer(tables, "<i8", n).tolist()
        self.doc_ids = [None if null else d for d, null in zip(raw, tables[8 * n : 9 * n], strict=True)]
        self.starts = np.frombuffer(tables, "<u8", n + 1, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(tables, "<u8", blocks, 9 * n + 8 * (n + 1)).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from place ``start`` to before ``stop``; only their blocks are read."""
        if stop <= start:
            return np.empty(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block
        held = min((b + 1) * self.block, self.n_ids) - a * self.block
        data = read_range(self.folder, self.name, int(self.offsets[a]), -(-held // 8) * self.bits)
        return unpack(data, self.bits, held)[start - a * self.block : stop - a * self.block]


def write_packed(
    docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = 0, file_ids: int = FILE_IDS
) -> DataFrame:
    """Encode ``(doc_id, text)``, write the files under ``folder``, return their manifest.

    One range shuffle brings the texts in doc_id order; each task writes its
    files as it goes and holds one at a time.
    """
    folder = qualified(docs.sparkSession, folder)
    # A row number behind the id spreads an id of very many rows over several tasks.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(f"packed-ids {tokenizer_file}", lambda: Encoder(tokenizer_file))
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        names: list[int | None] = []
        parts: list[bytes] = []
        sizes: list[int] = []
        place = held = 0

        def close() -> pa.RecordBatch:
            nonlocal place, held
            ids = np.frombuffer(b"".join(parts), "<u4")
            name = put(folder, f"ids-{part:06d}-{place:05d}-{attempt}.bin", file_bytes(names, np.cumsum(sizes).tolist(), ids, bits))
            row = {"file": [name], "partition": [part], "place": [place], "n_docs": [len(names)], "n_ids": [len(ids)]}
            for kept in (names, parts, sizes):
                kept.clear()
            place, held = place + 1, 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("file", pa.string()), ("partition", pa.int32()), ("place", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for rows in batches:
            doc_ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for a, b in groups_of(texts, GROUP):
                for doc_id, ids in zip(doc_ids[a:b], encoder.ids(texts[a:b]), strict=True):
                    names.append(doc_id)
                    parts.append(ids + end)
                    sizes.append(len(ids) // 4 + 1)
                    held += sizes[-1]
                    if held >= file_ids:
                        yield close()
        if names:
            yield close()

    # The files are written once, when the manifest is.
    return stored(ordered.mapInArrow(run, MANIFEST), "packed-manifest")


def read_packed(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), ids.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    # One row per file, so this window is bounded by the number of files.
    before = F.sum("n_ids").over(Window.orderBy("partition", "place").rowsBetween(Window.unboundedPreceding, -1))
    folder = qualified(manifest.sparkSession, folder)
    n = tasks_for(manifest.sparkSession, manifest.count(), FILES_A_TASK)
    files = manifest.select("file", F.coalesce(before, F.lit(0)).alias("first")).repartition(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, first in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                file = PackedFile(folder, name)
                n = len(file.doc_ids)
                step = max(1, n * FILE_IDS // (8 * max(1, file.n_ids)))
                for a in range(0, n, step):
                    b = min(n, a + step)
                    data = file.ids(int(file.starts[a]), int(file.starts[b])).astype("<u4").tobytes()
                    places = (4 * (file.starts[a : b + 1] - file.starts[a])).tolist()
                    ids = [data[x:y] for x, y in zip(places, places[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids[a:b], pa.int64()), pa.array(first + file.starts[a:b]), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "ids"],
                    )

    return files.mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def digests(read: DataFrame) -> DataFrame:
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def read_document(folder: str, name: str, place: int) -> np.ndarray:
    """Ids of one document, by its place in a file."""
    file = PackedFile(folder, name)
    return file.ids(int(file.starts[place]), int(file.starts[place + 1]))
