"""Notes on rows of Parquet tables, brought to the rows without moving them.

A row is known by its file and its place there, which Spark's Parquet reader
tells, so repeated and null ids do no harm. Notes are narrow: they are shuffled by
file and run of rows and written as small files in the shared folder, one for each
run that has notes. A pass over the table then looks up the notes of the rows it
reads. So whole texts are neither shuffled nor joined, however many rows have
notes, and nothing is broadcast.

A run has ``RUN`` rows at most, so a note file is bounded however large the table's
files are. A task that is run again writes the same files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from leadrank.llm.shared import put, qualified, read_if_there, stored
from leadrank.session import scratch_path

FILE, ROW = "__lr_file", "__lr_row"
#: Rows of a file that share a file of notes.
RUN = 1 << 17


def located(df: DataFrame) -> DataFrame:
    """``df`` with the file and place of each row; a table that was not read from Parquet is written first."""
    for table in (lambda: df, lambda: stored(df, "located")):
        try:
            now = table()
            place = now.metadataColumn("_metadata")
            made = now.select("*", place["file_path"].alias(FILE), place["row_index"].alias(ROW))
            made.schema  # noqa: B018
            return made
        except AnalysisException as error:
            failed = error
    raise failed


def name_of(file: str, run: int) -> str:
    return f"{hashlib.sha256(file.encode()).hexdigest()}-{run}.arrow"


def write_notes(notes: DataFrame) -> str:
    """Write ``(__lr_file, __lr_row, note)`` rows, one note a row at most; the folder they are in."""
    spark = notes.sparkSession
    folder = qualified(spark, scratch_path(spark, "notes"))
    run_of = F.floor(F.col(ROW) / RUN).cast("bigint").alias("run")
    ordered = notes.select(FILE, run_of, ROW, F.col("note").cast("string")).repartition(FILE, "run").sortWithinPartitions(FILE, "run", ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        rows: list[int] = []
        texts: list[str | None] = []

        def close() -> pa.RecordBatch:
            table = pa.table({"row": pa.array(rows, pa.int64()), "note": pa.array(texts, pa.string())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_file(sink, table.schema) as out:
                out.write_table(table)
            put(folder, name_of(*now), [sink.getvalue().to_pybytes()])
            rows.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array([table.num_rows])], names=["n"])

        for batch in batches:
            for file, number, row, note in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and now != (file, number):
                    yield close()
                now = (file, number)
                rows.append(row)
                texts.append(note)
        if now is not None:
            yield close()

    stored(ordered.mapInArrow(run, "n bigint"), "notes-written")
    return folder


def noted(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[pa.RecordBatch, dict[int, str | None]]]:
    """In a task: batches of located rows without their places, and the notes of their rows by place in the batch."""
    at: tuple[str, int] | None = None
    known: dict[int, str | None] = {}
    for batch in batches:
        width = batch.num_columns - 2
        files, places = batch.column(width).dictionary_encode(), batch.column(width + 1).to_pylist()
        found = {}
        texts = files.dictionary.to_pylist()
        for k, (file, place) in enumerate(zip(files.indices.to_pylist(), places, strict=True)):
            if at != (texts[file], place // RUN):
                at = (texts[file], place // RUN)
                data = read_if_there(folder, name_of(*at))
                table = pa.ipc.open_file(pa.BufferReader(data)).read_all() if data else None
                known = dict(zip(table["row"].to_pylist(), table["note"].to_pylist(), strict=True)) if table else {}
            if place in known:
                found[k] = known[place]
        yield pa.RecordBatch.from_arrays(batch.columns[:width], names=batch.schema.names[:width]), found
    # The worker waits for other tasks; what it does not use goes back.
    pa.default_memory_pool().release_unused()


def with_notes(df: DataFrame, folder: str, work: Callable[[pa.RecordBatch, dict[int, str | None]], pa.RecordBatch]) -> DataFrame:
    """``work`` on each batch of ``located`` rows, with the notes of its rows by their place in the batch.

    ``work`` gets and returns the columns of the table itself.
    """
    names = [F.col(f"`{c}`") for c in df.columns if c not in (FILE, ROW)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in noted(batches, folder):
            yield work(batch, found)

    return df.select(*names, FILE, ROW).mapInArrow(run, df.select(*names).schema)


def without(df: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``located`` ``df`` but for those that ``gone`` names by file and place."""
    notes = gone.select(FILE, ROW).distinct().withColumn("note", F.lit(None).cast("string"))

    def work(batch: pa.RecordBatch, found: dict[int, str | None]) -> pa.RecordBatch:
        if not found:
            return batch
        return batch.filter(pa.array([k not in found for k in range(batch.num_rows)]))

    return with_notes(df, write_notes(notes), work)


#: Rows that one bitmap tells of, its bytes, and bitmaps that are sent to every task at most (64 MB).
BITS, BITMAP_BYTES, SENT_BITMAPS = 32_768, 4_096, 16_384


def without_rows(df: DataFrame, gone: DataFrame, sent: int = SENT_BITMAPS) -> DataFrame:
    """``without`` by DataFrame functions alone.

    The rows that go are bitmaps, one for each run of 32,768 rows that has any, so
    their size is bounded by the table's number of rows. Up to ``sent`` of them are
    broadcast and no text moves; beyond that the planner joins them.
    """
    names = [c for c in df.columns if c not in (FILE, ROW)]
    part = F.floor(F.col(ROW) / BITS).cast("bigint")
    bits = gone.select(FILE, ROW).groupBy(FILE, part.alias("__lr_part")).agg(F.bitmap_construct_agg(F.col(ROW) % BITS).alias("__lr_bits"))
    bits = stored(bits, "gone-bitmaps")
    bits = bits.select(F.col(FILE).alias("__lr_of"), F.col("__lr_part").alias("__lr_at"), "__lr_bits")
    if bits.count() <= sent:
        bits = F.broadcast(bits)
    place = (F.col(ROW) % BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__lr_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_gone = F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
    joined = df.join(bits, (F.col(FILE) == F.col("__lr_of")) & (part == F.col("__lr_at")), "left")
    return joined.where(~is_gone).select(*[F.col(f"`{c}`") for c in names])
