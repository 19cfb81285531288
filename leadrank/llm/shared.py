"""Helpers of this subpackage: shared files, stable tables, split of texts into cached chunks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadrank.session import scratch_path

#: Texts are worked on in groups of about this many characters.
GROUP_CHARS = 2_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage at a table all executors see; a lost executor loses none of it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_anew(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """``stored``, and where; the table at ``before``, which only ``df`` needed, goes once the new one is whole."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if before is not None:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path), path


def tasks_for(spark: SparkSession, items: int, each: int) -> int:
    """Tasks for so many items: all cores while these are few, ``each`` items a task beyond that."""
    return max(1, min(items, 2 * spark.sparkContext.defaultParallelism), -(-items // each))


def share(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) / 1_000_000


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark would give it; call this on the driver.

    A path without a scheme belongs to the cluster's default file system, which
    need not be the local one.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    made = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return made.rstrip("/")


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local one."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def put(folder: str, name: str, parts: Iterable[bytes]) -> str:
    """Write a file in the folder; it appears under its name when whole.

    A name that is there already stays: it holds what another attempt of the same
    task wrote.
    """
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
        system.move(draft, f"{path}/{name}")
    else:
        system.delete_file(draft)
    return name


def read_if_there(folder: str, name: str) -> bytes | None:
    """A whole file, or None where there is none."""
    system, path = open_fs(folder)
    if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
        return None
    return read_range(folder, name)


def read_range(folder: str, name: str, start: int = 0, length: int | None = None) -> bytes:
    """Bytes of a file; a negative start counts from its end."""
    system, path = open_fs(folder)
    with system.open_input_file(f"{path}/{name}") as f:
        size = f.size()
        at = start if start >= 0 else max(0, size + start)
        f.seek(at)
        return f.read(size - at if length is None else length)


def once(key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once per Python process.

    The library's functions travel to the workers by value, so a cache of a
    function would last for one task only.
    """
    import sys
    import types

    kept = sys.modules.setdefault("_leadrank_once", types.ModuleType("_leadrank_once")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def groups_of(texts: list[str | None], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of the list with about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 64
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class ChunkCache:
    """Values of text chunks, of at most ``size`` chunks at a time.

    ``make`` gives the values of a list of new chunks. When the cache is full,
    the chunks that came again since the last time stay, or only those of the
    current group where these are too many.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], size: int = 600_000) -> None:
        self.make, self.size, self.known, self.again = make, size, {}, set()

    def of(self, chunks: set[str]) -> dict:
        new = list(chunks.difference(self.known))
        self.again.update(chunks.intersection(self.known))
        if len(self.known) + len(new) > self.size:
            kept = self.again if 2 * len(self.again) <= self.size else chunks.intersection(self.known)
            self.known = {c: self.known[c] for c in kept}
            self.again = set()
        self.known.update(zip(new, self.make(new), strict=True))
        return self.known


def pieces_of(text: str) -> list[str]:
    """Chunks of a text: one for each space and each line break.

    A chunk that starts with a line break stands for itself, any other for a
    space (or the start of the text) and itself.
    """
    return text.replace("\n", " \n").split(" ")


def batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(spark_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark_schema)
