"""A form's sheet as a streaming source whose offset is the number of rows read.

The sheet is a folder of files with one JSON object a line, in the order of their
names. Files grow at their ends, and new ones sort behind the old. A line counts
once it ends, so a half-written row is read when it is whole; each row has its
number, from 0, and a query that stops and starts again goes on at the next row.

The reader counts lines once, remembers where every ``MARK_ROWS``-th one starts, and
looks only at bytes that came since. Rows of a batch are read by many tasks, each
from the mark before its rows on. A line that is no JSON object is a row without
values.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "form_sheet"
#: The columns of the sheet, in its order.
COLUMNS = ("submitted", "email", "sector", "phrases", "link")
MARK_ROWS = 10_000
CHUNK = 1 << 20


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class Sheet:
    """What is known of the files: sizes, rows, and marks (row, file, byte)."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.rows = 0
        self.marks: list[tuple[int, str, int]] = []
        self.read: dict[str, int] = {}

    def look(self) -> int:
        """Count the rows that came since the last look; the number of all rows."""
        from pyarrow import fs

        system, root = _file_system(self.folder)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        files = sorted((f.base_name, f.path, f.size) for f in found if f.is_file and f.base_name[:1] not in "._")
        for name, path, size in files:
            if name not in self.read:
                if self.read and name < max(self.read):
                    raise ValueError(f"{name} came behind files that follow it")
                self.read[name] = 0
                self.marks.append((self.rows, path, 0))
            if size > self.read[name]:
                self._count(system, name, path)
        return self.rows

    def _count(self, system, name: str, path: str) -> None:
        start = self.read[name]
        with system.open_input_file(path) as file:
            file.seek(start)
            while part := file.read(CHUNK):
                at = -1
                while (at := part.find(b"\n", at + 1)) >= 0:
                    self.rows += 1
                    self.read[name] = start + at + 1
                    if self.rows - self.marks[-1][0] >= MARK_ROWS:
                        self.marks.append((self.rows, path, self.read[name]))
                start += len(part)

    def slices(self, first: int, end: int) -> list["Slice"]:
        """Rows ``first`` to before ``end``, cut at marks."""
        out = []
        while first < end:
            # Of marks at one row the last is that of the file that goes on.
            k = bisect_right([m[0] for m in self.marks], first) - 1
            stop = min([m[0] for m in self.marks[k + 1 : k + 2]] + [end])
            row, path, byte = self.marks[k]
            out.append(Slice(path, byte, first - row, first, min(stop, end)))
            first = min(stop, end)
        return out


class Slice(InputPartition):
    """Rows of one file: skip some lines from a byte on, then read."""

    def __init__(self, path: str, byte: int, skip: int, first: int, end: int) -> None:
        super().__init__(None)
        self.path, self.byte, self.skip, self.first, self.end = path, byte, skip, first, end


def _values(line: bytes) -> tuple:
    try:
        made = json.loads(line)
    except ValueError:
        made = None
    made = made if isinstance(made, dict) else {}
    return tuple(None if made.get(c) is None else str(made[c]) for c in COLUMNS)


class SheetReader(DataSourceStreamReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.sheet = Sheet(folder)

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": self.sheet.look()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A replayed batch may come before the first look.
        if self.sheet.rows < end["row"]:
            self.sheet.look()
        return self.sheet.slices(start["row"], end["row"])

    def read(self, partition: Slice) -> Iterator[tuple]:
        system, path = _file_system(self.folder)
        with system.open_input_file(partition.path) as file:
            file.seek(partition.byte)
            rest, skip, row = b"", partition.skip, partition.first
            while row < partition.end and (part := file.read(CHUNK)):
                *lines, rest = (rest + part).split(b"\n")
                for line in lines:
                    if skip:
                        skip -= 1
                    elif row < partition.end:
                        yield (*_values(line), row)
                        row += 1


class FormSheet(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in COLUMNS) + ", row bigint"

    def streamReader(self, schema) -> SheetReader:
        return SheetReader(self.options["path"])


def read_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the sheet's rows with their numbers, ``row``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    spark.dataSource.register(FormSheet)
    return spark.readStream.format(NAME).option("path", whole).load()
