"""A pluggable partitioned line reader on the Python Data Source API.

Usage: `spark.dataSource.register(LineSource)` and
`spark.read.format("lines_of").schema(...).option("path", folder).load()`.
Each task reads a byte range of one file, so no file is too large for a task, and puts
out Arrow batches. The stream form remembers the files it has taken, by name and size, so
a file is read once whenever it comes and however it is called; a file that grows after
it was taken is an error.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import islice

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SPLIT_BYTES = 64 << 20
BATCH_ROWS = 10_000


class LineRange(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


def _parse(text: str, kind: str):
    if text == "":
        return None
    if kind in ("long", "integer", "short", "byte"):
        return int(text)
    if kind in ("double", "float"):
        return float(text)
    if kind in ("timestamp", "timestamp_ntz"):
        value = datetime.fromisoformat(text)
        return value.replace(tzinfo=timezone.utc) if kind == "timestamp" else value
    return text


class _Lines:
    def __init__(self, schema: StructType, options: dict) -> None:
        self.kinds = [f.dataType.typeName() for f in schema.fields]
        self.arrow = to_arrow_schema(schema)
        self.path = options["path"]
        self.sep = options.get("sep", ",")
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))

    def _fs(self, path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
            fs.LocalFileSystem(), path
        )

    def files(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        system, root = self._fs(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        return sorted(
            (f.path, f.size)
            for f in found
            if f.is_file and f.size and not f.base_name.startswith(("_", "."))
        )

    def ranges(self, files: list[tuple[str, int]]) -> list[LineRange]:
        return [
            LineRange(path, at, min(at + self.split, size))
            for path, size in files
            for at in range(0, size, self.split)
        ]

    def rows(self, part: LineRange) -> Iterator[list]:
        system, _ = self._fs(self.path)
        with io.BufferedReader(system.open_input_file(part.path)) as source:
            at = part.start
            if at:  # the line that spans the border belongs to the range before
                source.seek(at - 1)
                at += len(source.readline()) - 1
            source.seek(at)
            while at < part.end:
                line = source.readline()
                if not line:
                    return
                at += len(line)
                text = line.decode("utf-8").rstrip("\r\n")
                if text:
                    fields = text.split(self.sep)
                    if len(fields) != len(self.kinds):
                        raise ValueError(f"{part.path}: {len(fields)} fields, expected {len(self.kinds)}")
                    yield [_parse(v, k) for v, k in zip(fields, self.kinds)]

    def batches(self, part: LineRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        rows = self.rows(part)
        while some := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), self.arrow)], schema=self.arrow)


class _Batch(_Lines, DataSourceReader):
    def partitions(self):
        return self.ranges(self.files()) or [LineRange("", 0, 0)]

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        return self.batches(partition)


class _Stream(_Lines, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": dict(self.files())}

    def partitions(self, start: dict, end: dict):
        taken, seen = start["files"], end["files"]
        grown = [path for path, size in taken.items() if seen.get(path, size) != size]
        if grown:
            raise ValueError(f"files changed after they were read: {grown[:3]}")
        return self.ranges(sorted((path, size) for path, size in seen.items() if path not in taken)) or [LineRange("", 0, 0)]

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        return self.batches(partition)


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines_of"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(schema, self.options)
