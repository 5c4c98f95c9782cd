"""A data source that reads records which begin with a marked line, in byte ranges: a large file is many tasks.

    spark.dataSource.register(MarkedRecords)
    spark.read.format("marked_records").option("start", "ID ").option("end", "//").load("file:///data/entries")

Rows: path, offset (of the record's first byte), lines (array), state. A record runs from a line that begins with
``start`` up to the next such line, or to a line equal to ``end`` if that is given. state is ``whole``, ``unterminated``
(an end is wanted and missing) or ``stray`` (lines outside any record: before the first, or after an end). Nothing is left
out but blank lines among strays. A range owns what begins in it: each record whose first byte lies in it, with all
that follows up to the next start, and the first range also owns the file's head. So it makes no difference
where files are cut. Texts are UTF-8; other bytes become replacement characters. Compressed files are one range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
#: Characters of records that go into one batch.
BATCH_CHARS = 1 << 20
#: Tasks that ranges are dealt to: where there are more ranges, a task reads neighbours, those of one file as one range.
TASKS = 1024


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    stop: int


@dataclass
class Ranges(InputPartition):
    """Neighbouring ranges that one task reads."""

    parts: list[Range]


class MarkedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marked_records"

    def schema(self) -> str:
        return "path string, offset long, lines array<string>, state string"

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(self.options)


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        if not options.get("start"):
            raise ValueError("the option start says what a record's first line begins with")
        self.path, self.start, self.end = options["path"], options["start"].encode(), options["end"].encode() if options.get("end") else None
        self.split = int(options.get("split_bytes", 64 << 20))
        if self.split < 1:
            raise ValueError("split_bytes must be 1 at least")

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[InputPartition]:
        store, root = self._at()
        found = store.get_file_info(root)
        if found.type == fs.FileType.NotFound:
            raise ValueError(f"no file {self.path}")
        files = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        ranges = []
        for f in sorted(files, key=lambda f: f.path):
            if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")):
                step = max(1, f.size) if f.base_name.endswith(COMPRESSED) else self.split
                ranges += [Range(f.path, a, min(f.size, a + step)) for a in range(0, f.size, step)]
        if len(ranges) <= TASKS:
            return ranges or [Range("", 0, 0)]
        share = -(-len(ranges) // TASKS)
        return [Ranges(self._merged(ranges[a : a + share])) for a in range(0, len(ranges), share)]

    @staticmethod
    def _merged(ranges: list[Range]) -> list[Range]:
        out = [ranges[0]]
        for r in ranges[1:]:
            if r.path == out[-1].path:
                out[-1] = Range(r.path, out[-1].begin, r.stop)
            else:
                out.append(r)
        return out

    @staticmethod
    def _lines(source, begin: int) -> Iterator[tuple[int, bytes]]:
        """(offset, line without its end) from the first line that begins at or after ``begin``."""
        at = 0
        if begin:  # the line before tells whether one begins just here
            source.seek(begin - 1)
            at = begin - 1 + len(source.readline())
        while line := source.readline():
            yield at, line.removesuffix(b"\n").removesuffix(b"\r")
            at += len(line)

    def _records(self, part: Range) -> Iterator[tuple[int, list[bytes], str]]:
        store, _ = self._at()
        opened = store.open_input_stream(part.path) if part.path.endswith(COMPRESSED) else store.open_input_file(part.path)
        with opened as raw:
            source = _Buffered(raw)
            offset, lines, state = (0, [], "stray") if part.begin == 0 else (None, [], "")
            for at, line in self._lines(source, part.begin):
                if line.startswith(self.start):
                    if lines:
                        yield offset, lines, state
                    if at >= part.stop and not part.path.endswith(COMPRESSED):
                        return
                    offset, lines, state = at, [line], "whole" if self.end is None else "unterminated"
                elif offset is None:
                    if at >= part.stop:
                        return
                elif state == "unterminated" and line == self.end:
                    yield offset, [*lines, line], "whole"
                    offset, lines, state = at, [], "stray"
                elif state != "stray" or line.strip():
                    offset = at if state == "stray" and not lines else offset
                    lines.append(line)
            if lines:
                yield offset, lines, state

    def read(self, partition: Range | Ranges) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Ranges):
            for part in partition.parts:
                yield from self.read(part)
            return
        if not partition.path:
            return
        rows, held = [], 0
        for offset, lines, state in self._records(partition):
            texts = [x.decode("utf-8", "replace") for x in lines]
            rows.append((partition.path, offset, texts, state))
            held += sum(map(len, texts))
            if held > BATCH_CHARS:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "offset", "lines", "state"])


class _Buffered:
    """Whole lines of a stream, read in larger pieces."""

    def __init__(self, raw, piece: int = 1 << 20):
        self.raw, self.piece, self.rest, self.at = raw, piece, b"", 0

    def seek(self, to: int) -> None:
        self.raw.seek(to)
        self.rest, self.at = b"", 0

    def readline(self) -> bytes:
        parts = []
        while True:
            if (cut := self.rest.find(b"\n", self.at)) >= 0:
                parts.append(self.rest[self.at : cut + 1])
                self.at = cut + 1
                return b"".join(parts)
            parts.append(self.rest[self.at :])
            self.rest, self.at = self.raw.read(self.piece), 0
            if not self.rest:
                return b"".join(parts)
