"""A data source that writes raw arrays: one file a record, named by what is in it, and nothing where a task or the job fails.

    spark.dataSource.register(ArrayFiles)
    df.write.format("array_files").option("path", "file:///data/arrays").mode("append").save()

Columns: series (string), record (string), values (an array of whole numbers or floats). A file holds the values'
bytes, little end first, and is called ``<series>/<record>.<kind><bits>.<count>.bin``, kind being i, u or f. With the option
``unsigned`` whole numbers are written without sign. Series and record must be plain names; a null anywhere or a number that
does not fit is an error. Tasks write to a folder of the job; the driver moves the files of the tasks that were
committed into place, so attempts that fail or run twice leave nothing. ``overwrite`` clears the folder first.

``text_files`` writes texts in the same way: of the columns series, record and value a file ``<series>/<record>`` holds the value.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_.=-]*")
KINDS = {T.ByteType: ("i", 8), T.ShortType: ("i", 16), T.IntegerType: ("i", 32), T.LongType: ("i", 64), T.FloatType: ("f", 32), T.DoubleType: ("f", 64)}


@dataclass
class Written(WriterCommitMessage):
    """The files of one task, in its own folder."""

    folder: str
    files: list[str]


class ArrayFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "array_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.names != ["series", "record", "values"] or not isinstance(schema["values"].dataType, T.ArrayType):
            raise ValueError("the columns must be series, record and values")
        kind = KINDS.get(type(schema["values"].dataType.elementType))
        if kind is None:
            raise ValueError("values must be an array of whole numbers or floats")
        unsigned = self.options.get("unsigned", "false").lower() == "true" and kind[0] == "i"
        made = ArrayWriter(self.options["path"], overwrite, "u" if unsigned else kind[0], kind[1])
        made.begin()
        return made


class ArrayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, kind: str, bits: int):
        self.path, self.overwrite, self.kind, self.bits = path, overwrite, kind, bits
        self.job = f"_job-{uuid.uuid4().hex}"

    def _at(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        return store, root.rstrip("/")

    def begin(self) -> None:
        """Makes the job's folder, on the driver; tasks that go on after it was cleared find no place to write to."""
        store, root = self._at()
        store.create_dir(f"{root}/{self.job}", recursive=True)

    def _bytes(self, values: pa.Array) -> bytes:
        if values.null_count:
            raise ValueError("a null cannot be written")
        have = values.to_numpy(zero_copy_only=False)
        out = have.astype(f"<{self.kind}{self.bits // 8}")
        if self.kind == "u" and len(have) and have.min() < 0:
            raise ValueError("a number below zero has no unsigned form")
        return out.tobytes()

    def _file(self, record: str, value: pa.Scalar) -> tuple[str, bytes]:
        """The name and the contents of a record's file."""
        data = value.values
        return f"{record}.{self.kind}{self.bits}.{len(data)}.bin", self._bytes(data)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = self._at()
        folder, files, made = f"{root}/{self.job}/{uuid.uuid4().hex}", [], set()
        store.create_dir(folder, recursive=False)
        try:
            for batch in iterator:
                series, records, values = (batch.column(i) for i in range(3))
                for i in range(batch.num_rows):
                    own = [series[i].as_py(), records[i].as_py()]
                    if not all(isinstance(n, str) and NAME.fullmatch(n) for n in own) or not values[i].is_valid:
                        raise ValueError(f"no file can be written for {own}")
                    name, data = self._file(own[1], values[i])
                    name = f"{own[0]}/{name}"
                    if own[0] not in made:
                        store.create_dir(f"{folder}/{own[0]}", recursive=False)
                        made.add(own[0])
                    if store.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
                        raise ValueError(f"two records are called {name}")
                    with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
                        out.write(data)
                    files.append(name)
        except BaseException:
            self._clear(store, folder)
            raise
        return Written(folder, files)

    @staticmethod
    def _clear(store: fs.FileSystem, folder: str) -> None:
        for wait in (0.05, 0.2, 1.0, None):
            try:
                if store.get_file_info(folder).type == fs.FileType.Directory:
                    store.delete_dir(folder)
                return
            except OSError:  # a task that is being stopped has just written to it
                if wait is None:
                    raise
                time.sleep(wait)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._at()
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.files]
        try:
            if len(set(names)) < len(names):
                raise ValueError("two records have one name")
            if self.overwrite and store.get_file_info(root).type == fs.FileType.Directory:
                for old in store.get_file_info(fs.FileSelector(root)):
                    if old.base_name != self.job:
                        store.delete_dir(old.path) if old.type == fs.FileType.Directory else store.delete_file(old.path)
            elif there := [n for n in names if store.get_file_info(f"{root}/{n}").type != fs.FileType.NotFound]:
                raise ValueError(f"there is a file {there[0]} already")
            for series in sorted({n.split("/")[0] for n in names}):
                store.create_dir(f"{root}/{series}", recursive=True)
            for m in done:
                for n in m.files:
                    store.move(f"{m.folder}/{n}", f"{root}/{n}")
        finally:
            self._clear(store, f"{root}/{self.job}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._at()
        self._clear(store, f"{root}/{self.job}")


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.names != ["series", "record", "value"] or not isinstance(schema["value"].dataType, T.StringType):
            raise ValueError("the columns must be series, record and value, a string")
        made = TextWriter(self.options["path"], overwrite, "", 0)
        made.begin()
        return made


class TextWriter(ArrayWriter):
    def _file(self, record: str, value: pa.Scalar) -> tuple[str, bytes]:
        return record, value.as_py().encode()
