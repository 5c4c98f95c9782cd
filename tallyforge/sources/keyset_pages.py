"""A streaming data source that pages through a table by its key; the offset of the stream is the cursor.

    spark.dataSource.register(KeysetPages)
    spark.readStream.format("keyset_pages").option("path", ...).option("key", "o_orderkey").option("page", "500").load()

Each batch is the page of the next ``page`` rows above the cursor, as a remote table would be asked for them; rows that share
the page's last key come with it, so no key is cut in two. The stream's checkpoint holds the cursor, and a query that
was stopped goes on behind the last page that it committed. The table is a folder of Parquet files whose key is a whole number
or a string without nulls. Of each file only the row groups are read whose statistics say that they may hold the page. A page
passes through the driver, as it would from a remote service, and is bounded by ``page`` and the rows of one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import from_arrow_schema


class KeysetPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyset_pages"

    def schema(self):
        return from_arrow_schema(Pages(self.options).columns())

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PageReader(self.options)


class Pages:
    """A table's rows above a key, from as few row groups as may hold them."""

    def __init__(self, options: dict):
        self.key, self.size = options["key"], int(options.get("page", "1000"))
        if self.size < 1:
            raise ValueError("a page has a row at least")
        path = options["path"]
        self.store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        found = self.store.get_file_info(root)
        files = [found] if found.type == fs.FileType.File else self.store.get_file_info(fs.FileSelector(root, recursive=True))
        self.files = sorted(f.path for f in files if f.type == fs.FileType.File and f.base_name.endswith(".parquet"))
        if not self.files:
            raise ValueError(f"no Parquet files in {path}")

    def columns(self) -> pa.Schema:
        return pq.read_schema(self.files[0], filesystem=self.store).remove_metadata()

    def _groups(self) -> list[tuple]:
        """(least key, greatest key, file, row group) of all row groups that have rows."""
        out = []
        for path in self.files:
            meta = pq.read_metadata(path, filesystem=self.store)
            for g in range(meta.num_row_groups):
                column = next((c for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == self.key), None)
                if column is None:
                    raise ValueError(f"no column {self.key} in {path}")
                stats = column.statistics
                if stats is None or not stats.has_min_max:
                    if meta.row_group(g).num_rows:
                        raise ValueError(f"{path} has no statistics of {self.key}, or only nulls")
                    continue
                out.append((stats.min, stats.max, path, g))
        return sorted(out, key=lambda x: x[:1])

    def rows(self, above, upto=None) -> pa.Table:
        """The rows with keys above ``above``, up to a key or, without one, the next page's."""
        got, tables = 0, []
        for least, most, path, g in self._groups():
            if (above is not None and most <= above) or (upto is not None and least > upto):
                continue
            if upto is None and got >= self.size and least > self._last(tables):
                break
            part = pq.ParquetFile(path, filesystem=self.store).read_row_group(g)
            key = part[self.key]
            if key.null_count:
                raise ValueError(f"{self.key} has nulls")
            keep = pc.greater(key, above) if above is not None else pa.chunked_array([pa.repeat(True, len(part))])
            keep = pc.and_(keep, pc.less_equal(key, upto)) if upto is not None else keep
            tables.append(part.filter(keep))
            got += tables[-1].num_rows
        whole = pa.concat_tables(tables).sort_by(self.key) if tables else self.columns().empty_table()
        if upto is None and whole.num_rows > self.size:
            whole = whole.filter(pc.less_equal(whole[self.key], whole[self.key][self.size - 1]))
        return whole

    def _last(self, tables: list[pa.Table]):
        """The key of the page's last row among the rows so far."""
        keys = pa.chunked_array([c for t in tables for c in t[self.key].chunks])
        return keys.take(pc.sort_indices(keys).slice(self.size - 1, 1))[0].as_py()


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.pages = Pages(options)

    def initialOffset(self) -> dict:
        return {"after": None}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        page = self.pages.rows(start["after"])
        last = page[self.pages.key][-1].as_py() if page.num_rows else start["after"]
        return iter([tuple(r.values()) for r in page.to_pylist()]), {"after": last}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        if end["after"] is None or start["after"] == end["after"]:
            return iter(())
        return iter([tuple(r.values()) for r in self.pages.rows(start["after"], end["after"]).to_pylist()])

    def commit(self, end: dict) -> None:
        pass
