"""Data sources in Python: raw array files, records by byte range, pages by key."""

import collections
import gzip
import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyforge.session import ship
from tallyforge.sources.array_files import ArrayFiles
from tallyforge.sources.keyset_pages import KeysetPages, Pages
from tallyforge.sources.marked_records import MarkedRecords, RecordReader

KINDS = {"byte": ("i8", "<i1"), "short": ("i16", "<i2"), "int": ("i32", "<i4"), "long": ("i64", "<i8"), "float": ("f32", "<f4"), "double": ("f64", "<f8")}


@pytest.fixture(scope="module", autouse=True)
def sources(spark):
    ship(spark)
    for source in (ArrayFiles, MarkedRecords, KeysetPages):
        spark.dataSource.register(source)


def files(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def table(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"series string, record string, values array<{kind}>").repartition(3)


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_arrays_are_read_back(spark, tmp_path, kind):
    rng = np.random.default_rng(1)
    name, layout = KINDS[kind]
    wanted = {(f"s{i % 2}", f"r{i}"): (rng.normal(size=i * 7) * 50).astype(layout) for i in range(6)}
    rows = [(*k, v.tolist()) for k, v in wanted.items()]
    for mode in ("append", "overwrite"):
        table(spark, rows, kind).write.format("array_files").option("path", f"file://{tmp_path}/out").mode(mode).save()
        assert files(tmp_path / "out") == sorted(f"{s}/{r}.{name}.{len(v)}.bin" for (s, r), v in wanted.items())
        for (s, r), v in wanted.items():
            assert (tmp_path / f"out/{s}/{r}.{name}.{len(v)}.bin").read_bytes() == v.tobytes()


def test_unsigned_arrays(spark, tmp_path):
    write = lambda rows: table(spark, rows, "int").write.format("array_files").option("unsigned", "true").option("path", str(tmp_path / "u")).mode("append").save()
    write([("s", "a", [0, 1, 2**31 - 1])])
    assert np.fromfile(tmp_path / "u/s/a.u32.3.bin", "<u4").tolist() == [0, 1, 2**31 - 1]
    with pytest.raises(Exception, match="below zero"):
        write([("s", "b", [-1])])
    assert files(tmp_path / "u") == ["s/a.u32.3.bin"]


@pytest.mark.parametrize("bad, said", [((None, "r", [1]), "no file"), (("s", "../r", [1]), "no file"), (("s", "r", None), "no file"), (("s", "r", [1, None]), "null"), (("s", "r0", [9]), "one name|are called")])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad, said):
    rows = [("s", f"r{i}", [i]) for i in range(20)]
    with pytest.raises(Exception, match=said):
        table(spark, [*rows, bad]).write.format("array_files").option("path", str(tmp_path / "out")).mode("append").save()
    assert files(tmp_path / "out") == []
    table(spark, rows).write.format("array_files").option("path", str(tmp_path / "out")).mode("append").save()
    before = files(tmp_path / "out")
    with pytest.raises(Exception, match="already"):
        table(spark, rows[:1]).write.format("array_files").option("path", str(tmp_path / "out")).mode("append").save()
    assert files(tmp_path / "out") == before and len(before) == 20


def plain_records(data, start, end):
    out, at = [], 0
    current = [0, [], "stray"]
    for raw in data.splitlines(keepends=True):
        line = raw.rstrip(b"\n").removesuffix(b"\r")
        if line.startswith(start):
            out.append(current)
            current = [at, [line], "unterminated" if end else "whole"]
        elif current[2] == "unterminated" and line == end:
            out.append([current[0], [*current[1], line], "whole"])
            current = [at, [], "stray"]
        elif current[2] != "stray" or line.strip():
            if current[2] == "stray" and not current[1]:
                current[0] = at
            current[1].append(line)
        at += len(raw)
    return [(o, [x.decode("utf-8", "replace") for x in lines], s) for o, lines, s in [*out, current] if lines]


TEXTS = [b"", b"\n\nhead\nID a\nx\n\n//\nlost\n\nID b\r\ny\r\nID c\n//\nID d\nend", b"ID \n" * 5, b"no records\nat all", "ID é\nñ//\n//\n".encode() + b"\xff\nID z\n//"]


@pytest.mark.parametrize("end", [None, b"//"])
@pytest.mark.parametrize("data", TEXTS)
def test_cuts_make_no_difference(tmp_path, data, end):
    (tmp_path / "f").write_bytes(data)
    want = plain_records(data, b"ID ", end)
    for split in range(1, len(data) + 2):
        reader = RecordReader({"path": str(tmp_path), "start": "ID ", "split_bytes": str(split)} | ({"end": end.decode()} if end else {}))
        parts = reader.partitions()
        assert not data or len(parts) == -(-len(data) // split)
        got = [tuple(r.values())[1:] for p in parts for b in reader.read(p) for r in b.to_pylist()]
        assert got == want


def test_records_of_a_large_file(spark, tmp_path):
    rnd = random.Random(2)
    data = b"".join(b"ID %d\n" % i + b"line\n" * rnd.randint(0, 9) + (b"//\n" if i % 10 else b"") for i in range(3000))
    (tmp_path / "plain").write_bytes(data)
    with gzip.open(tmp_path / "packed.gz", "wb") as f:
        f.write(data)
    found = spark.read.format("marked_records").option("start", "ID ").option("end", "//").option("split_bytes", "5000").load(f"file://{tmp_path}").collect()
    want = plain_records(data, b"ID ", b"//")
    for name in ("plain", "packed.gz"):
        assert sorted((r.offset, tuple(r.lines), r.state) for r in found if r.path.endswith(name)) == [(o, tuple(x), s) for o, x, s in want]
    assert collections.Counter(r.state for r in found)["unterminated"] == 600


def pages(folder, rows, per_file=40):
    for i in range(0, len(rows), per_file):
        pq.write_table(pa.table({"k": [r[0] for r in rows[i : i + per_file]], "v": [r[1] for r in rows[i : i + per_file]]}), folder / f"{i:05}.parquet", row_group_size=13)


@pytest.mark.parametrize("shuffled", [False, True])
def test_pages_cover_the_table(tmp_path, shuffled):
    rows = [(k // 2 if k < 60 else k, f"v{k}") for k in range(300)]
    if shuffled:
        random.Random(3).shuffle(rows)
    pages(tmp_path, rows)
    table, after, seen = Pages({"path": str(tmp_path), "key": "k", "page": "7"}), None, []
    while (page := table.rows(after)).num_rows:
        got = list(zip(*page.to_pydict().values(), strict=True))
        assert 7 <= len(got) <= 8 or len(seen) + len(got) == 300
        assert sorted(got) == sorted(zip(*table.rows(after, got[-1][0]).to_pydict().values(), strict=True))
        seen, after = seen + got, got[-1][0]
    assert sorted(seen) == sorted(rows) and [k for k, _ in seen] == sorted(k for k, _ in rows)


def test_a_stopped_stream_goes_on_behind_its_cursor(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [(k, f"v{k}") for k in range(0, 500, 2)]
    pages(tmp_path / "in", rows)
    taken = []

    def run(most):
        batches = []

        def take(df, number):
            got = [tuple(r) for r in df.collect()]
            batches.append(got)
            if len(batches) == most:
                raise RuntimeError("stopped here")
            taken.extend(got)

        source = spark.readStream.format("keyset_pages").option("path", f"file://{tmp_path}/in").option("key", "k").option("page", "60").load()
        query = source.writeStream.foreachBatch(take).option("checkpointLocation", f"file://{tmp_path}/point").trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        except Exception as e:
            assert "stopped here" in str(e)
        finally:
            query.stop()
        return batches

    first = run(3)
    assert [len(b) for b in first] == [60, 60, 60]
    again = run(0)
    assert again[0] == first[2]  # the page that was not committed comes again
    assert taken == rows


def test_many_ranges_are_few_tasks(tmp_path, monkeypatch):
    monkeypatch.setattr("tallyforge.sources.marked_records.TASKS", 7)
    want = []
    for name in ("a", "b", "c"):
        data = b"".join(b"ID %d\n%s" % (i, b"x\n" * (i % 4)) for i in range(90))
        (tmp_path / name).write_bytes(data)
        want += plain_records(data, b"ID ", None)
    parts = (reader := RecordReader({"path": str(tmp_path), "start": "ID ", "split_bytes": "9"})).partitions()
    assert len(parts) <= 7
    assert [tuple(r.values())[1:] for p in parts for b in reader.read(p) for r in b.to_pylist()] == want
