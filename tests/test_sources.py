"""Readers, decoders and writers on tiny files, damaged ones included."""

import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.functions.text import code_units, packed_ratio, strip_accents, word_pieces
from tallyforge.sources import binary as B
from tallyforge.sources import sinks
from tallyforge.sources import tables as T
from tallyforge.streaming.audits import audit_batches, windowed_totals


def put(path, text):
    path.write_text(text)
    return str(path)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_lines_and_fields(spark, tmp_path):
    path = put(tmp_path / "a.txt", "# note\n1 2\n\n3  4 \n5 6 7\n8 8\n")
    assert rows(T.lines(spark, path), "line", "value")[0] == (1, "# note")
    assert rows(T.fields(T.lines(spark, path), 2), "line") == [(2,), (4,), (6,)]
    assert rows(T.edges(spark, path), "src", "dst") == [(1, 2), (3, 4)]
    assert rows(T.fixed_width(T.lines(spark, path).where("line = 2"), {"a": (0, 1), "b": (2, 3)}), "a", "b") == [("1", "2")]


def test_headers(spark, tmp_path):
    path = put(tmp_path / "b.txt", "junk\n#Y A B\n1 2\n#Y C D\n3 4\n5 6\n")
    found = T.inherited_headers(T.lines(spark, path), F.col("value").startswith("#Y"))
    assert rows(found, "header", "value") == [("#Y A B", "1 2"), ("#Y C D", "3 4"), ("#Y C D", "5 6")]
    assert rows(T.after_header(T.lines(spark, path), "#Y C"), "value") == [("3 4",), ("5 6",)]
    assert rows(T.blocks(T.lines(spark, path), F.col("value").startswith("#")), "record", F.size("values")) == [(1, 2), (2, 3)]
    assert rows(T.multi_line(T.lines(spark, path), 3), "record", F.size("values")) == [(0, 3), (1, 3)]


def test_short_and_malformed_records_are_kept(spark, tmp_path):
    path = put(tmp_path / "m.txt", "@a\nACGT\n+\nIIII\n@b\n\n+\nII\nc\nAC\n+\nII\n@d\nA\n")
    found = T.multi_line(T.lines(spark, path), 4, ["@", "", "+", ""])
    assert rows(found, "record", "state", F.size("values")) == [(0, "whole", 4), (1, "short", 3), (2, "malformed", 4), (3, "short", 2)]
    with pytest.raises(ValueError, match="markers"):
        T.multi_line(T.lines(spark, path), 4, ["@"])


@pytest.mark.parametrize("stretch", [1, 3, 1 << 16])
def test_stretches_make_no_difference(spark, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr("tallyforge.sources.tables.STRETCH", stretch)
    text = ["x", *("#%d" % i if i % 5 == 2 or i > 37 else f"v{i}" for i in range(40)), "y"]
    path = put(tmp_path / "s.txt", "\n".join(text))
    header, want, records = None, [], []
    for line in text:
        if line.startswith("#"):
            header = line
            records.append([line])
        elif header:
            want.append((header, line))
            records[-1].append(line)
    is_header = F.col("value").startswith("#")
    assert rows(T.inherited_headers(T.lines(spark, path), is_header), "header", "value") == sorted(want)
    assert [r["values"] for r in T.blocks(T.lines(spark, path), is_header).orderBy("record").collect()] == records


def test_lines_are_numbered_where_they_are_read(spark, tmp_path):
    path = put(tmp_path / "n.txt", "a\nb\n")
    plan = T.lines(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    lines_side = plan[: plan.index("Aggregate")]
    assert "rightHint=(strategy=broadcast)" in plan and "Window [row_number" not in plan, "lines are not sorted or shuffled"
    assert lines_side.count("Join") == 1


def test_lines_of_blocks_are_shuffled_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyforge.sources.tables.STRETCH", 4)
    for name, n in (("a.txt", 30), ("b.txt", 3)):  # a long record over stretches without a start, then several in one stretch
        put(tmp_path / name, "\n".join(["lost", "#1", *(f"v{i}" for i in range(n)), "#2", "#3", "w", "#4"]))
    found = T.blocks(T.lines(spark, str(tmp_path)), F.col("value").startswith("#"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_id") == 1 and "record" not in " ".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    want = [(r, at, n) for k in (30, 3) for r, at, n in ((1, 2, k + 1), (2, k + 3, 1), (3, k + 4, 2), (4, k + 6, 1))]
    assert rows(found, "record", "first_line", F.size("values")) == sorted(want)


def test_items_without_their_order_are_no_lines(spark):
    from tallyforge.plans import readers

    tables = {
        "orders": spark.createDataFrame([(1,), (2,)], "o_orderkey long"),
        "lineitem": spark.createDataFrame([(1, 1, 7, 2.0), (1, 2, 8, 3.0), (3, 1, 9, 4.0), (None, 1, 9, 4.0)], "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double"),
    }
    for query in (readers.blocks_of_lines, readers.records_by_byte_range):
        assert rows(query(tables.get), "o_orderkey", "items", "quantity") == [(1, 2, 5), (2, 0, 0)]
    plan = readers._items(tables.get)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, "orders and items are dealt once"


def test_more_stretches_are_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyforge.sources.tables.STRETCH", 8)
    path = put(tmp_path / "t.txt", "\n".join("#h" if i % 9 == 0 else f"v{i}" for i in range(1000)))
    found = T.inherited_headers(T.lines(spark, path), F.col("value").startswith("#"))
    assert found.count() == 888 and found.rdd.getNumPartitions() > 16, "a task's share stays as it is when a file grows"


def test_csv(spark, tmp_path):
    path = put(tmp_path / "c.csv", "Start_Lat,b\n1.5,x\n")
    assert T.checked_csv(spark, path, ["b"]).columns == ["Start_Lat", "b"]
    with pytest.raises(ValueError, match="no column z"):
        T.checked_csv(spark, path, ["z"])
    assert T.aliased(T.checked_csv(spark, path, []), {"lat": ["startLat"], "b": []}).columns == ["lat", "b"]
    with pytest.raises(ValueError, match="no column for q"):
        T.aliased(T.checked_csv(spark, path, []), {"q": []})


def test_nested(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [9, 8]), (2, [], [5])], "k int, a array<int>, b array<int>")
    assert rows(T.zipped(df, ["a", "b"]), "k", "ord", "a", "b") == [(1, 0, 1, 9), (1, 1, 2, 8)]
    packed = spark.createDataFrame([("w", "1990,5,2\tbad\t1991,x,3")], "word string, obs string")
    assert rows(T.observations(packed, "obs", ["y", "m", "v"]).where("m is not null"), "y", "m", "v") == [(1990, 5, 2)]
    cube = spark.createDataFrame([("u", {"0": 1.0, "5": 2.0, "99": 3.0})], "unit string, cells map<string,double>")
    assert rows(T.json_stat(cube, ["geo", "time"], [2, 3], "cells"), "geo", "time", "value") == [(0, 0, 1.0), (1, 2, 2.0)]
    listed = spark.createDataFrame([([1.0, None, None, 0.0, None, 2.0, 9.0],)], "cells array<double>")
    assert rows(T.json_stat(listed, ["geo", "time"], [2, 3], "cells"), "geo", "time", "value") == [(0, 0, 1.0), (1, 0, 0.0), (1, 2, 2.0)]


def test_matrix_market(spark, tmp_path):
    good = put(tmp_path / "m.mtx", "%%MatrixMarket matrix coordinate real general\n% c\n2 3 2\n1 1 5.5\n2 3 -1\n")
    assert rows(T.matrix_market(spark, good), "row", "col", "value") == [(1, 1, 5.5), (2, 3, -1.0)]
    bad = put(tmp_path / "n.mtx", "%%MatrixMarket matrix coordinate pattern general\n2 2 1\n3 1\n")
    with pytest.raises(Exception, match="outside the matrix"):
        T.matrix_market(spark, bad).collect()


def wave(values, channels=1):
    data = np.asarray(values, "<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, 8000, 16000 * channels, 2 * channels, 16) + b"data" + struct.pack("<I", len(data)) + data


def tiff(values, width):
    data = np.asarray(values, "<u2").tobytes()
    tags = [(256, 3, 1, width), (257, 3, 1, len(values) // width), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 1, 8), (279, 4, 1, len(data))]
    return b"II*\0" + struct.pack("<I", 8 + len(data)) + data + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0)


def las(values):
    head = bytearray(227)
    head[:4] = b"LASF"
    struct.pack_into("<I", head, 96, 227)
    struct.pack_into("<HI", head, 105, 20, len(values))
    return bytes(head) + b"".join(b"\0" * 12 + struct.pack("<H", v) + b"\0" * 6 for v in values)


def segy(traces):
    head = bytearray(3600)
    struct.pack_into(">H", head, 3220, len(traces[0]))
    struct.pack_into(">h", head, 3224, 3)
    return bytes(head) + b"".join(b"\0" * 240 + np.asarray(t, ">i2").tobytes() for t in traces)


def test_binary(spark, tmp_path):
    array = io.BytesIO()
    np.save(array, np.arange(6, dtype="f4").reshape(2, 3))
    mrc = bytearray(1024)
    struct.pack_into("<4i", mrc, 0, 2, 1, 1, 1)
    files = {
        "a.wav": (wave([1, -2, 3]), "i16", [3], [1.0, -2.0, 3.0]),
        "b.wav": (wave([1, -2, 3, 4], 2), "i16", [2, 2], [1.0, -2.0, 3.0, 4.0]),
        "c.npy": (array.getvalue(), "f32", [2, 3], [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]),
        "d.tif": (tiff([1, 2, 3, 65535], 2), "u16", [2, 2], [1.0, 2.0, 3.0, 65535.0]),
        "e.las": (las([7, 65000]), "u16", [2], [7.0, 65000.0]),
        "f.hgt": (np.array([1, 2, 3, -4], ">i2").tobytes(), "i16", [2, 2], [1.0, 2.0, 3.0, -4.0]),
        "g.mrc": (bytes(mrc) + np.array([5, -6], "<i2").tobytes(), "i16", [1, 1, 2], [5.0, -6.0]),
        "h.iq": (np.array([1, 2, 3, 4], "<i2").tobytes(), "i16", [2, 2], [1.0, 2.0, 3.0, 4.0]),
        "i.sgy": (segy([[1, 2]]), "i16", [2], [1.0, 2.0]),
    }
    for name, (data, *_) in files.items():
        (tmp_path / name).write_bytes(data)
        (tmp_path / f"cut-{name}").write_bytes(data[:-3])
    (tmp_path / "x.odd").write_bytes(b"?")
    found = B.decode_files(spark, str(tmp_path)).collect()
    good = {r.path.rpartition("/")[2]: (r.kind, r.shape, r["values"]) for r in found if r.error is None}
    assert good == {n: tuple(rest) for n, (_, *rest) in files.items()}
    assert {r.path.rpartition("/")[2] for r in found if r.error} == {*(f"cut-{n}" for n in files), "x.odd"}


@pytest.mark.parametrize("kind", sorted(B.KINDS))
def test_raw_arrays(kind):
    for order in "<>":
        values = np.array([0, 1, 100], order + B.KINDS[kind])
        (got,) = B.raw(kind, order == ">")(values.tobytes())
        assert got[3].tolist() == values.tolist()


def test_binary_odd_layouts(spark, tmp_path):
    high = [9223372036854775807, -9007199254740993]
    late = bytearray(las([7, 65000]))
    late[25:26], late[107:111] = b"\x04", bytes(4)
    late[96:100] = struct.pack("<I", 255)
    late[227:227] = bytes(20) + struct.pack("<Q", 2)
    varying = bytearray(segy([[1, 2]]))
    trace = bytearray(240)
    struct.pack_into(">H", trace, 114, 3)
    files = {
        "a.npy": io.BytesIO(),
        "b.npy": io.BytesIO(),
        "c.las": io.BytesIO(bytes(late)),
        "d.sgy": io.BytesIO(bytes(varying + trace) + np.array([3, 4, 5], ">i2").tobytes()),
        "e.tif": io.BytesIO(tiff([1, 2, 3, 4, 5], 2)),
    }
    np.save(files["a.npy"], np.array(high))
    np.save(files["b.npy"], np.array([1 << 63], np.uint64))
    for name, data in files.items():
        (tmp_path / name).write_bytes(data.getvalue())
    found = sorted((r.path[-5:], r.record, r["values"], r.longs, r.error) for r in B.decode_files(spark, str(tmp_path)).collect())
    assert found == [
        ("a.npy", 0, None, high, None),
        ("b.npy", 0, None, None, "beyond 64 signed bits"),
        ("c.las", 0, [7.0, 65000.0], None, None),
        ("d.sgy", 0, [1.0, 2.0], None, None),
        ("d.sgy", 1, [3.0, 4.0, 5.0], None, None),
        ("e.tif", 0, None, None, "strips do not fit the image"),
    ]


def test_zip_and_sinks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "1,2")
    assert rows(B.zip_members(spark, str(tmp_path / "z.zip")), "member", F.col("content").cast("string")) == [("m.csv", "1,2")]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    out = str(tmp_path / "out")
    sinks.write_records(df, out, partition=["k"])
    sinks.write_records(df.where("k = 'a'").withColumn("v", F.lit(9)), out, partition=["k"])
    assert rows(spark.read.parquet(out), "k", "v") == [("a", 9), ("b", 2)]
    sinks.write_index(df, f"{out}-index")
    assert rows(spark.read.json(f"{out}-index"), "k", "v") == [("a", 1), ("b", 2)]
    sinks.write_report(df, f"{out}-report")
    assert sinks.markdown(df.orderBy("v")).splitlines()[2] == "| 1 | a |"


def test_parsing(spark):
    texts = ["1.5", " 2 ", "", "nan", "1d", "1e400", "12.0", "12.5", "9223372036854775808", ".5", "10.00K", "2m", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = [tuple(r) for r in df.select(P.safe_float(t), P.safe_integral(t), P.suffixed(t)).collect()]
    assert [g[0] for g in got] == [1.5, 2.0, None, None, None, None, 12.0, 12.5, 9223372036854775808.0, 0.5, None, None, None]
    assert [g[1] for g in got] == [None, 2, None, None, None, None, 12, None, None, None, None, None, None]
    assert got[10][2] == 10_000.0 and got[11][2] == 2e6
    one = spark.range(1)
    assert tuple(one.select(P.clock_seconds(F.lit("25:01:02")), P.full_year(F.lit(69)), P.full_year(F.lit(70)), P.snake(F.lit("HTTPCode")), P.clamp(F.lit(7.0), 0.0, 5.0)).first()) == (90062, 2069, 1970, "http_code", 5.0)
    assert [r[0] for r in spark.createDataFrame([('{"a": true}',), ('{"a": 1}',), ('{"a": "true"}',), ('{"a": false}',), ("{",), (None,)], "j string").select(P.strict_bool(F.col("j"), "$.a")).collect()] == [1, None, None, 0, None, None]


def test_streaming(spark, tmp_path):
    events = spark.createDataFrame([(f"2024-01-01 00:0{i}:00", "a", float(i)) for i in range(5)], "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    audit_batches(stream, ["event_type"], "value", str(tmp_path / "audit"), str(tmp_path / "cp1")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "audit")), "event_type", "value_count", "status") == [("a", 5, "ok")]
    query = windowed_totals(stream).writeStream.format("memory").queryName("totals").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("totals"), "event_type", "n", "total") == [("a", 5, 10.0)]


def test_texts(spark):
    df = spark.createDataFrame([(1, "Éa"), (2, ""), (3, None), (4, "a🙂")], "k int, t string")
    got = {r.k: (r.plain, r.units, r.ratio) for r in df.select("k", strip_accents("t").alias("plain"), code_units(F.col("t")).alias("units"), packed_ratio(F.encode("t", "UTF-8")).alias("ratio")).collect()}
    assert got[1][:2] == ("Ea", [201, 97]) and got[2] == ("", [], None) and got[3][0] is None and got[4][1] == [97, 0xD83D, 0xDE42]
    pieces = word_pieces({"un": 1, "##able": 2, "##aff": 3, "a": 4}, 0)
    words = spark.createDataFrame([("unaffable",), ("a",), ("b",), ("una",)], "w string")
    assert [r[0] for r in words.select(pieces("w")).collect()] == [[1, 3, 2], [4], [0], [0]]


def test_dictionary_capacity(spark):
    from tallyforge.operators.records import dictionary

    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 0), ("b", 3)], "v string, o int")
    assert rows(dictionary(df, "v", "o", capacity=2), "v", "code") == [("a", 2), ("b", 1)]
    with pytest.raises(Exception, match="more than 1 values"):
        dictionary(df, "v", capacity=1).collect()


def test_dumped_pages_on_shelves(spark, tmp_path, monkeypatch):
    from tallyforge.plans import readers

    class Here:
        def __init__(self, *_):
            self.base = f"file://{tmp_path}/files"

    monkeypatch.setattr(readers, "Scratch", Here)
    ids = [*range(0, 60_000, 50), 24_999, 25_000, None]
    events = spark.createDataFrame([(i, 7) for i in ids], "event_id long, user_id long")
    got = readers.pages_in_order(lambda _: events).orderBy("place").collect()
    assert [r.event_id for r in got] == [*sorted(i for i in ids if i is not None), None]
    assert [r.place for r in got] == list(range(1, len(ids) + 1))
    pages = [f for f in (tmp_path / "files/pages").rglob("*") if f.is_file()]
    assert len(pages) == 601 and len({f.parent for f in pages}) == 4


def test_dumped_pages_of_uneven_sizes(spark, tmp_path):
    for k, n in enumerate([3, 0, 1, 12, None, 2]):
        (tmp_path / f"p{k}.json").write_text("{}" if n is None else json.dumps({"results": [{"v": 100 * k + i} for i in range(n)]}, indent=1))
    got = T.dumped_pages(spark, str(tmp_path), "v: bigint").orderBy("place").collect()
    assert [(r.place, r.v, r.ord) for r in got] == [(p + 1, 100 * k + i, i) for p, (k, i) in enumerate((k, i) for k, n in enumerate([3, 0, 1, 12, 0, 2]) for i in range(n))]
