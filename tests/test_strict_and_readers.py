"""Checks that end a job, readers of the remaining text shapes, and plans whose shape matters."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.operators import strict
from tallyforge.queries import QUERIES
from tallyforge.sources import sinks
from tallyforge.sources import tables as T
from tests.test_queries import SF


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"file://{tmp_path}/{name}"


def test_checks_pass_good_rows_and_name_bad_keys(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 10), (2, 20)], "k int, v int")
    assert rows(strict.unique(pairs, ["k"], "v")) == [(1, 10), (2, 20)]
    with pytest.raises(Exception, match="different values for 7"):
        strict.unique(pairs.union(spark.createDataFrame([(7, 1), (7, 2)])), ["k"], "v").collect()
    labels = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    assert rows(strict.known(pairs, labels, "k"), "k", "name") == [(1, "a"), (1, "a"), (2, "b")]
    with pytest.raises(Exception, match="no label for k 9"):
        strict.known(pairs.union(spark.createDataFrame([(9, 1)])), labels, "k").collect()
    assert rows(pairs.select(strict.bounded(F.col("v"), 0, 20).alias("v"))) == [(10,), (10,), (20,)]
    assert spark.range(1).select(strict.bounded(F.lit(None).cast("int"), 0, 1).alias("v")).first().v is None
    with pytest.raises(Exception, match="outside .0, 19.: 20"):
        pairs.select(strict.bounded(F.col("v"), 0, 19).alias("v")).collect()
    lists = spark.createDataFrame([([1, 2], ["a", "b"])], "a array<int>, b array<string>")
    assert lists.select(strict.zipped(F.col("a"), F.col("b")).alias("z")).first().z[1].b == "b"
    with pytest.raises(Exception, match="different length: 2 1"):
        lists.select(strict.zipped(F.col("a"), F.slice("b", 1, 1)).alias("z")).collect()
    topics = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(strict.one_per_topic(topics, spark.createDataFrame([(1, 5), (3, 6)], "k int, v int"), "k", "v")) == [(1, 5), (3, 6)]
    with pytest.raises(Exception, match="more than one candidate for k 1"):
        strict.one_per_topic(topics, spark.createDataFrame([(1, 5), (1, 6)], "k int, v int"), "k", "v").collect()


def test_lines_of_a_split_file_keep_their_places(spark, tmp_path):
    text = "".join(f"{i}\r\n" if i % 3 else "\n" for i in range(1, 4001)) + "end"
    path = write(tmp_path, "a.txt", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        expected = [(i, str(i)) for i in range(1, 4001) if i % 3] + [(4001, "end")]
        assert sorted(tuple(r) for r in T.lines(spark, path).select("line", "value").collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_readers(spark, tmp_path):
    path = write(tmp_path, "p.csv", 'a,1,"x,y"\n\nb,2\nc;3\n')
    assert rows(T.positional(spark, path, ["n", "i"], 2)) == [("a", "1", None), ("b", "2", None), (None, None, "c;3")]
    path = write(tmp_path, "j.jsonl", '{"a": 1}\n\n{"a": 2, "b": "x"}\nnot json\n')
    assert rows(T.json_lines(spark, path, "a int, b string")) == [(1, None, None), (2, "x", None), (None, None, "not json")]
    path = write(tmp_path, "r.tsv", "id\tstatus\n1\tactive\n")
    assert rows(T.registry(spark, path, ["id", "status"])) == [("1", "active")]
    for other in (["status", "id"], ["id"], ["id", "status", "x"]):
        with pytest.raises(ValueError, match="columns are id, status"):
            T.registry(spark, path, other)
    path = write(tmp_path, "m.xml", '<osm><way id="5"><nd ref="1"/><nd ref="2"/></way><way id="6"><nd ref="3"/></way><way id="5"><nd ref="9"/></way></osm>')
    ways = T.xml_rows(spark, path, "way", "_id long, nd array<struct<_ref:long>>").select("_id", F.col("nd._ref").alias("refs"))
    assert rows(ways) == [(5, [1, 2]), (5, [9]), (6, [3])]
    assert rows(T.unique_entries(ways, "_id", ["refs"])) == [(5, [1, 2]), (6, [3])]
    path = write(tmp_path, "n.json", json.dumps({"site": "s", "series": {"points": [{"t": 1, "v": 2.5}, {"t": 2}]}}))
    assert rows(T.nested(spark, path, "site string, series struct<points:array<struct<t:int,v:double>>>", "series.points")) == [("s", 0, 1, 2.5), ("s", 1, 2, None)]
    for sep in ";\t|":
        assert rows(T.checked_csv(spark, write(tmp_path, f"{ord(sep)}.csv", f"a{sep}b\n1{sep}2\n"), ["a", "b"], sep=sep)) == [("1", "2")]


def test_compressed_text_is_read(spark, tmp_path):
    import bz2
    import gzip

    for name, pack in (("a.txt.gz", gzip.compress), ("a.txt.bz2", bz2.compress)):
        (tmp_path / name).write_bytes(pack(b"x\ny\n"))
        assert rows(T.lines(spark, f"file://{tmp_path}/{name}"), "line", "value") == [(1, "x"), (2, "y")]


def test_index_meets_files(spark, tmp_path):
    folder = tmp_path / "data"
    (folder / "s").mkdir(parents=True)
    (folder / "s" / "1.bin").write_bytes(b"12345678")
    (folder / "s" / "2.bin").write_bytes(b"1")
    index = spark.createDataFrame([("s/1.bin", 8), ("s/2.bin", 8), ("s/3.bin", 8)], "path string, size long")
    assert rows(T.with_files(spark, index, "path", "size", f"file://{folder}")) == [("s/1.bin", 8, True, True), ("s/2.bin", 8, True, False), ("s/3.bin", 8, False, None)]


def test_scalars(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    body = F.lit('{"a": true, "b": "true", "c": 1, "d": false}')
    assert [get(P.strict_bool(body, f"$.{k}")) for k in "abcde"] == [1, None, None, 0, None]
    assert get(P.file_name(F.lit("/a b//c?.txt "), 5)) == "a_b_c"
    assert [get(P.iso_seconds(F.lit(t))) for t in ("1970-01-01T00:01:00", "1970-01-01T00:01:00Z", "1970-01-01 02:00:00+02:00", "1970-13-01T00:00:00", "x")] == [60, 60, 0, None, None]
    assert get(P.with_exponent(F.lit("1.15"), F.lit("26"))) == 1.15e26 and get(P.with_exponent(F.lit("1.1"), F.lit("x"))) is None
    assert get(P.integers(F.lit(" 1  22\t3 "))) == [1, 22, 3] and get(P.integers(F.lit(""))) == []
    assert [get(P.scaled(F.lit(x), 1)) for x in (0.5, 1.5, 2.5)] == [0, 2, 2]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(5)], "v int")
    assert sinks.markdown(df, 3).splitlines()[-1] == "Only the first 3 rows are shown." and "Only" not in sinks.markdown(df, 5)
    sinks.write_summary(df.agg(F.sum("v").alias("v")), f"file://{tmp_path}/one")
    assert [json.loads(line) for f in os.listdir(tmp_path / "one") if f.startswith("part") for line in (tmp_path / "one" / f).read_text().splitlines()] == [{"v": 10}]
    with pytest.raises(ValueError, match="one row"):
        sinks.write_summary(df, f"file://{tmp_path}/two")


def test_group_limits_and_medians_are_cut_before_the_shuffle(spark):
    plan = lambda name: QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan("per_group_limits")
    assert "BroadcastHashJoin [text" in (shown := plan("eval_isolation")) and "LeftSemi, BuildRight" in shown
