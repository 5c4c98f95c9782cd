"""Readers, writers and strict checks at work: a table is written as files of some shape, in many tasks, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators import strict
from tallyforge.operators.records import shards
from tallyforge.registry import Tables, query
from tallyforge.session import Scratch
from tallyforge.sources import tables as T
from tallyforge.sources.array_files import ArrayFiles, TextFiles
from tallyforge.sources.marked_records import MarkedRecords


def written(rows: DataFrame, keys: list[str], order: list[str], line: Column, name: str, *, dealt: bool = False) -> str:
    """The folder of text files that hold the rows' lines; rows of one key lie in one file, in order. ``dealt``: they lie in one partition already."""
    path = f"{Scratch(rows.sparkSession, 'files').base}/{name}"
    (rows if dealt else rows.repartition(*keys)).sortWithinPartitions(*keys, *order).select(line.alias("value")).write.text(path)
    return path


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


@query("SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents, o_orderpriority FROM orders")
def csv_by_other_names(t: Tables) -> DataFrame:
    """A CSV file with a header whose names differ from those asked for in case and signs."""
    orders = t("orders").select(F.col("o_orderkey").alias("Order-Key"), cents("o_totalprice").alias("TOTAL_cents"), F.col("o_orderpriority").alias("o_orderpriority"))
    path = f"{Scratch(orders.sparkSession, 'files').base}/csv"
    orders.write.option("header", True).csv(path)
    found = T.checked_csv(orders.sparkSession, path, ["Order-Key", "TOTAL_cents"])
    named = T.aliased(found, {"o_orderkey": ["order key"], "cents": ["total cents"], "o_orderpriority": []})
    return named.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("cents").cast("bigint").alias("cents"), "o_orderpriority")


@query("SELECT c_custkey % 10 = 3 AS short, count(*) AS n, sum(CASE WHEN c_custkey % 10 <> 3 THEN c_nationkey END)::BIGINT AS nations FROM customer GROUP BY 1")
def rows_without_header(t: Tables) -> DataFrame:
    """Rows by position alone; those with too few fields are kept apart, not lost."""
    key = F.col("c_custkey")
    line = F.when(key % 10 == 3, key.cast("string")).otherwise(F.concat_ws(",", key.cast("string"), F.concat(F.lit('"a, '), "c_mktsegment", F.lit('"')), F.col("c_nationkey").cast("string")))
    path = written(t("customer"), ["c_custkey"], [], line, "rows")
    found = T.positional(t("customer").sparkSession, path, ["key", "segment", "nation"], 3)
    return found.groupBy(F.col("corrupt").isNotNull().alias("short")).agg(F.count("*").alias("n"), F.sum(F.col("nation").cast("bigint")).alias("nations"))


@query("SELECT p_partkey, p_size::BIGINT AS size FROM part WHERE p_partkey % 7 <> 2 AND p_partkey % 11 <> 5")
def fields_of_lines(t: Tables) -> DataFrame:
    """Fields between any white space; comments and lines of another number of fields are left out."""
    key = F.col("p_partkey")
    line = F.when(key % 7 == 2, F.concat(F.lit("  # "), key.cast("string"), F.lit(" 1"))).when(key % 11 == 5, key.cast("string")).otherwise(F.concat(F.lit(" "), key.cast("string"), F.lit(" \t  "), F.col("p_size").cast("string"), F.lit("\r")))
    path = written(t("part"), ["p_partkey"], [], line, "fields")
    found = T.fields(T.lines(t("part").sparkSession, path), 2)
    return found.select(F.col("fields")[0].cast("bigint").alias("p_partkey"), F.col("fields")[1].cast("bigint").alias("size"))


@query("SELECT s_suppkey, s_nationkey::BIGINT AS nation, trim(s_name) AS name FROM supplier")
def columns_of_lines(t: Tables) -> DataFrame:
    """Columns cut out of lines by their places."""
    line = F.concat(F.lpad(F.col("s_suppkey").cast("string"), 10, " "), F.rpad("s_name", 24, " "), F.lpad(F.col("s_nationkey").cast("string"), 4, " "))
    path = written(t("supplier"), ["s_suppkey"], [], line, "columns")
    found = T.fixed_width(T.lines(t("supplier").sparkSession, path), {"key": (0, 10), "name": (10, 34), "nation": (34, 38)})
    return found.select(F.col("key").cast("bigint").alias("s_suppkey"), F.col("nation").cast("bigint").alias("nation"), "name")


def _items(t: Tables, *, ended: bool = False) -> DataFrame:
    """Orders' lines: an order's first line names it, then come its items' lines, and an end mark where ``ended``; dealt by order, by one shuffle."""
    rows = t("lineitem").where("l_orderkey is not null").select(F.col("l_orderkey").alias("k"), F.lit(1).alias("at"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    for at in (0, 2) if ended else (0,):
        rows = rows.unionByName(t("orders").select(F.col("o_orderkey").alias("k"), F.lit(at).alias("at"), F.lit(0).cast("int").alias("l_linenumber"), F.lit(0).cast("bigint").alias("l_partkey"), F.lit(0).cast("bigint").alias("q")))
    first = F.first("at").over(W.partitionBy("k").orderBy("at", "l_linenumber").rowsBetween(W.unboundedPreceding, 0))
    return rows.repartition("k").withColumn("_head", first).where("_head = 0").drop("_head")


def _line() -> Column:
    return F.when(F.col("at") == 0, F.concat(F.lit("ID "), F.col("k").cast("string"))).otherwise(F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("q").cast("string")))


@query("SELECT o_orderkey, l_partkey, l_quantity::BIGINT AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def headers_midway(t: Tables) -> DataFrame:
    """Data lines with the last header line above them."""
    path = written(_items(t), ["k"], ["at", "l_linenumber"], _line(), "headers", dealt=True)
    found = T.inherited_headers(T.lines(t("orders").sparkSession, path), F.col("value").startswith("ID "))
    parts = F.split("value", " ")
    return found.select(F.substring("header", 4, 20).cast("bigint").alias("o_orderkey"), parts[0].cast("bigint").alias("l_partkey"), parts[1].cast("bigint").alias("quantity"))


RECORDS_SQL = "SELECT o_orderkey, count(l_orderkey) AS items, coalesce(sum(l_quantity::BIGINT), 0)::BIGINT AS quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1"


def _summed(found: DataFrame, values: str) -> DataFrame:
    items = F.filter(F.slice(values, F.lit(2), F.size(values)), lambda x: x != "//")
    total = F.aggregate(F.transform(items, lambda x: F.split(x, " ")[1].cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return found.select(F.substring(F.col(values)[0], 4, 20).cast("bigint").alias("o_orderkey"), F.size(items).cast("bigint").alias("items"), total.alias("quantity"))


@query(RECORDS_SQL)
def blocks_of_lines(t: Tables) -> DataFrame:
    """Records that begin at a marked line, gathered from lines."""
    path = written(_items(t), ["k"], ["at", "l_linenumber"], _line(), "blocks", dealt=True)
    return _summed(T.blocks(T.lines(t("orders").sparkSession, path), F.col("value").startswith("ID ")), "values")


@query(RECORDS_SQL)
def records_by_byte_range(t: Tables) -> DataFrame:
    """The same records, with an end mark, out of byte ranges of the files."""
    spark = t("orders").sparkSession
    path = written(_items(t, ended=True), ["k"], ["at", "l_linenumber"], F.when(F.col("at") == 2, "//").otherwise(_line()), "ranges", dealt=True)
    spark.dataSource.register(MarkedRecords)
    found = spark.read.format("marked_records").option("start", "ID ").option("end", "//").option("split_bytes", str(64 << 10)).load(path)
    return _summed(found.where("state = 'whole'"), "lines")


@query("SELECT p_partkey, CASE WHEN p_partkey % 13 = 4 THEN 'malformed' ELSE 'whole' END AS state, p_name FROM part")
def records_of_four_lines(t: Tables) -> DataFrame:
    """Records of four lines, each line with its marker; one that lacks a marker is kept and said to be malformed."""
    key = F.col("p_partkey")
    text = F.concat_ws("\n", F.concat(F.when(key % 13 == 4, "!").otherwise("@"), key.cast("string")), F.col("p_name"), F.lit("+"), F.lit("@same"))
    path = written(t("part"), ["p_partkey"], [], text, "four")
    found = T.multi_line(T.lines(t("part").sparkSession, path), 4, ["@", "", "+", ""])
    return found.select(F.substring(F.col("values")[0], 2, 20).cast("bigint").alias("p_partkey"), "state", F.col("values")[1].alias("p_name"))


@query("SELECT event_id % 9 = 2 AS broken, count(*) AS n, sum(CASE WHEN event_id % 9 <> 2 THEN user_id END)::BIGINT AS users FROM events GROUP BY 1")
def objects_of_lines(t: Tables) -> DataFrame:
    """An object a line; lines that are none are kept as they are."""
    text = F.when(F.col("event_id") % 9 == 2, F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct("event_id", "user_id")))
    path = written(t("events"), ["event_id"], [], text, "objects")
    found = T.json_lines(t("events").sparkSession, path, "event_id long, user_id long")
    return found.groupBy(F.col("corrupt").isNotNull().alias("broken")).agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS region FROM nation")
def elements_of_documents(t: Tables) -> DataFrame:
    """Elements of XML documents, one a region, attributes beside them."""
    row = F.concat(F.lit('<row id="'), F.col("n_nationkey").cast("string"), F.lit('"><name>'), F.col("n_name"), F.lit("</name><region>"), F.col("n_regionkey").cast("string"), F.lit("</region></row>"))
    texts = t("nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.concat(F.lit("<all><group>"), F.array_join(F.collect_list(row), ""), F.lit("</group></all>")).alias("value"))
    path = f"{Scratch(texts.sparkSession, 'files').base}/xml"
    texts.write.partitionBy("r").text(path)
    found = T.xml_rows(t("nation").sparkSession, path, "row", "_id long, name string, region long")
    return found.select(F.col("_id").alias("n_nationkey"), F.col("name").alias("n_name"), "region")


@query("SELECT l_orderkey, count(*) AS lines, sum(l_quantity::BIGINT)::BIGINT AS quantity FROM lineitem GROUP BY 1")
def labelled_strictly(t: Tables) -> DataFrame:
    """Items joined with their labels, which all must have, their lists paired place by place, their numbers within bounds and one status a line: each a check that would end the job."""
    labels = t("lineitem").select("l_orderkey").distinct().withColumn("label", F.col("l_orderkey") * 2)
    rows = strict.known(t("lineitem").select("l_orderkey", "l_linenumber", strict.bounded(F.col("l_quantity"), 0, 50).alias("q")), labels, "l_orderkey")
    lists = rows.groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("a"), F.collect_list("q").alias("b"), F.first("label").alias("label"))
    pairs = lists.select("l_orderkey", F.explode(strict.zipped(F.col("a"), F.col("b"))).alias("z"), "label")
    sums = pairs.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("z.b").alias("quantity"))
    one = strict.unique(pairs.select("l_orderkey", "label"), ["l_orderkey"], "label")
    return sums.join(one.where("label = l_orderkey * 2"), "l_orderkey").select("l_orderkey", "lines", "quantity")


@query("SELECT p_brand AS series, count(*) AS bytes, sha256(unhex(string_agg(printf('%02x', p_size), '' ORDER BY p_partkey))) AS digest FROM part GROUP BY 1")
def arrays_of_series(t: Tables) -> DataFrame:
    """Series written as raw arrays, a file a record of up to 64 values, and read back."""
    spark = t("part").sparkSession
    rows = shards(t("part").select(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_").alias("series"), "p_partkey", F.col("p_size").cast("byte").alias("v")), ["series"], ["p_partkey"], 64)
    arrays = rows.groupBy("series", F.lpad(F.col("shard").cast("string"), 12, "0").alias("record")).agg(F.transform(F.array_sort(F.collect_list(F.struct("offset", "v"))), lambda e: e["v"]).alias("values"))
    path = f"{Scratch(spark, 'files').base}/arrays"
    spark.dataSource.register(ArrayFiles)
    arrays.write.format("array_files").option("path", path).option("unsigned", "true").mode("append").save()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select(F.regexp_extract("path", "([^/]+)/([^/.]+)[.]u8[.][0-9]+[.]bin$", 1).alias("file"), F.regexp_extract("path", "([^/]+)/([^/.]+)[.]u8", 2).alias("record"), F.hex("content").alias("h"))
    whole = named.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record", "h"))), lambda e: e["h"]), "").alias("h"))
    return whole.select(F.regexp_replace("file", "_", "#").alias("series"), (F.length("h") / 2).cast("bigint").alias("bytes"), F.sha2(F.unhex("h"), 256).alias("digest"))


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS place FROM events")
def pages_in_order(t: Tables) -> DataFrame:
    """A table dumped as page files of a hundred rows, on shelves of 250 pages, read back in the order of pages and places."""
    spark, page = t("events").sparkSession, F.expr("event_id div 100")
    named = lambda c, prefix="": F.concat(F.lit(prefix), F.coalesce(F.lpad(c.cast("string"), 17, "0"), F.lit("none")))
    rows = t("events").select("event_id", "user_id", named(page).alias("record"), named(F.expr("event_id div 25000"), "shelf=").alias("series"))
    body = F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("event_id", "user_id"))).alias("results")))
    pages = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "series").groupBy("series", "record").agg(body.alias("value"))
    path = f"{Scratch(spark, 'files').base}/pages"
    spark.dataSource.register(TextFiles)
    pages.write.format("text_files").option("path", path).mode("append").save()
    return T.dumped_pages(spark, path, "event_id: bigint, user_id: bigint").select("event_id", "user_id", "place")
