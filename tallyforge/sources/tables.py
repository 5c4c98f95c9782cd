"""Readers for untidy text sources; every reader returns rows with their file and place in it.

Spark keeps no order, so whatever depends on source order sorts by (path, line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators.ranks import numbered
from tallyforge.session import Scratch


def lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1), value of every line that is not empty.

    A large file is read in splits, each by one task in order: a line's place in its split follows from its row's number, and
    the counts of the splits before it, one row a split, are added. No line is shuffled or sorted.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r$", "").alias("value"))
    counts = read.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("path", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return read.where("value <> ''").join(F.broadcast(before), ["path", "block"]).select("path", (F.col("at") + F.col("shift")).cast("bigint").alias("line"), "value")


def checked_csv(spark: SparkSession, path: str, required: list[str], *, sep: str = ",") -> DataFrame:
    """A CSV file with a header as text columns; a missing required column is an error before any row is read."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return df


def aliased(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Columns renamed by their known other names: exact match first, then without case and signs; all or none."""
    plain = lambda s: "".join(c for c in s.lower() if c.isalnum())
    found = {}
    for wanted, others in names.items():
        exact = [c for c in df.columns if c in (wanted, *others)]
        loose = [c for c in df.columns if plain(c) in {plain(x) for x in (wanted, *others)}]
        if not (hit := exact or loose):
            raise ValueError(f"no column for {wanted}")
        found[wanted] = hit[0]
    return df.select(*(F.col(f"`{c}`").alias(w) for w, c in found.items()))


def fields(rows: DataFrame, arity: int, *, sep: str = r"\s+", comment: str = "#") -> DataFrame:
    """Lines split into exactly ``arity`` fields; comments, blanks and other arities are left out."""
    parts = F.split(F.trim("value"), sep)
    return rows.where(~F.ltrim("value").startswith(comment)).withColumn("fields", parts).where(F.size("fields") == arity).drop("value")


def fixed_width(rows: DataFrame, slices: dict[str, tuple[int, int]]) -> DataFrame:
    """Columns cut out of lines by [start, stop) and trimmed."""
    return rows.select("path", "line", *(F.trim(F.substring("value", a + 1, b - a)).alias(n) for n, (a, b) in slices.items()))


def after_header(rows: DataFrame, token: str) -> DataFrame:
    """The lines after the first one that starts with ``token``, file by file."""
    head = rows.where(F.col("value").startswith(token)).groupBy("path").agg(F.min("line").alias("_head"))
    return rows.join(head, "path").where("line > _head").drop("_head")


#: Lines of a file that are put in order together, and stretches of them that a task takes.
STRETCH, STRETCHES = 1 << 16, 4


def _stretches(rows: DataFrame, *facts: Column) -> tuple[DataFrame, int]:
    """path, _s, _id (a short number) and facts of each stretch of lines; and to how many tasks stretches are dealt, so that a task's share is small whatever the files' size."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = rows.groupBy("path", F.expr(f"line div {STRETCH}").alias("_s")).agg(*facts, F.count("*").alias("_lines"))
    ends = Scratch(rows.sparkSession, "stretches").keep(ends.withColumn("_id", F.monotonically_increasing_id()), "ends")
    share = ends.agg(F.count("*"), F.sum("_lines")).first()
    return ends, max(parts, -(-share[0] // STRETCHES)) if (share[1] or 0) > STRETCH * STRETCHES * parts else parts


def _earlier():
    """The stretches of a file before one."""
    return W.partitionBy("path").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)


def inherited_headers(rows: DataFrame, is_header: Column) -> DataFrame:
    """Data lines with the last header line above them, for files that change their header midway; a large file is many tasks."""
    header, last = F.when(is_header, F.col("value")), lambda c: F.last(c, ignorenulls=True)
    ends, tasks = _stretches(rows, F.max_by(header, F.when(header.isNotNull(), F.col("line"))).alias("_all"))
    before = ends.select("path", "_s", "_id", last("_all").over(_earlier()).alias("_before"))
    named = rows.withColumn("_s", F.expr(f"line div {STRETCH}")).join(F.broadcast(before.select("path", "_s", "_id")), ["path", "_s"]).drop("path", "_s")
    w = W.partitionBy("_id").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    found = named.repartition(tasks, "_id").withColumn("header", last(header).over(w)).join(F.broadcast(before.drop("_s")), "_id").drop("_id")
    out = found.withColumn("header", F.coalesce("header", "_before")).drop("_before")
    return out.where(~is_header & F.col("header").isNotNull())


def blocks(rows: DataFrame, starts: Column) -> DataFrame:
    """Lines gathered to records that begin where ``starts`` holds: path, record, first line, lines in order; a large file is many tasks.

    Lines above a stretch's first start go with the last stretch before it that has one, so that each record lies whole in one task and lines are shuffled once.
    """
    start = F.coalesce(starts, F.lit(False))
    ends, tasks = _stretches(rows, F.count_if(start).alias("_all"), F.min(F.when(start, F.col("line"))).alias("_first"))
    home = F.last(F.when(F.col("_all") > 0, F.col("_id")), ignorenulls=True).over(_earlier())
    ends = ends.select("path", "_s", "_id", "_first", home.alias("_home"), F.coalesce(F.sum("_all").over(_earlier()), F.lit(0)).alias("_before"))
    named = rows.withColumn("_s", F.expr(f"line div {STRETCH}")).join(F.broadcast(ends.drop("_before")), ["path", "_s"])
    named = named.select(F.when(F.col("line") >= F.col("_first"), F.col("_id")).otherwise(F.col("_home")).alias("_id"), "line", "value").where("_id is not null")
    w = W.partitionBy("_id").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    own = named.repartition(tasks, "_id").withColumn("_own", F.count_if(start).over(w))
    whole = own.groupBy("_id", "_own").agg(F.min("line").alias("first_line"), F.array_sort(F.collect_list(F.struct("line", "value")))["value"].alias("values"))
    return whole.join(F.broadcast(ends.select("_id", "path", "_before")), "_id").select("path", (F.col("_own") + F.col("_before")).alias("record"), "first_line", "values")


def multi_line(rows: DataFrame, size: int, markers: list[str] | None = None) -> DataFrame:
    """Records of ``size`` lines each: path, record, an array of their lines, and state.

    ``markers`` are what each line of a record begins with ('' for any). state is ``whole``, ``short`` where lines are missing
    (at the end of a file, or blank ones, which readers leave out) or ``malformed`` where a line lacks its marker.
    """
    if markers is not None and len(markers) != size:
        raise ValueError(f"{len(markers)} markers for {size} lines")
    at = F.expr(f"(line - 1) div {size}"), ((F.col("line") - 1) % size).cast("int")
    fits = F.col("value").startswith(F.element_at(F.array(*map(F.lit, markers)), at[1] + 1)) if markers else F.lit(True)
    found = rows.groupBy("path", at[0].alias("record")).agg(F.array_sort(F.collect_list(F.struct("line", "value")))["value"].alias("values"), F.bool_and(fits).alias("_fits"))
    state = F.when(F.size("values") < size, "short").when(~F.col("_fits"), "malformed").otherwise("whole")
    return found.select("path", "record", "values", state.alias("state"))


def zipped(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Parallel arrays as rows; the shortest sets the length."""
    shortest = F.least(*(F.size(a) for a in arrays)) if len(arrays) > 1 else F.size(arrays[0])
    rows = F.slice(F.arrays_zip(*arrays), F.lit(1), F.greatest(shortest, F.lit(0)))
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, F.posexplode(rows).alias("ord", "_z")).select(*rest, "ord", "_z.*")


def observations(df: DataFrame, packed: str, schema: list[str]) -> DataFrame:
    """Tab lists of comma tuples (a,b,c) as rows; tuples of another length are left out."""
    rest = [c for c in df.columns if c != packed]
    each = df.select(*rest, F.posexplode(F.split(packed, "\t")).alias("ord", "_t")).withColumn("_p", F.split("_t", ",")).where(F.size("_p") == len(schema))
    return each.select(*rest, "ord", *(F.col("_p")[i].try_cast("bigint").alias(n) for i, n in enumerate(schema)))


def json_stat(df: DataFrame, dims: list[str], sizes: list[int], values: str) -> DataFrame:
    """A statistical cube held as a map from flat index to value, or as a list of all values: one row per present cell, with its place in every dimension."""
    rest = [c for c in df.columns if c != values]
    listed = df.schema[values].dataType.typeName() == "array"
    cells = df.select(*rest, (F.posexplode if listed else F.explode)(values).alias("_k", "value")).withColumn("_k", F.col("_k").cast("bigint"))
    cells = cells.where(F.col("value").isNotNull()) if listed else cells
    stride, out = 1, []
    for name, size in reversed(list(zip(dims, sizes, strict=True))):
        out.insert(0, (F.floor(F.col("_k") / stride) % size).cast("int").alias(name))
        stride *= size
    return cells.where((F.col("_k") >= 0) & (F.col("_k") < stride)).select(*rest, *out, "value")


def matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """path, row, col, value of coordinate matrices; entries outside the stated shape are an error."""
    rows = lines(spark, path)
    head = rows.where("line = 1").select("path", F.split(F.lower("value"), r"\s+").alias("h")).select("path", F.col("h")[3].alias("field"))
    body = rows.where(~F.col("value").startswith("%")).withColumn("f", F.split(F.trim("value"), r"\s+"))
    first = body.groupBy("path").agg(F.min_by("f", "line").alias("shape"), F.min("line").alias("at"))
    entries = body.join(first, "path").where("line > at").join(head, "path")
    r, c = F.col("f")[0].cast("bigint"), F.col("f")[1].cast("bigint")
    inside = r.between(F.lit(1), F.col("shape")[0].cast("bigint")) & c.between(F.lit(1), F.col("shape")[1].cast("bigint"))
    value = F.when(F.col("field") == "pattern", F.lit(1.0)).otherwise(F.get("f", F.lit(2)).cast("double"))
    checked = F.when(inside, value).otherwise(F.raise_error(F.concat(F.lit("entry outside the matrix: "), "value")).cast("double"))
    return entries.select("path", r.alias("row"), c.alias("col"), checked.alias("value"))


def edges(spark: SparkSession, path: str) -> DataFrame:
    """src, dst of graph edge lists; self loops are left out."""
    return fields(lines(spark, path), 2).select(F.col("fields")[0].cast("bigint").alias("src"), F.col("fields")[1].cast("bigint").alias("dst")).where("src <> dst")


def positional(spark: SparkSession, path: str, names: list[str], arity: int, *, sep: str = ",") -> DataFrame:
    """CSV without a header as text columns; rows of fewer than ``arity`` fields are kept in ``corrupt`` alone."""
    rows = spark.read.text(path).where("trim(value) <> ''")
    parts = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"sep": sep, "mode": "PERMISSIVE"})
    enough = F.size(F.split("value", F.lit(sep), -1)) >= arity
    found = rows.select(F.when(enough, parts).alias("p"), F.when(~enough, F.col("value")).alias("corrupt"))
    return found.select(*(F.col(f"p.`{n}`").alias(n) for n in names), "corrupt")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line, blank lines left out; a line that is no object is kept in ``corrupt`` alone."""
    read = spark.read.schema(f"{schema}, corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt")
    return read.json(path)


def registry(spark: SparkSession, path: str, columns: list[str], *, sep: str = "\t") -> DataFrame:
    """A separated table whose header must be exactly these columns in this order."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    if df.columns != columns:
        raise ValueError(f"{path}: columns are {', '.join(df.columns)}, not {', '.join(columns)}")
    return df


def xml_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements named ``tag`` at any depth; attributes are columns that begin with an underscore. Entities are not expanded from outside."""
    return spark.read.schema(schema).option("rowTag", tag).xml(path)


def unique_entries(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first entry of every key."""
    return rows.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_k = 1").drop("_k")


def nested(spark: SparkSession, path: str, schema: str, array: str) -> DataFrame:
    """The elements of an array inside whole JSON documents, a row each, with the document's other columns."""
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    rest = [c for c in docs.columns if c != array.split(".")[0]]
    return docs.select(*rest, F.posexplode_outer(array).alias("ord", "_e")).select(*rest, "ord", "_e.*")


def with_files(spark: SparkSession, index: DataFrame, path_col: str, size_col: str, folder: str) -> DataFrame:
    """An index with what lies in the folder: ``exists``, and whether the size agrees. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("length").alias("_length"))
    base = F.lit(folder.rstrip("/") + "/")
    name = F.regexp_replace("path", "^[a-z]+:/+", "/")
    files = files.select(F.substr(name, F.length(F.regexp_replace(base, "^[a-z]+:/+", "/")) + 1).alias(path_col), "_length")
    joined = index.join(files, path_col, "left")
    return joined.select(*index.columns, F.col("_length").isNotNull().alias("exists"), (F.col("_length") == F.col(size_col)).alias("same_size"))


def dumped_pages(spark: SparkSession, path: str, element: str, array: str = "results") -> DataFrame:
    """The elements of an array in each of many page files: path, ord and their columns; (path, ord) is their order.

    ``place`` counts them over all pages, by a sort of pages that is spread over the cluster; each file is opened once. Pages without
    the array have no elements; a file with several documents is as many pages, in no stated order.
    """
    docs = spark.read.schema(f"`{array}` array<struct<{element}>>").option("multiLine", True).json(path)
    scratch, parts = Scratch(spark, "pages"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = scratch.keep(docs.select(F.col("_metadata.file_path").alias("path"), F.col(f"`{array}`").alias("_a")).where(F.size("_a") > 0), "read")
    each = read.repartitionByRange(parts, "path").sortWithinPartitions("path").select("path", F.posexplode("_a").alias("ord", "_e")).select("path", "ord", "_e.*")
    return numbered(each, "place", scratch=scratch)
