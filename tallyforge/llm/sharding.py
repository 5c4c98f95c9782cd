"""Sharding by extendible hashing: a directory over hash-prefix bits whose oversized buckets alone split.

A document's key is 32 bits of the MD5 of its id and text, then 16 bits that differ between
repeated rows, so that even copies of one row can be dealt apart. Bucket sizes are summed at a
first directory depth (partial aggregation, a few entries per shard) and rolled up to the
shorter prefixes. A prefix that fits the limit, and whose parent does not, becomes a shard and
takes all directory entries under it; only the buckets that are too large at that depth go on
to deeper bits in the next round. Texts are never shuffled: rows carry id, key and size.

Defined results: a null text has 0 bytes; a bucket of one row is a shard even if the row is
larger than the limit (``fits`` is then false); ids may be null or repeated, as each row is a row; repeated rows are dealt like others; an empty
table has no shards; columns other than the id and the text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, pick, tune

KEY_BITS = 48
#: Bits by which a round's directory is deeper than the limit asks for on average.
FINER = 5
#: A directory of so many entries (24 bytes each) at most is broadcast.
BROADCAST_ENTRIES = 1 << 20


def prefix(key: Column, depth: int | Column) -> Column:
    return F.expr(f"shiftright(key, {KEY_BITS - depth})") if isinstance(depth, int) else F.call_function("shiftright", key, (F.lit(KEY_BITS) - depth).cast("int"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = pick(docs, id_col, text_col)
    content = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("text"))), 1, 8), 16, 10).cast("long")
    row = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 16) - 1))
    return base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), (content * (1 << 16) + row).alias("key"))


#: Bytes of text that a shard holds at most, whatever the table's size.
LIMIT = 1 << 20


def assign_shards(docs: DataFrame, *, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, shard (its prefix bits), depth, fits of every document; ``limit`` is in bytes."""
    if limit < 1:
        raise ValueError("a shard holds a byte at least")
    spark = docs.sparkSession
    tune(spark)
    scratch = Scratch(spark, "sharding")
    rows = scratch.keep(keyed(docs, id_col, text_col), "rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(KEY_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    above, out, left, number = 0, None, rows, 0
    while True:
        number += 1
        buckets = left.groupBy(prefix(F.col("key"), depth).alias("bucket")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        each = buckets.withColumn("at", F.explode(F.sequence(F.lit(above), F.lit(depth)))).withColumn("p", F.call_function("shiftright", F.col("bucket"), (F.lit(depth) - F.col("at")).cast("int")))
        sums = each.groupBy("at", "p").agg(F.sum("b").alias("sb"), F.sum("n").alias("sn"))
        fit = sums.withColumn("fit", (F.col("sb") <= limit) | (F.col("sn") == 1) | (F.col("at") == KEY_BITS))
        parent = fit.select((F.col("at") + 1).alias("at"), F.col("p").alias("parent"), F.col("fit").alias("above"))
        leaf = fit.where("fit").withColumn("parent", F.expr("shiftright(p, 1)")).join(parent, ["at", "parent"], "left").where("not coalesce(above, false)")
        width = F.expr(f"shiftleft(1L, cast({depth} - at as int))")
        directory = leaf.select(F.explode(F.sequence(F.col("p") * width, (F.col("p") + 1) * width - 1)).alias("bucket"), F.col("at").alias("depth"), "p", (F.col("sb") <= limit).alias("fits"))
        open_ended = fit.where((F.col("at") == depth) & ~F.col("fit"))
        directory = directory.unionByName(open_ended.select(F.col("p").alias("bucket"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("boolean").alias("fits")))
        directory = scratch.keep(directory, f"directory-{number}")
        entries, undecided = directory.agg(F.count("*"), F.count_if(F.col("depth").isNull())).first()
        known = F.broadcast(directory) if entries <= BROADCAST_ENTRIES else directory
        met = left.withColumn("bucket", prefix(F.col("key"), depth)).join(known, "bucket")
        bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin(F.col("p")), F.col("depth"), F.lit("0")))
        done = met.where("depth is not null").select("doc_id", "n_bytes", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), "fits")
        out = done if out is None else out.unionByName(done)
        if depth == KEY_BITS or not undecided:
            return out
        left = met.where("depth is null").select("doc_id", "n_bytes", "key")
        above, depth = depth + 1, min(KEY_BITS, depth + 8)


def write_shards(docs: DataFrame, shards: DataFrame, path: str, *, id_col: str = "doc_id") -> None:
    """The documents as Parquet, one folder a shard. Ids that are null or repeated would lose or multiply rows, and are an error; ``shard_rows`` takes such tables too."""
    n, different = docs.agg(F.count("*"), F.count_distinct(id_col)).first()
    if n != different:
        raise ValueError(f"{n} rows have {different} different ids; use shard_rows")
    met = docs.join(shards.select(F.col("doc_id").alias(id_col), "shard"), id_col)
    met.repartition("shard").write.partitionBy("shard").parquet(path)


def shard_rows(docs: DataFrame, path: str, *, limit: int = LIMIT, text_col: str = "text") -> None:
    """Every row of the table as Parquet, one folder a shard, whatever its ids: rows are numbered once, in a written table, and joined back by that number."""
    if {"_row", "shard"} & set(docs.columns):
        raise ValueError("the table has a column _row or shard already")
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "shard-rows")
    rows = scratch.keep(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    shards = assign_shards(rows, limit=limit, id_col="_row", text_col=text_col).select(F.col("doc_id").alias("_row"), "shard")
    rows.join(shards, "_row").drop("_row").repartition("shard").write.partitionBy("shard").parquet(path)
    scratch.drop("rows")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 8))::BIGINT AS k
  FROM documents),
most AS (SELECT {LIMIT} AS bytes),
e AS (SELECT doc_id, n_bytes, k, depth, k >> (32 - depth) AS p FROM d, range(0, 33) AS r(depth)),
s AS (SELECT depth, p, sum(n_bytes)::BIGINT AS b, count(*) AS n FROM e GROUP BY ALL),
f AS (SELECT e.doc_id, e.n_bytes, e.k, min(e.depth) AS depth FROM e JOIN s USING (depth, p), most
      WHERE s.b <= most.bytes OR s.n = 1 GROUP BY e.doc_id, e.n_bytes, e.k)
SELECT f.doc_id, f.n_bytes,
       CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(f.k >> (32 - f.depth)), f.depth::INT, '0') END AS shard,
       f.depth::INT AS depth, s.b <= most.bytes AS fits
FROM f JOIN s ON s.depth = f.depth AND s.p = f.k >> (32 - f.depth), most
"""
