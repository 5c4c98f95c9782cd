"""Shared helpers: scratch tables in the cluster's shared folder, row keys, Arrow batch limits.

Every operator reads only the key and text columns it is told of, so extra columns of the
input, whatever their names, never clash with the operator's own working columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import Scratch, shared_folder, ship  # noqa: F401 - operators take Scratch from here

#: Bytes of text that one Arrow batch may carry to a Python worker.
BATCH_BYTES = 4 * 1024 * 1024


#: Keys that a join treats apart are at most so many, as each of them holds more than such a share of the rows.
HOT_SHARE = 1024


def meet(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join with a ``right`` of one row a key, whose column ``count`` says how many of ``left``'s ``total`` rows have it.

    Keys that hold more than a ``HOT_SHARE``-th of the rows are at most ``HOT_SHARE`` in number: these are looked up
    first, and meet their rows in a broadcast join wherever the rows are; only the others are dealt out by key.
    ``right`` is read more than once.
    """
    few = right.where(F.col(count) > max(200, total // HOT_SHARE)).collect()
    if not few:
        return left.join(right, keys)
    hot = left.sparkSession.createDataFrame(few, right.schema)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right, keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)


def tune(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, and free a finished query's shuffle files at once.

    Both matter for long texts: a batch of 10,000 long documents would not fit a worker, and
    shuffle files of a phase whose result is already written only fill disks. The settings stay
    in the session, for the operators' results are computed only when the caller asks for them.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, as ``doc_id`` and ``text``; a null text is an empty one."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
