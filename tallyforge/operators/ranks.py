"""Places in an order over a whole table, or within few large groups, without a task that holds them all.

Rows are range-sorted over the cluster and written once with their place inside their partition.
How many rows lie before a partition comes from one row a partition (and group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.session import Scratch

#: monotonically_increasing_id holds the partition above these bits and the row's place in it below.
ROW_BITS = 33


def placed(df: DataFrame, order: list[str], name: str, *, keys: tuple[str, ...] = (), scratch: Scratch | None = None) -> DataFrame:
    """The rows with ``name``: their place (long, from 1) within their keys in the given order of columns.

    Rows that tie in all of ``order`` are placed one after another in no stated order; null keys are a group like
    others, nulls come first in an order; an empty table stays empty. ``name`` must not be a column of ``df``.
    """
    if {name, "_at", "_part"} & set(df.columns):
        raise ValueError(f"the table has a column {name}, _at or _part already")
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(f"`{c}`").asc_nulls_first() for c in (*keys, *order)]
    return numbered(df.repartitionByRange(parts, *by).sortWithinPartitions(*by), name, keys=keys, scratch=scratch)


def numbered(df: DataFrame, name: str, *, keys: tuple[str, ...] = (), scratch: Scratch | None = None) -> DataFrame:
    """``placed`` of rows whose partitions follow one another in order already, and are in order inside."""
    if {name, "_at", "_part"} & set(df.columns):
        raise ValueError(f"the table has a column {name}, _at or _part already")
    ranged = df.withColumn("_at", F.monotonically_increasing_id())
    ranged = (scratch or Scratch(df.sparkSession, "places")).keep(ranged, f"places-{name}").withColumn("_part", F.shiftright("_at", ROW_BITS))
    held = ranged.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row a partition and group
    before = held.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    marks = [f"_k{i}" for i in range(len(keys))]
    before = before.select(F.col("_part").alias("_p"), *(F.col(f"`{k}`").alias(m) for k, m in zip(keys, marks, strict=True)), (F.col("_before") - F.col("_first") + 1).alias("_shift"))
    same = F.col("_part") == F.col("_p")
    for k, m in zip(keys, marks, strict=True):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(m))
    return ranged.join(before, same).select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_at") + F.col("_shift")).alias(name))
