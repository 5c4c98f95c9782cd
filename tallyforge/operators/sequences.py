"""What depends on the rows before: changes, runs, checks of order, running totals, turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _window(keys: list[str], order: list[str]):
    return W.partitionBy(*keys).orderBy(*order)


def transitions(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """How often the value changes, per key."""
    before = F.lag(value).over(_window(keys, order))
    return df.withColumn("_b", before).groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(F.col("_b") != F.col(value)).alias("transitions"))


def longest_run(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The longest stretch of one value, per key."""
    new = F.when(F.lag(value).over(_window(keys, order)).eqNullSafe(F.col(value)), 0).otherwise(1)
    island = df.withColumn("_n", new).withColumn("_i", F.sum("_n").over(_window(keys, order)))
    return island.groupBy(*keys, "_i").count().groupBy(*keys).agg(F.max("count").alias("longest_run"), F.count("*").alias("runs"))


def order_facts(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Whether the value rises strictly, never falls, and how often it repeats, in the given order."""
    before = F.lag(value).over(_window(keys, order))
    return (
        df.withColumn("_b", before)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.bool_and(F.col(value) > F.col("_b")), F.lit(True)).alias("strictly_rising"),
            F.coalesce(F.bool_and(F.col(value) >= F.col("_b")), F.lit(True)).alias("never_falling"),
            F.count_if(F.col(value) == F.col("_b")).alias("repeats"),
            F.count_if(F.col(value) < F.col("_b")).alias("falls"),
        )
    )


def fill_forward(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.last(value, ignorenulls=True).over(_window(keys, order).rowsBetween(W.unboundedPreceding, 0)))


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    return df.withColumn("running", F.sum(value).over(_window(keys, order).rowsBetween(W.unboundedPreceding, 0)))


def until_target(df: DataFrame, keys: list[str], order: list[str], value: str, *, target: float, most: int) -> DataFrame:
    """Rows until their total reaches the target, the row that reaches it included, or until there are ``most``."""
    w = _window(keys, order)
    before = F.coalesce(F.sum(value).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_s", before).withColumn("_r", F.row_number().over(w)).where((F.col("_s") < target) & (F.col("_r") <= most)).drop("_s", "_r")


def first_per_group(df: DataFrame, keys: list[str], order: list, limit: Column | int) -> DataFrame:
    """The first rows of each group, ``rank`` beside them."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= limit)
