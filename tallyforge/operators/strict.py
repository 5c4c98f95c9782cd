"""Checks that end a job with the offending key, where a flag would not do.

The checks are expressions in the plan: they run where the rows are, and the first row that
breaks one ends the job with its key in the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held(ok: Column, value: Column, message: str, *what: Column) -> Column:
    """``value`` where ``ok`` is true; else an error with the message and ``what``."""
    return F.when(ok, value).otherwise(F.raise_error(F.concat_ws(" ", F.lit(message), *(F.coalesce(w.cast("string"), F.lit("null")) for w in what))))


def bounded(value: Column, low: int, high: int, kind: str = "bigint") -> Column:
    """The value as ``kind``; a number outside [low, high] is an error, null stays null."""
    return held(value.isNull() | value.between(low, high), value.cast(kind), f"outside [{low}, {high}]:", value)


def known(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows joined with their labels; a key without a label is an error. ``labels`` has one row a key."""
    marked = labels.withColumn("_known", F.lit(True))
    return rows.join(marked, key, "left").withColumn(key, held(F.col("_known"), F.col(key), f"no label for {key}", F.col(key))).drop("_known")


def zipped(left: Column, right: Column) -> Column:
    """Pairs of two lists; lists of different length are an error."""
    return held(F.size(left) == F.size(right), F.arrays_zip(left, right), "lists of different length:", F.size(left), F.size(right))


def unique(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row a key; a key with different values is an error."""
    facts = rows.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    return facts.select(*keys, held(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low"), "different values for", *map(F.col, keys)).alias(value))


def preferred(topics: DataFrame, candidates: DataFrame, topic: str, item: str) -> DataFrame:
    """Every topic with its only candidate, or the reason (none, ambiguous) why it has none."""
    facts = candidates.groupBy(topic).agg(F.count("*").alias("_n"), F.min(item).alias(item))
    reason = F.when(F.col("_n").isNull(), "none").when(F.col("_n") > 1, "ambiguous").otherwise("chosen")
    return topics.join(facts, topic, "left").select(topic, reason.alias("reason"), F.when(F.col("_n") == 1, F.col(item)).alias(item))


def one_per_topic(topics: DataFrame, candidates: DataFrame, topic: str, item: str) -> DataFrame:
    """The candidate of every topic that has one; more than one is an error."""
    found = preferred(topics, candidates, topic, item).where("reason != 'none'")
    return found.select(topic, held(F.col("reason") == "chosen", F.col(item), f"more than one candidate for {topic}", F.col(topic)).alias(item))
