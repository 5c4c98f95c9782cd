"""An extension: the degeneracy audit and windowed totals over arriving records, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.records import degenerate


def windowed_totals(stream: DataFrame, *, ts: str = "ts", key: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per time window and key; rows later than ``late`` are dropped by the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def audit_batches(stream: DataFrame, keys: list[str], value: str, path: str, checkpoint: str):
    """Starts a query that writes the degeneracy audit of each micro-batch under its own folder, so that a replayed batch replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        degenerate(batch, keys, value).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
