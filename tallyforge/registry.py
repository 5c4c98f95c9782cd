"""The registry of queries: name, Spark callable over a folder of Parquet tables, and SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import ship

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader under its own name."""

    def keep(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return keep
