"""Writers of typed records and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_records(df: DataFrame, path: str, *, partition: list[str]) -> None:
    """Records as Parquet, one folder per partition value; a rebuilt partition replaces the old one alone."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*partition).parquet(path)


def write_index(df: DataFrame, path: str) -> None:
    """One JSON object a line, keys sorted."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A tab-separated report with a header, in one file: for aggregates, which are small."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def markdown(df: DataFrame, most: int = 200) -> str:
    """A table of the first rows for people to read; a last line says so if there are more."""
    found = df.limit(most + 1).collect()
    rows = [df.columns, ["---"] * len(df.columns), *([("" if v is None else str(v)) for v in r] for r in found[:most])]
    more = [f"\nOnly the first {most} rows are shown."] if len(found) > most else []
    return "\n".join(["| " + " | ".join(r) + " |" for r in rows] + more)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON object; another number of rows is an error."""
    if (n := df.limit(2).count()) != 1:
        raise ValueError(f"a summary has one row, not {'none' if not n else 'more'}")
    write_index(df.coalesce(1), path)


def ratios(df: DataFrame, size: str, packed: str) -> DataFrame:
    return df.withColumn("ratio", F.round(F.try_divide(F.col(packed), F.col(size)), 6))
