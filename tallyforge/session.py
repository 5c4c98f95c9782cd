"""What a Spark session needs: this package's code in its tasks, and tables in the shared folder that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Give the executors this package's source, once a Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tallyforge_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallyforge-")) / "tallyforge_src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallyforge_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode a fresh one where that is unset, on a cluster an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.sparkContext.setCheckpointDir(where)
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


class Scratch:
    """Tables that cut lineage: written once to the shared folder, so lost executors cost a reread only."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
