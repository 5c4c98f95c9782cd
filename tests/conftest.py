import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    where = tmp_path_factory.mktemp("spark")
    os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", str(where / "local"))
        .config("spark.checkpoint.dir", f"file://{where}/shared")
        .config("spark.sql.warehouse.dir", str(where / "warehouse"))
        .getOrCreate()
    )
    yield session
    session.stop()
