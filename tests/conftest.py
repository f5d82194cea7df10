import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    root = str(Path(__file__).resolve().parent.parent)
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.driver.memory", "4g")
        .config("spark.executorEnv.PYTHONPATH", root)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = root
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """A table of given rows, under a schema string."""
    return lambda data, schema: spark.createDataFrame(data, schema)
