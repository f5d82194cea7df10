"""The shared folder, and cutting the lineage of plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input in a portion: some ten thousand lines, whatever the table's size.
PORTION = 1 << 20
#: What Spark gives as the size of a table that it knows no size of, or more.
UNKNOWN = 1 << 60


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: what the session names in
    ``spark.checkpoint.dir``.

    Where that is unset a session whose executors are threads of the driver gets
    a temporary folder; any other is told to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return named.rstrip("/") if named else "file://" + tempfile.mkdtemp(prefix="lexloom-")


def kept(df: DataFrame) -> DataFrame:
    """``df``, worked out once: written to the shared folder and read back.

    In columns, which take a fraction of what a checkpoint's rows do.
    """
    spark = df.sparkSession
    folder = f"{shared(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def portioned(df: DataFrame, *columns: str, size: int = PORTION) -> DataFrame:
    """``df`` shuffled by ``columns`` in portions that grow in number with the
    files it is read from, so that a task does not grow with them.  Tables that
    come from no file, whose size Spark doesn't know, count for nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    portions = -(-sum(n for n in sizes if n < UNKNOWN) // size)
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), portions), *columns)
