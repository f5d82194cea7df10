"""Shared plumbing of the training-data operators: where tables that cut a
lineage go, how text columns are read, and the word definition they share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of every contract: a run of anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: A-Z only; letters outside ASCII keep their case.
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the session names in ``spark.checkpoint.dir``.  Where that is
    unset a session whose executors are threads of the driver, as in tests, gets
    a temporary folder; any other is told to name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="lexloom-"))
        found = _local[0]
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, name: str, *partition_by: str) -> str:
    """Write ``df`` as Parquet to a fresh path in the shared folder."""
    path = new_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The written table ends the lineage: it survives the loss of any executor
    and is never computed twice.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name, *partition_by))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the key and the whole text (null: empty), whatever else is there."""
    return df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def slices(lengths: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut ``range(len(lengths))`` into runs whose lengths sum to about ``limit``."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def portions(batch: pa.RecordBatch, text: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of its text column, so that no
    more than that is turned into Python strings at a time."""
    sizes = [n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()]
    for a, b in slices(sizes, limit):
        yield batch.slice(a, b - a)


def release() -> None:
    """Give memory that a finished batch has left back to the host, so that a
    worker that is used again doesn't hold on to its largest batch."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it if the table has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = "_" + name
    return name


def annotated(df: DataFrame, column: str, fn, name: str, kind: T.DataType) -> DataFrame:
    """``df`` with one more column: ``fn`` of each whole value of ``column``.

    ``fn`` maps a list of texts (null: empty) to an Arrow array of ``kind``.
    All other columns pass as they are; one narrow pass.
    """
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, fn(texts)], [*part.schema.names, name])
            release()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def by_crc(key: str, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus

