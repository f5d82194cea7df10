"""Figures of documents as they arrive.

Every stage of one document is stateless, so the batch expressions run
unchanged on a stream in append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rows_of
from ..functions.numerals import scan
from ..operators.prefilter import bucket


def arriving(spark: SparkSession, folder: str, schema: str = "doc_id string, text string") -> DataFrame:
    """A stream of the JSON documents that appear in ``folder``."""
    return spark.readStream.schema(schema).json(folder)


def figures(docs: DataFrame) -> DataFrame:
    """One row for each figure of each document."""
    return rows_of(docs, scan(F.col("text")), "doc_id").select("doc_id", "m.*")


def buckets(docs: DataFrame) -> DataFrame:
    """The bucket of each document's text."""
    return docs.select("doc_id", bucket(F.col("text")).alias("b")).select("doc_id", "b.*")
