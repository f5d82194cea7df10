"""Column-to-Column functions: every one is a native Catalyst expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(df: DataFrame, array: Column, *columns: str) -> DataFrame:
    """``columns`` of ``df`` with a row for each struct of an array: its place
    ``i`` and itself, ``m``.

    An outer generator with its empty row left out: for an inner one Catalyst
    puts a filter below it that computes the array a second time.  The array is
    a column first: a projection compiles what a generator would interpret.
    """
    rows = df.select(*columns, array.alias("__rows"))
    return rows.select(*columns, F.posexplode_outer("__rows").alias("i", "m")).where(F.col("m").isNotNull())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]
