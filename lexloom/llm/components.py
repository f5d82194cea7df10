"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import stored


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge but the roots themselves.

    The root is the smallest node of a component.  Each round links every
    node's larger neighbours to its smallest one, then its smaller ones; the
    minima are partial aggregates and the joins can be split, so that a star
    of any size is dealt evenly.  Ends when a round changes nothing, after a
    number of rounds that grows with the logarithm of a component's size.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = _print(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are stored, so that the joins with them are of plain shuffles, in which a hot node can be split
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = stored(both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")
        lowest = stored(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(lowest.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        now = stored(small, "edges")
        after = _print(now)
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
