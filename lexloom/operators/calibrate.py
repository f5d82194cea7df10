"""The gate that a new reading engine has to pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import let
from ..functions.numerals import scan, word_tokens


def gate(cases: DataFrame) -> DataFrame:
    """(case_id, verdict, found_status, found_value) of cases with a reading.

    cases: case_id, match_words, expect_status, expect_value, wrong_value (each
    expectation may be null), text.  The first figure whose words hold the
    case's is judged: SMOOTHED if it has the known wrong value.
    """
    wanted = F.lower(F.col("match_words"))
    found = F.filter(scan(F.col("text")), lambda m: F.contains(F.array_join(word_tokens(m["source_words"])["tokens"], " "), wanted))
    first = F.try_element_at(found, F.lit(1))
    near = lambda a, b: F.coalesce(F.abs(a - b) < 1e-9, F.lit(False))

    def verdict(m: Column) -> Column:
        right = (F.col("expect_status").isNull() | F.coalesce(m["status"] == F.col("expect_status"), F.lit(False))) & (F.col("expect_value").isNull() | near(m["value"], F.col("expect_value")))
        label = F.when(m.isNull(), "NOT_FOUND").when(near(m["value"], F.col("wrong_value")), "SMOOTHED").when(right, "PASS").otherwise("FAIL")
        return F.struct(label.alias("verdict"), m["status"].alias("found_status"), m["value"].alias("found_value"))

    return cases.select("case_id", let(first, verdict).alias("v")).select("case_id", "v.*")


def probe(texts: DataFrame, begin: str, end: str, markers: list[str], terms: list[str]) -> DataFrame:
    """(case_id, markers, terms): how many expected marks and terms a region of
    each text holds."""
    start = F.instr("text", begin)
    rest = F.substring("text", F.greatest(start, F.lit(1)), F.length("text"))
    until = F.instr(rest, end)
    region = F.when(until > 0, F.substring(rest, F.lit(1), until - 1)).otherwise(rest)
    hits = lambda words: sum((F.contains(region, F.lit(w)).cast("int") for w in words), F.lit(0))
    return texts.select("case_id", hits(markers).alias("markers"), hits(terms).alias("terms"))
