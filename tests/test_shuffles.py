"""What moves and what is interpreted in the corpus's queries."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lexloom.functions import rows_of
from lexloom.functions.matchers import find_all
from lexloom.operators import layout, segment
from lexloom.plans import catalog, corpus

DATA = "/root/testdata/sf0.001"


def _exchanges(df) -> int:
    return len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]))


@pytest.mark.parametrize("name", ["unit_citations", "unit_counts", "prefilter_buckets", "numeral_scan"])
def test_lines_move_once(spark, name):
    assert _exchanges(catalog.QUERIES[name](spark, DATA)) == 1


def test_portions_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(corpus, "PORTION", 1000)
    got = corpus.documents(spark, DATA)
    assert got.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_come_from_a_column(spark):
    plan = rows_of(spark.range(1), F.transform(F.array("id"), lambda x: F.struct(x.alias("x"))), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Generate posexplode\(.*transform", plan)


def test_groups_come_with_matches(spark):
    rows = spark.createDataFrame([("a1 b\x01 c22",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(find_all(F.col("t"), "([a-c])([0-9]+)?", "letter", "digits")).collect()]
    assert [tuple(m) for m in got[0]] == [(0, 2, "a1", "a", "1"), (3, 4, "b", "b", ""), (6, 9, "c22", "c", "22")]
    assert got[1:] == [[], None]


def test_a_single_mark_is_read_as_before(spark):
    texts = ["(1) x", "  (1)  x", "y (1) z\n(1) w", "(l) x", "(2) x", "(1 x", "(1] x", "x", ""]
    got = [[tuple(m) for m in r[0]] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(segment.ayat_marks(F.col("t"))).collect()]
    assert got == [[(0, 4, "1")], [(0, 7, "1")], [(8, 12, "1")], [], [], [(0, 3, "1")], [(0, 4, "1")], [], []]


def test_lines_are_found_once(spark):
    pages = spark.createDataFrame([("d", k, f"Kop\nisi {k}\nKop") for k in range(4)], "doc_id string, page int, text string")
    got = layout.strip_furniture(pages)
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.page, r.text, r.removed) for r in got.collect()} == {(k, f"   \nisi {k}\n   ", 2) for k in range(4)}


def test_articles_with_slots_are_put_together_once(spark):
    """Slots and units are both found in articles that are kept."""
    arts = catalog._slots(spark, DATA)[2]
    assert "lineitem" not in arts._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_sorted_once(spark):
    """Both numberings of the corpus find their order in one sort."""
    assert corpus.named(spark, DATA)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Sort [") == 1


def test_the_corpus_is_that_of_its_sql(spark):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet")
    known = spark.sql(corpus.TRUTH_SQL.replace("FROM lineitem", "FROM {lines}"), lines=lines)
    got = corpus.truth(spark, DATA)
    assert got.schema == known.schema and got.count() == known.count() and got.exceptAll(known).isEmpty()
