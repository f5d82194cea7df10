"""Bound markers in one pass against one pattern at a time."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.operators import prefilter

TEXTS = [
    "Tarif paling tinggi 5% dan paling  rendah 2%", "PALING LAMA, Paling Banyak; ditetapkan sebesar", "paling tinggipaling sedikit", "ditetapkan dengan paling lama dan paling lama",
    "paling ſedikit", "ditetapKan sebesar", "palıng tinggi", "PALİNG TİNGGİ", "paling", "", "tinggi paling", "paling paling banyak", None,
]


def test_markers_as_by_each_pattern(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    each = F.array_compact(F.array(*(F.when(F.col("t").rlike(f"(?iuU){p}"), k) for k, p in sorted(prefilter.BOUND_MARKERS.items()))))
    got = rows.select("t", prefilter.bound_markers(F.col("t")).alias("one"), each.alias("each"))
    assert [(r.t, r.one) for r in got.collect()] == [(r.t, r.each) for r in got.collect()]


def test_one_pass_finds_markers(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(prefilter.bound_markers(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < len(prefilter.BOUND_MARKERS)
