"""Two readings of a page against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numerals import scan, scanned
from ..plans.storage import kept

# How far a status is trusted.
TRUST = {"disagree": 0, "unparsed": 0, "single_channel": 1, "recovered": 2, "agree": 3}


def readings(pages: DataFrame, key: list[str]) -> DataFrame:
    """One row for each figure of each page's text."""
    return scanned(pages, *key).select(*key, F.col("i").alias("ord"), "m.*")


def candidate_pages(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Text-layer pages with a repaired or open figure, at most ``limit`` a document."""
    hit = pages.where((F.col("method") == "text_layer") & F.exists(scan(F.col("text")), lambda m: m["ocr_recovered"] | m["needs_review"]))
    if limit is None:
        return hit
    return hit.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("page"))).where(F.col("rn") <= limit).drop("rn")


def _trust(status: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in TRUST.items() for x in pair)), status)


def reconcile(layer: DataFrame, ocr: DataFrame, key: list[str]) -> DataFrame:
    """Every figure of both readings of a page with its verdict.

    The i-th figure of a unit and value in one reading meets the i-th in the
    other; what is left over on either side stands alone.
    """
    value = F.coalesce("word_value", "digit_value")

    def side(rows: DataFrame, name: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*key, "unit", value).orderBy("ord"))
        return rows.select(*key, "unit", value.alias("figure"), nth.alias("nth"), F.struct("ord", "status", "value", "source_numeral", "source_words", "start").alias(name))

    a, b = side(layer, "text_layer").alias("a"), side(ocr, "reocr").alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key] + [F.col("a.unit") == F.col("b.unit"), F.col("a.figure").eqNullSafe(F.col("b.figure")), F.col("a.nth") == F.col("b.nth")]
    on = same[0]
    for s in same[1:]:
        on = on & s
    both = a.join(b, on, "full").select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in [*key, "unit"]), "text_layer", "reocr")
    x, y = F.col("text_layer"), F.col("reocr")
    ta, tb = _trust(x["status"]), _trust(y["status"])
    paired = x.isNotNull() & y.isNotNull()
    equal = paired & (x["value"] == y["value"])
    status = (
        F.when(~paired, "single_source")
        .when(equal & (x["status"] == "agree") & (y["status"] == "agree"), "sources_agree")
        .when(equal, "sources_agree_after_repair")
        .when(ta > tb, "reocr_yields")
        .when(tb > ta, "text_layer_yields")
        .otherwise("sources_disagree")
    )
    chosen = F.when(~paired, F.when(x.isNotNull(), "text_layer").otherwise("reocr")).when(ta > tb, "text_layer").when(equal & (ta >= tb), "text_layer").when(tb > ta, "reocr")
    out = both.withColumns({"status": status, "chosen": chosen})
    picked = F.when(F.col("chosen") == "text_layer", x["value"]).when(F.col("chosen") == "reocr", y["value"])
    return out.withColumn("value", picked)


def reconcile_pages(pages: DataFrame, second: DataFrame, limit: int | None = None) -> DataFrame:
    """Every figure of the pages that are worth a second reading against it.

    pages: doc_id, page, method, text; second: doc_id, page, text, such as
    ``tools.ocr_pages`` gives; pages without a second reading are left out.
    """
    key = ["doc_id", "page"]
    wanted = kept(candidate_pages(pages, limit).join(second.where(F.col("text").isNotNull()).select(*key), key, "left_semi"))
    again = second.join(wanted.select(*key), key, "left_semi")
    return reconcile(readings(wanted, key), readings(again, key), key)


def summary(verdicts: DataFrame) -> DataFrame:
    """(status, n)."""
    return verdicts.groupBy("status").agg(F.count("*").alias("n"))
