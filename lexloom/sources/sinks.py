"""What each stage leaves behind: its rows as JSON, and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import percent
from . import recordio


def write(df: DataFrame, folder: str) -> None:
    """Rows as JSON lines, in place of what was there."""
    df.write.mode("overwrite").json(folder)


#: A document's record: its units and warnings, and how many units of each level.
_UNIT = "struct<section:string,pasal:string,occurrence:int,level:string,label:string,citation:string,parent:string,parent_start:int,start:long,end:long,text:string,leaf:boolean>"
_WARNING = "struct<warning:string,citation:string,section:string,pasal:string,occurrence:int>"
STRUCTURE = f"doc_id string, units array<{_UNIT}>, warnings array<{_WARNING}>, counts map<string,long>"


def structure_totals(counts: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: documents, units of each level, leaves, warnings, warned documents."""
    total = counts.agg(F.count("*").alias("documents"), *(F.sum(c).alias(c) for c in ("pasal", "ayat", "huruf", "angka", "units")))
    return total.join(warnings.agg(F.count("*").alias("warnings"), F.count_distinct("doc_id").alias("warned_documents")))


def write_structure(units: DataFrame, counts: DataFrame, warnings: DataFrame, folder: str) -> DataFrame:
    """One JSON for each document with its units and warnings, and the manifest
    of all with their counts, in one transaction; returns the totals."""

    def listed(rows: DataFrame, name: str, first: str) -> DataFrame:
        rest = [c for c in rows.columns if c not in ("doc_id", first)]
        parts = F.transform(F.array_sort(F.collect_list(F.struct(first, F.struct(*(F.col(c) for c in (first, *rest))).alias("row")))), lambda x: x["row"])
        return rows.groupBy("doc_id").agg(parts.alias(name))

    named = F.map_from_arrays(F.array(*(F.lit(c) for c in counts.columns if c != "doc_id")), F.array(*(F.col(c).cast("long") for c in counts.columns if c != "doc_id")))
    rows = counts.select("doc_id", named.alias("counts")).join(listed(units, "units", "start"), "doc_id", "left").join(listed(warnings, "warnings", "warning"), "doc_id", "left")
    rows = rows.withColumns({"units": F.coalesce("units", F.array()), "warnings": F.coalesce("warnings", F.array())})
    recordio.registered(units.sparkSession)
    rows.write.format("document_records").mode("append").save(folder)
    return structure_totals(counts, warnings)


def structure_records(spark: SparkSession, folder: str) -> DataFrame:
    """What ``write_structure`` has written: doc_id, units, warnings, counts."""
    return spark.read.schema(STRUCTURE).json(folder).where(F.col("_metadata.file_name") != "manifest.json")


def live_and_local(categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """National categories, and those of every other rank."""
    return categories.where("rank = 'national'"), categories.where("rank <> 'national'")


def ontology_totals(categories: DataFrame, notes: DataFrame) -> DataFrame:
    """(scope, categories, ids, taxable): rows, distinct identifiers and taxable
    rows of national and local categories, and the notes."""
    scope = F.when(F.col("rank") == "national", "national").otherwise("local")
    each = categories.groupBy(scope.alias("scope")).agg(F.count("*").alias("categories"), F.count_distinct("id").alias("ids"), F.count_if("taxable_subject").alias("taxable"))
    zero = F.lit(0).cast("bigint")
    return each.unionByName(notes.agg(F.lit("notes").alias("scope"), F.count("*").alias("categories"), zero.alias("ids"), zero.alias("taxable")))


def write_ontology(categories: DataFrame, alignments: DataFrame, notes: DataFrame, folder: str) -> DataFrame:
    """Categories, proposals for review and the coverage log; returns the totals."""
    write(categories, f"{folder}/categories")
    write(alignments, f"{folder}/pending_review")
    write(notes, f"{folder}/coverage_log")
    return ontology_totals(categories, notes)


def write_prefilter(buckets: DataFrame, per_document: DataFrame, folder: str) -> None:
    """Buckets of articles and their counts by document."""
    write(buckets, f"{folder}/pasal")
    write(per_document, f"{folder}/per_document")


def write_reconciled(verdicts: DataFrame, summary: DataFrame, folder: str) -> None:
    """Verdicts of all figures, and how many of each."""
    write(verdicts, f"{folder}/pages")
    write(summary, f"{folder}/summary")


def prefilter_report(share: DataFrame, reasons: DataFrame, sole: DataFrame) -> DataFrame:
    """(ord, line): what a prefilter run says: articles kept, and how often each
    reason selects one, and selects it alone."""
    head = share.select(F.lit(0).alias("ord"), F.lit("").alias("reason"), F.format_string("%d of %d articles to extract (%s)", "extract", "body_pasal", percent(F.coalesce("share", F.lit(0.0)))).alias("line"))
    each = reasons.join(sole.select("reason", F.col("n").alias("alone")), "reason", "left")
    lines = each.select(F.lit(1).alias("ord"), "reason", F.format_string("%s: %d, alone %d", "reason", "n", F.coalesce("alone", F.lit(0))).alias("line"))
    return head.unionByName(lines).orderBy("ord", "reason").select("ord", "line")


def reconcile_report(verdicts: DataFrame, status: str | None = None) -> DataFrame:
    """(doc_id, page, line): every figure of two readings that don't simply
    agree, or those of one ``status``, side by side."""
    some = verdicts.where(F.col("status") == status) if status else verdicts.where("status <> 'sources_agree'")
    side = lambda c: F.coalesce(F.concat(F.col(f"{c}.source_numeral"), F.lit(" ("), F.col(f"{c}.source_words"), F.lit(")")), F.lit("-"))
    line = F.concat_ws(" | ", "status", "unit", side("text_layer"), side("reocr"), F.coalesce(F.col("value").cast("string"), F.lit("?")))
    return some.select("doc_id", "page", line.alias("line")).orderBy("doc_id", "page", "line")
