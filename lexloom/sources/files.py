"""Readers and writers of the pipeline's files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_slug
from . import recordio

#: A page of a document record, and the record itself.
PAGE = "struct<page:int,method:string,classification:string,garbage_ratio:double,text:string,replaced_text_layer:string,replaced_classification:string,char_count:int>"
RECORD = f"doc_id string, source_pdf string, batch string, extracted_at string, tools map<string,string>, ocr_langs string, ocr_dpi int, n_pages int, methods map<string,int>, classifications map<string,int>, pages array<{PAGE}>"
NORM = "id string, instrument string, citation string, text_id string, norm_type string, modality string, tax string, applies_to array<string>, is_residual boolean, bounds array<struct<op:string,value:double,unit:string,source_numeral:string,source_words:string,ocr_recovered:boolean>>, addressee string, open_textured_terms array<string>, delegates_to_rank int, delegated_scope array<string>, note string, extraction_confidence double"
GOLD = f"instruments map<string,struct<title:string,rank:int,rank_label:string,jurisdiction:string,in_force_from:string>>, norms array<struct<{NORM.replace(' ', ':').replace(',:', ',')}>>"
ONTOLOGY = "categories map<string,struct<label:string,parent:string,origin:string>>, open_textured map<string,struct<label:string,appears_in:string,reason:string,action:string>>"


def pdf_files(spark: SparkSession, folder: str, containing: str | None = None) -> DataFrame:
    """(path, doc_id, length, content, error): PDF files below ``folder``.

    A file of no bytes is a row with an error, not a failure; marks that a
    download leaves beside files are passed over.  Subtrees are listed in tasks;
    no path goes through the driver.
    """
    found = recordio.registered(spark).read.format("pdf_folder").load(folder)
    if containing:
        found = found.where(F.lower("path").contains(containing.lower()))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.pdf$", "")
    return found.select("path", file_slug(stem).alias("doc_id"), "length", "content", F.when(F.col("length") == 0, "zero-byte file").alias("error"))


def listing(found: DataFrame) -> DataFrame:
    """``pdf_files`` without the contents, in order of their paths."""
    return found.drop("content").orderBy("path")


def layer_pages(texts: DataFrame) -> DataFrame:
    """(doc_id, page, text) of whole text layers (doc_id, text): split at form
    feeds, one trailing blank page dropped."""
    parts = F.split("text", "\f")
    last = F.trim(F.regexp_replace(F.element_at(parts, -1), r"(?U)\s+", " ")) == ""
    kept = F.when(last, F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return texts.select("doc_id", F.posexplode(kept).alias("i", "text")).select("doc_id", (F.col("i") + 1).alias("page"), "text")


def provided(files: DataFrame, reader: Callable[[bytes], list[str | None]], source: str) -> DataFrame:
    """(doc_id, page, source, text): pages by any reader of a file's bytes,
    such as a text-layer or OCR tool; a file that fails gives an error row."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for doc, content in zip(batch["doc_id"], batch["content"], strict=True):
                try:
                    rows += [(doc, i + 1, source, t, None) for i, t in enumerate(reader(bytes(content)))]
                except Exception as e:  # one file's failure is a row of the manifest
                    rows.append((doc, None, source, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "page", "source", "text", "error"])

    return files.where("error is null").select("doc_id", "content").mapInPandas(run, "doc_id string, page int, source string, text string, error string")


def records(spark: SparkSession, folder: str, containing: str | None = None) -> DataFrame:
    """Document records: one JSON file each, the manifest aside, in order of name."""
    found = spark.read.schema(RECORD).option("multiLine", True).json(folder).where(F.col("_metadata.file_name") != "manifest.json")
    return found.where(F.lower("doc_id").contains(containing.lower())) if containing else found


def record_pages(found: DataFrame) -> DataFrame:
    """One row for each page of document records."""
    return found.select("doc_id", F.inline("pages"))


def manifest(tallies: DataFrame, *failures: DataFrame) -> DataFrame:
    """(doc_id, n_pages, methods, classifications, error), in order of doc_id:
    one row a document, and one for each failure.  failures: doc_id, error."""
    rows = tallies.withColumn("error", F.lit(None).cast("string"))
    for f in failures:
        rows = rows.unionByName(f.where("error is not null").select("doc_id", "error"), allowMissingColumns=True)
    return rows.orderBy("doc_id", "error")


def write_records(pages: DataFrame, tallies: DataFrame, folder: str, *failures: DataFrame) -> DataFrame:
    """Write a document's pages as one JSON record, ``<doc_id>.json`` in
    ``folder``, and the manifest beside them, all or nothing; returns the manifest.

    failures: doc_id, error; they are in the manifest alone.
    """
    fields = [c for c in pages.columns if c != "doc_id"]
    whole = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page", *(c for c in fields if c != "page")))).alias("pages")).join(tallies, "doc_id")
    rows = whole.withColumn("error", F.lit(None).cast("string"))
    for f in failures:
        rows = rows.unionByName(f.where("error is not null").select("doc_id", "error"), allowMissingColumns=True)
    recordio.registered(pages.sparkSession)
    rows.write.format("document_records").mode("append").save(folder)
    return manifest(tallies, *failures)


def gold_norms(spark: SparkSession, path: str) -> DataFrame:
    """Norms of a gold file with their order and their instrument's rank and title."""
    gold = spark.read.schema(GOLD).option("multiLine", True).json(path)
    norms = gold.select(F.posexplode("norms").alias("ord", "n"), "instruments").select("ord", "n.*", "instruments")
    held = F.try_element_at("instruments", F.col("instrument"))
    return norms.select(F.col("id").alias("norm"), "*", held["rank"].alias("rank"), held["title"].alias("title")).drop("id", "instruments")


def norm_bounds(norms: DataFrame) -> DataFrame:
    """(norm, ord, op, value, unit): the bounds of norms, in order."""
    each = norms.select("norm", "ord", F.posexplode("bounds").alias("i", "b"))
    return each.select("norm", (F.col("ord") * 1000 + F.col("i")).alias("ord"), "b.op", "b.value", "b.unit")


def gold_ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Categories (id, label, parent, origin) and open-textured terms (id, label, ...)."""
    gold = spark.read.schema(ONTOLOGY).option("multiLine", True).json(path)
    return gold.select(F.explode("categories").alias("id", "c")).select("id", "c.*"), gold.select(F.explode("open_textured").alias("id", "t")).select("id", "t.*")


def case_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(case_id, text): a reading of each case, the first there is of .txt, .md
    and .json (its ``text``)."""
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    kind = F.regexp_extract("name", r"\.(txt|md|json)$", 1)
    text = F.when(kind == "json", F.get_json_object("value", "$.text")).otherwise(F.col("value"))
    rows = files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("case_id"), text.alias("text"), F.array_position(F.array(F.lit("txt"), F.lit("md"), F.lit("json")), kind).alias("rank"))
    return rows.where("rank > 0").groupBy("case_id").agg(F.min_by("text", "rank").alias("text"))
