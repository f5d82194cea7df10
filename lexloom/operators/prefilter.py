"""Which articles go to extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import let
from ..functions.numerals import figures
from ..functions.text import canonical

# Markers, modal rules and numeral look-alikes of the source language.
BOUND_MARKERS = {
    "paling_tinggi": r"paling\s+tinggi", "paling_rendah": r"paling\s+rendah", "paling_lama": r"paling\s+lama", "paling_sedikit": r"paling\s+sedikit",
    "paling_banyak": r"paling\s+banyak", "ditetapkan_sebesar": r"ditetapkan\s+sebesar", "ditetapkan_dengan": r"ditetapkan\s+dengan",
}
NOUN_HEAD = r"\s+(?:paj\w*|re\w*busi\w*|pungut\w*|pbb-?p2|pbb|pab|pat|pkb|pbjt|bbnkb|pbbkb|mblb|bphtb|pap|opsen)\b"
MODAL_WAJIB = rf"(?iuU)(?<!\b(?:kontribusi|pemerintahan)\s{{1,12}})\bwajib\b(?!{NOUN_HEAD})(?!,)"
DILARANG = r"(?iuU)\bdilarang\b"
PERCENT_ISH = r"(?iuU)\d\s*(?:%|[VY]o|o/o|7o|o%|%o|Zo)|\bpersen\b"
DEADLINE = r"(?iuU)\b\d+\s*\(\s*[a-zA-Z][a-zA-Z ]{2,30}?\)\s*(?:hari kerja|hari|bulan|tahun)\b"


def modal_wajib(text: Column) -> Column:
    """How often the text says "must": the noun, the adjective and cut-off
    terms aside.  The text is canonical."""
    return F.regexp_count(text, F.lit(MODAL_WAJIB))


#: Any marker; none can begin inside another, so that one pass finds every one that is there.
ANY_MARKER = f"(?iuU){'|'.join(BOUND_MARKERS.values())}"


def bound_markers(text: Column) -> Column:
    """Sorted names of the bound markers in a canonical text."""
    # what case folding takes for a letter of a marker but lower() leaves
    said = F.lower(F.translate(F.array_join(F.regexp_extract_all(text, F.lit(ANY_MARKER), F.lit(0)), "\x01"), "ſKıİ", "skii"))
    return F.when(text.rlike(ANY_MARKER), F.sort_array(F.array_distinct(F.split(F.regexp_replace(said, r"(?U)\s+", "_"), "\x01")))).otherwise(F.array().cast("array<string>"))


def bucket(raw: Column) -> Column:
    """struct: what an article's text was selected by, or why it is skipped.
    Figures are looked for in the raw text, everything else in the canonical."""

    def of(t: Column) -> Column:
        facts = F.struct(bound_markers(t["c"]).alias("bound_markers"), F.size(figures(t["r"])).alias("n_slots"), modal_wajib(t["c"]).alias("n_modal_wajib"), F.regexp_count(t["c"], F.lit(DILARANG)).alias("n_dilarang"))

        def verdict(f: Column) -> Column:
            why = F.array_compact(F.array(F.when(F.size(f["bound_markers"]) > 0, "bound_marker"), F.when(f["n_slots"] > 0, "numeral_pair"), F.when(f["n_modal_wajib"] > 0, "modal_wajib"), F.when(f["n_dilarang"] > 0, "modal_dilarang")))
            skip = F.when(t["c"].rlike(PERCENT_ISH), "unexplained_numeral").when(t["c"].rlike(DEADLINE), "deadline_numeral_no_marker").otherwise("no_normative_marker")
            return let(why, lambda w: F.struct(*(f[k].alias(k) for k in ("bound_markers", "n_slots", "n_modal_wajib", "n_dilarang")), F.when(F.size(w) > 0, "extract").otherwise("skip").alias("bucket"), w.alias("selected_by"), F.when(F.size(w) == 0, skip).alias("skip_reason")))

        return let(facts, verdict)

    return let(F.struct(raw.alias("r"), canonical(raw).alias("c")), of)


def prefilter(pasals: DataFrame) -> DataFrame:
    """Every operative article with its bucket."""
    body = pasals.where(F.col("section") == "body")
    return body.select("doc_id", "citation", "pasal", "occurrence", bucket(F.col("text")).alias("b")).select("doc_id", "citation", "pasal", "occurrence", "b.*")


def per_document(buckets: DataFrame) -> DataFrame:
    """(doc_id, body_pasal, extract, skip)."""
    return buckets.groupBy("doc_id").agg(F.count("*").alias("body_pasal"), F.count_if(F.col("bucket") == "extract").alias("extract"), F.count_if(F.col("bucket") == "skip").alias("skip"))


def per_document_maps(buckets: DataFrame) -> DataFrame:
    """``per_document`` with skip_reasons and selected_by: maps of how many
    articles each reason skips or selects; one article may count for several."""
    said = F.concat(F.transform("selected_by", lambda r: F.struct(F.lit("selected_by").alias("kind"), r.alias("reason"))), F.transform(F.array_compact(F.array("skip_reason")), lambda r: F.struct(F.lit("skip_reasons").alias("kind"), r.alias("reason"))))
    each = buckets.select("doc_id", F.inline(said)).groupBy("doc_id", "kind", "reason").agg(F.count("*").alias("n"))
    as_map = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("reason", "n"))))).alias(kind)
    maps = each.groupBy("doc_id").agg(as_map("skip_reasons"), as_map("selected_by"))
    return per_document(buckets).join(maps, "doc_id", "left")


def reasons(buckets: DataFrame, sole: bool = False) -> DataFrame:
    """(reason, n), most frequent first; with ``sole``, only articles that one
    reason alone selects."""
    some = buckets.where(F.size("selected_by") == 1) if sole else buckets
    return some.select(F.explode("selected_by").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def corpus_share(buckets: DataFrame) -> DataFrame:
    """(body_pasal, extract, share) of all documents; no share of nothing."""
    total = buckets.agg(F.count("*").alias("body_pasal"), F.count_if(F.col("bucket") == "extract").alias("extract"))
    return total.withColumn("share", F.try_divide("extract", "body_pasal"))
