"""Registered queries of the legal-text engine, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numerals, rows_of, text
from ..operators import calibrate, conflict, crossref, interval, layout, ontology, prefilter, reconcile, segment, slots
from ..sources import sinks
from . import corpus
from .storage import kept

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_R = f"WITH r AS ({corpus.TRUTH_SQL})"
_DOC = "concat('PERDA_', sup)"
_HIT = "(dmg = 3 OR (dmg = 1 AND p IN (0, 1, 5, 8, 10)))"
_COUNT_HIT = "(dmg = 1 AND greatest(p, 1) IN (1, 5, 8, 10))"


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that it must agree with."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _units(spark: SparkSession, d: str) -> DataFrame:
    return segment.units(corpus.documents(spark, d))


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query(f"""{_R} SELECT {_DOC} AS doc_id, CAST(pasal AS VARCHAR) AS pasal, CAST(ayat AS VARCHAR) AS ayat,
    CAST(CASE WHEN kind <= 5 THEN p * 100 ELSE greatest(p, 1) END AS INT) AS value,
    CASE WHEN kind <= 5 AND {_HIT} THEN 'recovered' WHEN kind = 6 AND {_COUNT_HIT} THEN 'recovered' ELSE 'agree' END AS status,
    CASE WHEN kind <= 5 THEN 'fraction' ELSE 'hari_kerja' END AS unit FROM r WHERE kind <= 6""")
def numeral_scan(spark: SparkSession, d: str) -> DataFrame:
    """Every figure of every paragraph; rates in basis points."""
    rows = numerals.scanned(_units(spark, d).where("level = 'ayat'").withColumnRenamed("label", "ayat"), "doc_id", "pasal", "ayat")
    value = F.when(F.col("m.unit") == "fraction", F.round(F.col("m.value") * 10000)).otherwise(F.col("m.value"))
    return rows.select("doc_id", "pasal", "ayat", value.cast("int").alias("value"), F.col("m.status").alias("status"), F.col("m.unit").alias("unit"))


@query(f"""{_R} SELECT CASE WHEN kind <= 5 AND {_HIT} THEN 'recovered' WHEN kind = 6 AND {_COUNT_HIT} THEN 'recovered' ELSE 'agree' END AS status,
    CASE WHEN kind <= 5 THEN 'fraction' ELSE 'hari_kerja' END AS unit, count(*) AS n FROM r WHERE kind <= 6 GROUP BY 1, 2""")
def numeral_status_tally(spark: SparkSession, d: str) -> DataFrame:
    """Figures by status and unit, scanned paragraph by paragraph."""
    rows = numerals.scanned(corpus.paragraphs(spark, d))
    return rows.groupBy("m.status", "m.unit").agg(F.count("*").alias("n"))


@query(f"""{_R} SELECT {_DOC} AS doc_id, count(DISTINCT pasal) AS pasal, count(*) AS ayat, CAST(0 AS BIGINT) AS huruf, CAST(0 AS BIGINT) AS angka, count(*) AS units FROM r GROUP BY 1""")
def unit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Units of each level and leaves of every document."""
    return segment.level_counts(_units(spark, d))


@query(f"""{_R} SELECT {_DOC} AS doc_id, concat('Pasal ', pasal, ' ayat (', ayat, ')') AS citation, concat('Pasal ', pasal) AS parent FROM r
    UNION ALL SELECT DISTINCT {_DOC}, concat('Pasal ', pasal), NULL FROM r""")
def unit_citations(spark: SparkSession, d: str) -> DataFrame:
    """Every unit's citation and parent."""
    return _units(spark, d).select("doc_id", "citation", "parent")


#: Every unit of ``corpus.structured``: citation, level, parent, leaf, how often, and when it is there.
_STRUCTURE = """u(citation, level, parent, leaf, n, w) AS (VALUES
    ('Pasal 1', 'pasal', NULL, FALSE, 1, 0), ('Pasal 1 ayat (1)', 'ayat', 'Pasal 1', TRUE, 1, 0), ('Pasal 1 ayat (2)', 'ayat', 'Pasal 1', TRUE, 1, 0), ('Pasal 1 ayat (3)', 'ayat', 'Pasal 1', TRUE, 1, 0),
    ('Pasal 2', 'pasal', NULL, FALSE, 1, 0), ('Pasal 2 huruf a', 'huruf', 'Pasal 2', TRUE, 1, 0), ('Pasal 2 huruf b', 'huruf', 'Pasal 2', TRUE, 1, 0), ('Pasal 2 huruf c', 'huruf', 'Pasal 2', TRUE, 1, 0),
    ('Pasal 3', 'pasal', NULL, FALSE, 1, 0), ('Pasal 3 ayat (1)', 'ayat', 'Pasal 3', FALSE, 1, 0), ('Pasal 3 ayat (1) huruf a', 'huruf', 'Pasal 3 ayat (1)', TRUE, 1, 0), ('Pasal 3 ayat (1) huruf b', 'huruf', 'Pasal 3 ayat (1)', FALSE, 1, 0),
    ('Pasal 3 ayat (1) huruf b angka 1', 'angka', 'Pasal 3 ayat (1) huruf b', TRUE, 1, 0), ('Pasal 3 ayat (1) huruf b angka 2', 'angka', 'Pasal 3 ayat (1) huruf b', TRUE, 1, 0), ('Pasal 3 ayat (2)', 'ayat', 'Pasal 3', TRUE, 1, 0),
    ('Pasal 4', 'pasal', NULL, FALSE, 1, 0), ('Pasal 4 angka 1', 'angka', 'Pasal 4', TRUE, 1, 0), ('Pasal 4 angka 2', 'angka', 'Pasal 4', TRUE, 1, 0), ('Pasal 4 angka 3', 'angka', 'Pasal 4', TRUE, 1, 0),
    ('Pasal 5', 'pasal', NULL, TRUE, 1, 0), ('Pasal 5 #2', 'pasal', NULL, TRUE, 1, 1), ('Pasal 6', 'pasal', NULL, TRUE, 1, 0), ('Pasal 7', 'pasal', NULL, TRUE, 1, 0), ('Pasal 7 #2', 'pasal', NULL, TRUE, 1, 2),
    ('Pasal 8', 'pasal', NULL, FALSE, 1, 0), ('Pasal 8 ayat (1)', 'ayat', 'Pasal 8', FALSE, 1, 0), ('Pasal 8 ayat (1) huruf a', 'huruf', 'Pasal 8 ayat (1)', TRUE, 2, 0), ('Pasal 8 ayat (1) huruf b', 'huruf', 'Pasal 8 ayat (1)', TRUE, 2, 0),
    ('Pasal 8 ayat (2)', 'ayat', 'Pasal 8', TRUE, 1, 0), ('Pasal 9', 'pasal', NULL, TRUE, 1, 0), ('Penjelasan Pasal 1', 'pasal', NULL, TRUE, 1, 3), ('Penjelasan Pasal 2', 'pasal', NULL, TRUE, 1, 3), ('[bagian tak berlabel] Pasal 1', 'pasal', NULL, TRUE, 1, 4)),
    d AS (SELECT concat('PERDA_', s_suppkey) AS doc_id, CAST(s_suppkey AS INT) AS s FROM supplier),
    e AS (SELECT * FROM d, u WHERE CASE w WHEN 1 THEN s % 2 = 0 WHEN 2 THEN s % 4 = 1 WHEN 3 THEN s % 7 <> 0 WHEN 4 THEN s % 7 = 0 ELSE TRUE END)"""


@query(f"WITH {_STRUCTURE} SELECT doc_id, citation, level, parent, leaf, CAST(n AS BIGINT) AS n FROM e")
def structure_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of all levels and sections, under damaged markers, repeats and restarts."""
    return segment.units(corpus.structured(spark, d)).groupBy("doc_id", "citation", "level", "parent", "leaf").agg(F.count("*").alias("n"))


@query(f"WITH {_STRUCTURE} SELECT doc_id, count(*) FILTER (level = 'pasal') AS pasal, sum(n) FILTER (level = 'ayat')::BIGINT AS ayat, sum(n) FILTER (level = 'huruf')::BIGINT AS huruf, sum(n) FILTER (level = 'angka')::BIGINT AS angka, sum(n) FILTER (leaf)::BIGINT AS units FROM e GROUP BY 1")
def structure_counts(spark: SparkSession, d: str) -> DataFrame:
    """Units of each level and leaves, with letters and numbers."""
    return segment.level_counts(segment.units(corpus.structured(spark, d)))


@query(f"WITH {_STRUCTURE} SELECT doc_id, citation FROM e")
def structure_index(spark: SparkSession, d: str) -> DataFrame:
    """One unit for each citation: of those that collide, the last."""
    return segment.unit_index(segment.units(corpus.structured(spark, d))).select("doc_id", "citation")


@query("""WITH d AS (SELECT concat('PERDA_', s_suppkey) AS doc_id, CAST(s_suppkey AS INT) AS s FROM supplier)
    SELECT doc_id, 0 AS section_no, 'body' AS section, FALSE AS restart FROM d
    UNION ALL SELECT doc_id, 1, CASE WHEN s % 7 <> 0 THEN 'penjelasan' ELSE 'unlabelled_restart' END, TRUE FROM d
    UNION ALL SELECT doc_id, 2, 'lampiran', FALSE FROM d WHERE s % 5 = 0""")
def structure_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections by heading and by restart."""
    return segment.sections(corpus.structured(spark, d)).select("doc_id", "section_no", "section", "restart")


@query("""WITH d AS (SELECT concat('PERDA_', s_suppkey) AS doc_id, CAST(s_suppkey AS INT) AS s FROM supplier)
    SELECT doc_id, 'duplicate_pasal_in_section' AS warning, CAST(NULL AS VARCHAR) AS citation, '5' AS pasal, CAST(NULL AS INT) AS from_num FROM d WHERE s % 2 = 0
    UNION ALL SELECT doc_id, 'duplicate_pasal_in_section', NULL, '7', NULL FROM d WHERE s % 4 = 1
    UNION ALL SELECT doc_id, 'multiple_huruf_runs_in_ayat', 'Pasal 8 ayat (1)', NULL, NULL FROM d
    UNION ALL SELECT doc_id, 'pasal_numbering_goes_backwards', NULL, NULL, 9 FROM d WHERE s % 4 = 1""")
def structure_warnings(spark: SparkSession, d: str) -> DataFrame:
    """Articles that come again, lists that open twice, numbers that go back."""
    docs = corpus.structured(spark, d)
    own = segment.unit_warnings(segment.units(docs)).select("doc_id", "warning", "citation", "pasal", F.lit(None).cast("int").alias("from_num"))
    return own.unionByName(segment.section_anomalies(docs).select("doc_id", "warning", F.lit(None).cast("string").alias("citation"), F.lit(None).cast("string").alias("pasal"), "from_num"))


@query("""WITH d AS (SELECT concat('PERDA_', s_suppkey) AS doc_id, CAST(s_suppkey AS INT) AS s FROM supplier)
    SELECT count(*) AS documents, CAST(sum(9 + CAST(s % 2 = 0 AS INT) + CAST(s % 4 = 1 AS INT) + CASE WHEN s % 7 <> 0 THEN 2 ELSE 1 END) AS BIGINT) AS pasal, count(*) * 7 AS ayat, count(*) * 9 AS huruf, count(*) * 5 AS angka,
    CAST(sum(22 + CAST(s % 2 = 0 AS INT) + CAST(s % 4 = 1 AS INT) + CASE WHEN s % 7 <> 0 THEN 2 ELSE 1 END) AS BIGINT) AS units, CAST(sum(1 + CAST(s % 2 = 0 AS INT) + CAST(s % 4 = 1 AS INT)) AS BIGINT) AS warnings, count(*) AS warned_documents FROM d""")
def structure_totals(spark: SparkSession, d: str) -> DataFrame:
    """The report line of a structure run."""
    units = segment.units(corpus.structured(spark, d))
    return sinks.structure_totals(segment.level_counts(units), segment.unit_warnings(units))


@query(f"""{_R}, a AS (SELECT sup, pasal, list_sort(list(DISTINCT CASE WHEN kind <= 5 THEN ['paling_tinggi', 'paling_rendah', 'paling_lama', 'paling_sedikit', 'paling_banyak', 'ditetapkan_sebesar', 'ditetapkan_dengan'][mk + 1] END) FILTER (kind <= 5)) AS m,
    CAST(count(*) FILTER (kind <= 6) AS INT) AS n_slots, CAST(count(*) FILTER (kind = 6) AS INT) AS w FROM r GROUP BY 1, 2)
    SELECT {_DOC} AS doc_id, concat('Pasal ', pasal) AS citation, coalesce(array_to_string(m, ','), '') AS bound_markers, n_slots, w AS n_modal_wajib,
    CASE WHEN n_slots > 0 THEN 'extract' ELSE 'skip' END AS bucket,
    concat_ws(',', CASE WHEN m IS NOT NULL AND len(m) > 0 THEN 'bound_marker' END, CASE WHEN n_slots > 0 THEN 'numeral_pair' END, CASE WHEN w > 0 THEN 'modal_wajib' END) AS selected_by,
    CASE WHEN n_slots = 0 THEN 'no_normative_marker' END AS skip_reason FROM a""")
def prefilter_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The bucket of every article and why."""
    b = prefilter.prefilter(segment.pasals(corpus.documents(spark, d)))
    return b.select("doc_id", "citation", F.array_join("bound_markers", ",").alias("bound_markers"), "n_slots", "n_modal_wajib", "bucket", F.array_join("selected_by", ",").alias("selected_by"), "skip_reason")


_PER_PASAL = f"""{_R}, a AS (SELECT sup, pasal, count(*) FILTER (kind <= 5) AS rates, count(*) FILTER (kind = 6) AS days FROM r GROUP BY 1, 2)"""


@query(f"""{_PER_PASAL} SELECT {_DOC} AS doc_id, count(*) AS body_pasal, count(*) FILTER (rates + days > 0) AS extract, count(*) FILTER (rates + days = 0) AS skip FROM a GROUP BY 1""")
def prefilter_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Buckets of each document."""
    return prefilter.per_document(prefilter.prefilter(segment.pasals(corpus.documents(spark, d))))


@query(f"""{_PER_PASAL} SELECT {_DOC} AS doc_id, count(*) AS body_pasal, nullif(count(*) FILTER (rates + days = 0), 0) AS no_normative_marker, nullif(count(*) FILTER (rates > 0), 0) AS bound_marker,
    nullif(count(*) FILTER (rates + days > 0), 0) AS numeral_pair, nullif(count(*) FILTER (days > 0), 0) AS modal_wajib FROM a GROUP BY 1""")
def prefilter_maps(spark: SparkSession, d: str) -> DataFrame:
    """How many articles of each document every reason skips or selects."""
    got = prefilter.per_document_maps(prefilter.prefilter(segment.pasals(corpus.documents(spark, d))))
    skips, picks = (lambda k: F.try_element_at("skip_reasons", F.lit(k))), (lambda k: F.try_element_at("selected_by", F.lit(k)))
    return got.select("doc_id", "body_pasal", skips("no_normative_marker").alias("no_normative_marker"), *(picks(k).alias(k) for k in ("bound_marker", "numeral_pair", "modal_wajib")))


@query(f"""{_PER_PASAL} SELECT 'numeral_pair' AS reason, count(*) AS n FROM a WHERE rates + days > 0 UNION ALL SELECT 'bound_marker', count(*) FROM a WHERE rates > 0 UNION ALL SELECT 'modal_wajib', count(*) FROM a WHERE days > 0""")
def prefilter_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How often each reason selects an article."""
    return prefilter.reasons(prefilter.prefilter(segment.pasals(corpus.documents(spark, d))))


@query(f"""{_R} SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page, CASE WHEN kind <= 5 THEN 'fraction' ELSE 'hari_kerja' END AS unit,
    CASE WHEN kind <= 5 AND {_HIT} THEN 'sources_agree_after_repair' WHEN kind = 6 AND {_COUNT_HIT} THEN 'sources_agree_after_repair' ELSE 'sources_agree' END AS status, count(*) AS n FROM r WHERE kind <= 6
    GROUP BY 1, 2, 3, 4""")
def reconcile_readings(spark: SparkSession, d: str) -> DataFrame:
    """A damaged and a clean reading of every article, figure by figure.

    Figures of one value pair by position, so statuses are counted by page.
    """
    key = ["doc_id", "page"]
    # paragraphs are pages of their own here: pairs meet at their own place
    page = lambda damaged: reconcile.readings(corpus.paragraphs(spark, d, damaged).select("doc_id", F.col("pasal").alias("page"), "ayat", "text"), [*key, "ayat"])
    found = reconcile.reconcile(page(True), page(False), [*key, "ayat"])
    return found.groupBy(*key, "unit", "status").agg(F.count("*").alias("n"))


@query(f"""{_R} SELECT CASE WHEN kind <= 5 AND {_HIT} THEN 'sources_agree_after_repair' WHEN kind = 6 AND {_COUNT_HIT} THEN 'sources_agree_after_repair' ELSE 'sources_agree' END AS status, count(*) AS n
    FROM r WHERE kind <= 6 GROUP BY 1""")
def reconcile_summary(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of the two readings over the corpus."""
    page = lambda damaged: reconcile.readings(corpus.paragraphs(spark, d, damaged), ["doc_id", "pasal", "ayat"])
    return reconcile.summary(reconcile.reconcile(page(True), page(False), ["doc_id", "pasal", "ayat"]))


@query(f"""{_R} SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page, CAST(ayat AS INT) AS ayat,
    CASE ln % 5 WHEN 0 THEN 'sources_agree' WHEN 1 THEN 'text_layer_yields' WHEN 2 THEN 'single_source' WHEN 3 THEN 'sources_disagree' ELSE 'reocr_yields' END AS status,
    CASE ln % 5 WHEN 0 THEN 'text_layer' WHEN 1 THEN 'reocr' WHEN 2 THEN 'text_layer' WHEN 3 THEN NULL ELSE 'text_layer' END AS chosen, CAST(CASE WHEN ln % 5 <> 3 THEN p * 100 END AS INT) AS value FROM r""")
def reconcile_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Readings that agree, yield, disagree or stand alone, by the line's number."""
    word = F.element_at(F.array(*map(F.lit, corpus.WORDS)), F.col("p") + 1)
    case = F.col("ln") % 5

    def reading(wrong: list[int], by: int, lost: list[int]) -> DataFrame:
        digits = F.when(case.isin(*wrong), F.col("p") + by).otherwise(F.col("p"))
        said = F.concat(F.lit("Tarif "), digits, F.lit("% ("), word, F.lit(" persen)."))
        rows = corpus.truth(spark, d).select(F.concat(F.lit("PERDA_"), "sup").alias("doc_id"), F.col("pasal").alias("page"), "ayat", F.when(case.isin(*lost), corpus.NEUTRAL).otherwise(said).alias("text"))
        return reconcile.readings(rows, ["doc_id", "page", "ayat"])

    found = reconcile.reconcile(reading([1, 3], 20, [-1]), reading([3, 4], 30, [2]), ["doc_id", "page", "ayat"])
    return found.select("doc_id", "page", "ayat", "status", "chosen", F.round(F.col("value") * 10000).cast("int").alias("value"))


def _slots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slots, and records whose citations and slots are wrong in known ways."""
    arts = kept(corpus.articles(spark, d).select("doc_id", F.concat_ws("#", "doc_id", "pasal").alias("pasal_key"), "pasal", "text"))
    table = slots.slot_table(arts).select(F.col("pasal_key").alias("call"), "slot_no", "slot", "start", "end", "value", "unit", "source_numeral", "source_words", "ocr_recovered", "needs_review")
    marks = arts.select("pasal_key", "text", segment.ayat_marks(F.col("text")).alias("m")).select("pasal_key", "text", F.posexplode_outer("m").alias("i", "x"), F.transform("m", lambda x: x["at"]).alias("ats")).where("x is not null")
    unit = marks.select(F.col("pasal_key").alias("call"), F.concat(F.lit("ayat "), "x.label").alias("citation"), F.col("x.from").alias("start"), F.coalesce(F.get("ats", F.col("i") + 1), F.length("text")).alias("end"))
    return kept(table), kept(unit), arts


@query(f"""{_R}, s AS (SELECT *, row_number() OVER (PARTITION BY sup, pasal ORDER BY ayat) AS k FROM r WHERE kind <= 6),
    c AS (SELECT *, CASE WHEN k % 5 = 1 THEN ayat + 1 ELSE ayat END AS cited, max(k) OVER (PARTITION BY sup, pasal) AS last FROM s),
    n AS (SELECT sup, pasal, max(ayat) AS top FROM r GROUP BY 1, 2)
    SELECT * FROM (SELECT 'citation_not_in_pasal' AS error, count(*) AS n FROM c JOIN n USING (sup, pasal) WHERE cited > top
    UNION ALL SELECT 'slot_outside_cited_unit', count(*) FROM c JOIN n USING (sup, pasal) WHERE cited <> ayat AND cited <= top AND k % 7 <> 0
    UNION ALL SELECT 'unknown_slot', count(*) FROM c WHERE k % 7 = 0) WHERE n > 0""")
def slot_errors(spark: SparkSession, d: str) -> DataFrame:
    """Validation errors of records that cite the next paragraph (every fifth)
    or a slot that isn't there (every seventh)."""
    table, unit, _ = _slots(spark, d)
    at = interval.within(table, unit, ["call"]).select("call", "l.slot_no", "l.slot", F.regexp_extract("r.citation", "([0-9]+)", 1).cast("int").alias("ayat"))
    cited = F.when(F.col("slot_no") % 5 == 1, F.col("ayat") + 1).otherwise(F.col("ayat"))
    norms = at.select("call", F.concat_ws("-", "call", "slot").alias("norm"), F.col("slot_no").alias("norm_ord"), F.concat(F.lit("ayat "), cited).alias("citation"), "slot_no", "slot")
    bounds = norms.select("call", "norm", "norm_ord", F.lit(0).alias("bound_ord"), F.lit("<=").alias("op"), F.when(F.col("slot_no") % 7 == 0, "N0").otherwise(F.col("slot")).alias("slot"))
    _, errors, _ = slots.resolve(norms.select("call", "norm", "norm_ord", "citation"), bounds, table, unit)
    return errors.groupBy("error").agg(F.count("*").alias("n"))


@query(f"""{_R}, s AS (SELECT *, row_number() OVER (PARTITION BY sup, pasal ORDER BY ayat) AS k FROM r WHERE kind <= 6) SELECT concat({_DOC}, '#', pasal) AS call, concat('N', k) AS slot FROM s WHERE k % 3 = 0""")
def slot_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Slots that no record uses, where every third is left out."""
    table, unit, _ = _slots(spark, d)
    norms = table.where("slot_no % 3 <> 0").select("call", F.concat_ws("-", "call", "slot").alias("norm"), F.col("slot_no").alias("norm_ord"), F.lit("ayat 1").alias("citation"), "slot")
    bounds = norms.select("call", "norm", "norm_ord", F.lit(0).alias("bound_ord"), F.lit("<=").alias("op"), "slot")
    return slots.resolve(norms.drop("slot"), bounds, table, unit)[2]


_GARBAGE = "[�\\p{Co}一-鿿぀-ヿ＀-￯]"


@query(f"""SELECT doc_id, CASE WHEN length(s) < 30 THEN 'empty' WHEN len(regexp_extract_all(s, '{_GARBAGE}')) / length(s) > 0.02 THEN 'corrupted' ELSE 'clean' END AS classification
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS s FROM documents)""")
def page_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document classified as a page of text."""
    return _read(spark, d, "documents").select("doc_id", text.page_class(F.col("text"))["classification"].alias("classification"))


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(replace(text, chr(173), ''), '-\\s*\\n\\s*', '-', 'g'), '\\s+', ' ', 'g')) AS canonical,
    substr(trim(regexp_replace(lower(trim(regexp_replace(regexp_replace(replace(text, chr(173), ''), '-\\s*\\n\\s*', '-', 'g'), '\\s+', ' ', 'g'))), '[^a-z0-9]+', '_', 'g'), '_'), 1, 60) AS slug FROM documents""")
def canonical_text(spark: SparkSession, d: str) -> DataFrame:
    """Canonical text and identifier of every document."""
    t = F.col("text")
    return _read(spark, d, "documents").select("doc_id", text.canonical(t).alias("canonical"), text.slug(t).alias("slug"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Articles as pages under a running head and a page number."""
    body = F.concat(F.lit("LEMBARAN "), "doc_id", F.lit("\n"), "text", F.lit("\n- "), "pasal", F.lit(" -\n"))
    return corpus.articles(spark, d).select("doc_id", F.col("pasal").alias("page"), body.alias("text"))


@query(f"""{_R}, a AS (SELECT sup, pasal, count(*) AS k FROM r GROUP BY 1, 2) SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page, CAST(CASE WHEN n >= 2 THEN 2 ELSE 1 END AS BIGINT) AS removed FROM (SELECT *, count(*) OVER (PARTITION BY sup) AS n FROM a)""")
def furniture_lines(spark: SparkSession, d: str) -> DataFrame:
    """Running heads and page numbers blanked on every page."""
    found = layout.strip_furniture(_pages(spark, d))
    head = F.split("text", "\n")
    own = F.size(F.filter(F.array(head[0], F.element_at(head, -1)), lambda x: (F.length(x) > 0) & (F.trim(x) == "")))
    return found.select("doc_id", "page", own.cast("bigint").alias("removed"))


@query(f"""{_R}, a AS (SELECT sup, pasal, string_agg(concat('(', ayat, ') x'), chr(10) ORDER BY ayat) AS t FROM r GROUP BY 1, 2),
    s AS (SELECT sup, pasal, coalesce(sum(length(t) + 1) OVER (PARTITION BY sup ORDER BY pasal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, length(t) AS n FROM a)
    SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page, CAST(b AS INT) AS start, CAST(b + n AS INT) AS "end" FROM s""")
def page_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where each page lies in its document's joined text."""
    rows = corpus.truth(spark, d).select(F.concat(F.lit("PERDA_"), "sup").alias("doc_id"), F.col("pasal").alias("page"), "ayat")
    line = F.struct("ayat", F.concat(F.lit("("), "ayat", F.lit(") x")).alias("t"))
    pages = rows.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["t"]), "\n").alias("text"))
    return layout.page_spans(pages)


@query(f"""{_R} SELECT {_DOC} AS doc_id, CAST(pasal AS VARCHAR) AS pasal, CASE WHEN ayat % 3 = 1 THEN 'same_pasal' ELSE 'cross_pasal' END AS status,
    CASE WHEN ayat % 3 = 1 THEN CAST(pasal AS VARCHAR) ELSE CAST(pasal + 1 AS VARCHAR) END AS target, CASE WHEN ayat % 3 = 0 THEN NULL ELSE CAST(ayat AS VARCHAR) END AS ayat, count(*) AS n
    FROM r GROUP BY 1, 2, 3, 4, 5""")
def crossref_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets of injected citations: this article, a paragraph of the next, or all of it."""
    truth = corpus.named(spark, d)
    phrase = (
        F.when(F.col("ayat") % 3 == 1, F.concat(F.lit("sebagaimana dimaksud pada ayat ("), "ayat", F.lit(").")))
        .when(F.col("ayat") % 3 == 2, F.concat(F.lit("sebagaimana diatur dalam Pasal "), F.col("pasal") + 1, F.lit(" ayal ("), "ayat", F.lit(").")))
        .otherwise(F.concat(F.lit("sebagaimana dimaksud dalam Pasal "), F.col("pasal") + 1, F.lit(".")))
    )
    rows = truth.select("doc_id", F.col("pasal").cast("string").alias("pasal"), F.concat(F.lit("Hal "), phrase).alias("text"))
    refs = rows_of(crossref.references(rows), F.col("targets"), "doc_id", "pasal").withColumnRenamed("m", "t")
    status = F.when(F.col("t.pasal") == F.col("pasal"), "same_pasal").otherwise("cross_pasal")
    return refs.select("doc_id", "pasal", status.alias("status"), F.col("t.pasal").alias("target"), F.col("t.ayat").alias("ayat")).groupBy("doc_id", "pasal", "status", "target", "ayat").agg(F.count("*").alias("n"))


_CITED = f"""{_R}, t AS (SELECT sup, pasal, ayat, kind, CASE kind WHEN 1 THEN concat('Hal sebagaimana diatur dalam Pasal ', pasal + 1, ' ayal (1).') WHEN 2 THEN concat('Hal sebagaimana dimaksud dalam Pasal ', pasal + 1, '.')
      WHEN 3 THEN 'Hal sebagaimana diatur dalam Undang-Undang mengenai pajak.' WHEN 4 THEN 'Hal sebagaimana telah diubah dengan yang lain.' WHEN 5 THEN 'Hal sebagaimana dimaksud di atas sana.'
      WHEN 6 THEN concat('Hal sebagaimana dimaksud dalam Pasal ', pasal + 1, ' ayat (1) huruf b.') ELSE concat('Hal sebagaimana dimaksud pada ayat (', ayat, ').') END AS line FROM r),
    a AS (SELECT sup, pasal, concat(chr(10), string_agg(concat('(', ayat, ') ', line, chr(10)), '' ORDER BY ayat)) AS whole, max(line) FILTER (ayat = 1) AS one, list(line ORDER BY ayat) AS lines FROM t GROUP BY 1, 2)"""


def _cited(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): documents whose paragraphs cite in every way there is,
    with an earlier article of the same number and an explanation after them."""
    k, nxt = F.col("kind"), (F.col("pasal") + 1).cast("string")
    line = (
        F.when(k == 1, F.concat(F.lit("Hal sebagaimana diatur dalam Pasal "), nxt, F.lit(" ayal (1).")))
        .when(k == 2, F.concat(F.lit("Hal sebagaimana dimaksud dalam Pasal "), nxt, F.lit(".")))
        .when(k == 3, "Hal sebagaimana diatur dalam Undang-Undang mengenai pajak.")
        .when(k == 4, "Hal sebagaimana telah diubah dengan yang lain.")
        .when(k == 5, "Hal sebagaimana dimaksud di atas sana.")
        .when(k == 6, F.concat(F.lit("Hal sebagaimana dimaksud dalam Pasal "), nxt, F.lit(" ayat (1) huruf b.")))
        .otherwise(F.concat(F.lit("Hal sebagaimana dimaksud pada ayat ("), "ayat", F.lit(").")))
    )
    rows = corpus.named(spark, d).select("doc_id", "pasal", "ayat", F.concat(F.lit("("), "ayat", F.lit(") "), line, F.lit("\n")).alias("line"))
    arts = rows.groupBy("doc_id", "pasal").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ayat", "line"))), lambda x: x["line"]), "").alias("t"))
    whole = arts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pasal", F.concat(F.lit("Pasal "), "pasal", F.lit("\n"), "t").alias("t")))).alias("l"))
    return whole.select("doc_id", F.concat(F.lit("Pasal 1\n(1) Lama.\n(9) Lama.\n"), F.array_join(F.transform("l", lambda x: x["t"]), ""), F.lit("PENJELASAN\nPasal 1\n(1) Cukup jelas.\n")).alias("text"))


@query(f"""{_CITED}, p AS (SELECT t.*, CAST(row_number() OVER (PARTITION BY t.sup, t.pasal ORDER BY ayat) - 1 AS INT) AS ref_no, n.whole, n.one FROM t LEFT JOIN a n ON n.sup = t.sup AND n.pasal = t.pasal + 1)
    SELECT {_DOC} AS doc_id, CAST(pasal AS VARCHAR) AS pasal, ref_no, CASE WHEN kind IN (0, 7) THEN 'same_pasal' WHEN kind IN (1, 2, 6) THEN 'cross_pasal' WHEN kind = 3 THEN 'external' WHEN kind = 4 THEN 'amendment_history' ELSE 'unresolved' END AS status,
    CASE kind WHEN 5 THEN TRUE WHEN 6 THEN TRUE WHEN 1 THEN whole IS NULL WHEN 2 THEN whole IS NULL ELSE FALSE END AS needs_review, CASE kind WHEN 3 THEN 'Undang-Undang mengenai pajak' WHEN 5 THEN 'di atas sana' END AS note,
    CASE WHEN kind IN (1, 2, 6) THEN CAST(pasal + 1 AS VARCHAR) WHEN kind IN (0, 7) THEN CAST(pasal AS VARCHAR) END AS target,
    CASE WHEN kind = 2 THEN md5(whole) WHEN kind IN (1, 6) AND whole IS NOT NULL THEN md5(concat(one, chr(10))) END AS found FROM p""")
def crossref_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Every citation resolved against its document's strict index, with what was found."""
    got = crossref.resolve_documents(_cited(spark, d))
    target = F.get("targets", F.lit(0))
    return got.select("doc_id", "pasal", "ref_no", "status", "needs_review", "note", target["pasal"].alias("target"), F.md5(target["text"].cast("binary")).alias("found"))


@query(f"""{_CITED} SELECT {_DOC} AS doc_id, CAST(pasal AS VARCHAR) AS pasal, CAST(NULL AS VARCHAR) AS ayat, md5(whole) AS text FROM a
    UNION ALL SELECT {_DOC}, CAST(pasal AS VARCHAR), CAST(i AS VARCHAR), md5(concat(lines[i], chr(10))) FROM (SELECT sup, pasal, lines, unnest(range(1, len(lines) + 1)) AS i FROM a)""")
def crossref_index(spark: SparkSession, d: str) -> DataFrame:
    """The strict index: of two articles with one number the last, nothing of the explanation."""
    return crossref.strict_index(_cited(spark, d)).select("doc_id", "pasal", "ayat", F.md5(F.col("text").cast("binary")).alias("text"))


@query("""WITH t AS (SELECT DISTINCT p_brand AS b, p_type AS c FROM part), c AS (SELECT concat('b:', b) AS id, CAST(NULL AS VARCHAR) AS parent FROM t UNION SELECT concat('c:', c, '@', b), concat('b:', b) FROM t
    UNION SELECT concat('p:', p_partkey), concat('c:', p_type, '@', p_brand) FROM part)
    SELECT id, id AS ancestor, CAST(0 AS INT) AS depth FROM c UNION ALL SELECT id, parent, CAST(1 AS INT) FROM c WHERE parent IS NOT NULL
    UNION ALL SELECT c.id, e.parent, CAST(2 AS INT) FROM c JOIN c e ON c.parent = e.id WHERE e.parent IS NOT NULL""")
def subsumption_closure(spark: SparkSession, d: str) -> DataFrame:
    """Parts under types under brands: every category with all it is under."""
    part = _read(spark, d, "part")
    brand, kind = F.concat(F.lit("b:"), "p_brand"), F.concat(F.lit("c:"), "p_type", F.lit("@"), "p_brand")
    cats = part.select(brand.alias("id"), F.lit(None).cast("string").alias("parent")).distinct()
    cats = cats.unionByName(part.select(kind.alias("id"), brand.alias("parent")).distinct()).unionByName(part.select(F.concat(F.lit("p:"), "p_partkey").alias("id"), kind.alias("parent")))
    return conflict.closure(cats)


@query("""SELECT l_orderkey AS provision, max(CAST(floor(l_discount * 100 + 0.5) AS INT)) AS low, min(CAST(floor(l_tax * 100 + 0.5) AS INT) + 2) AS high,
    max(CAST(floor(l_discount * 100 + 0.5) AS INT)) <= min(CAST(floor(l_tax * 100 + 0.5) AS INT) + 2) AS sat FROM lineitem GROUP BY 1""")
def interval_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Whether an order's floors (discounts) and ceilings (taxes plus two) share a rate."""
    percent = lambda c: F.floor(F.col(c) * 100 + 0.5).cast("int")
    pair = F.array(F.struct(F.lit(">=").alias("op"), (percent("l_discount") / 100.0).alias("value")), F.struct(F.lit("<=").alias("op"), ((percent("l_tax") + 2) / 100.0).alias("value")))
    rows = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("provision"), F.col("l_linenumber").alias("ord"), F.col("l_suppkey").alias("norm"), F.inline(pair))
    out = conflict.interval(rows, ["provision"])
    return out.select("provision", F.round(F.col("low") * 100).cast("int").alias("low"), F.round(F.col("high") * 100).cast("int").alias("high"), "sat")


@query("""WITH s AS (SELECT lower(p_type) AS term, min(p_partkey) AS ord FROM part GROUP BY 1), l AS (SELECT p_partkey, lower(concat(p_type, CASE WHEN p_size % 2 = 0 THEN '' ELSE concat(' ', p_brand) END)) AS lab FROM part)
    SELECT p_partkey AS local_id, CASE WHEN lab = term THEN 'same_as' ELSE 'subclass_of' END AS proposed_relation, ord AS statutory_id FROM l JOIN s ON lab = term OR starts_with(lab, concat(term, ' '))
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN lab = term THEN 0 ELSE 1 END, ord) = 1""")
def alignments(spark: SparkSession, d: str) -> DataFrame:
    """Part labels that equal a part type, or extend one."""
    part = _read(spark, d, "part")
    common = [F.lit("d").alias("doc_id"), F.lit("c").alias("origin_citation"), F.lit(True).alias("taxable_subject")]
    live = part.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("id"), F.col("p_type").alias("label"), *common)
    label = F.concat("p_type", F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit(" "), "p_brand")))
    local = part.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("id"), label.alias("label"), *common)
    return ontology.alignments(live, local).select("local_id", "proposed_relation", "statutory_id")


@query("""WITH g AS (SELECT p_brand, list_sort(list(DISTINCT lower(p_type))) AS m FROM part GROUP BY 1) SELECT p_brand AS brand, array_to_string(m, '|') AS members FROM g""")
def split_services(spark: SparkSession, d: str) -> DataFrame:
    """The members of a list of part types, written as a provision writes it."""
    rows = _read(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(F.lower("p_type"))).alias("m"))
    body = F.concat(F.array_join(F.slice("m", F.lit(1), F.size("m") - 1), ", "), F.lit(", dan "), F.element_at("m", -1), F.lit(";"))
    return rows.select(F.col("p_brand").alias("brand"), F.array_join(ontology.split_services(body)["members"], "|").alias("members"))


@query(f"""{_R}, v AS (SELECT ln AS provision, sup, max(p) AS value FROM r GROUP BY 1, 2), k AS (SELECT provision, value, count(*) AS k FROM v GROUP BY 1, 2),
    u AS (SELECT provision, arg_min(value, struct_pack(a := -k, b := value)) AS usual, CAST(sum(k) AS BIGINT) AS n FROM k GROUP BY 1 HAVING sum(k) >= 3)
    SELECT provision, sup AS instrument, value, usual, n FROM v JOIN u USING (provision) WHERE value <> usual""")
def cross_instrument_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers whose largest rate in a provision differs from the usual one."""
    rates = corpus.truth(spark, d).groupBy(F.col("ln").alias("provision"), F.col("sup").alias("instrument")).agg(F.max("p").alias("value"))
    return conflict.outliers(rates)


_VOCABULARY = ", ".join(f"('{w}', {(numerals.UNITS | numerals.SPECIAL).get(w, -1)})" for w in numerals.VOCABULARY)


@query(f"""WITH v(w, x) AS (VALUES {_VOCABULARY}), t AS (SELECT DISTINCT overlay AS tok FROM (SELECT concat(substr(w, 1, k), chr(CAST(97 + s % 26 AS INT)), substr(w, k + 2)) AS overlay
    FROM (SELECT w, s_suppkey AS s, CAST(s_suppkey % length(w) AS INT) AS k FROM v, supplier))),
    n AS (SELECT tok, w, x FROM t JOIN v ON levenshtein(tok, w) = 1), g AS (SELECT tok, min(w) AS w, count(DISTINCT x) AS k FROM n GROUP BY 1)
    SELECT t.tok AS token, CASE WHEN t.tok IN (SELECT w FROM v) THEN t.tok WHEN g.k = 1 THEN g.w END AS word FROM t LEFT JOIN g USING (tok)""")
def levenshtein_snap(spark: SparkSession, d: str) -> DataFrame:
    """Number words with one damaged letter, and the word that each is repaired to."""
    k, s = F.col("k"), F.col("s_suppkey")
    both = _read(spark, d, "supplier").select("s_suppkey", F.explode(F.array(*map(F.lit, numerals.VOCABULARY))).alias("w")).withColumn("k", (s % F.length("w")).cast("int"))
    token = F.concat(F.substring(F.col("w"), F.lit(1), k), F.char(97 + s % 26), F.substring(F.col("w"), k + 2, F.length("w")))
    tokens = both.select(token.alias("token")).distinct()
    known = F.array_contains(F.array(*map(F.lit, numerals.VOCABULARY)), F.col("token"))
    return tokens.select("token", F.when(known, F.col("token")).otherwise(F.try_element_at(numerals.snap(F.col("token"))["words"], F.lit(1))).alias("word"))


@query("""WITH b AS (SELECT p_brand, list_sort(list(DISTINCT lower(p_type))) AS m FROM part GROUP BY 1),
    s AS (SELECT concat('UU_', p_brand) AS doc_id, regexp_replace(lower(concat('objek pajak ', p_brand)), '[^a-z0-9]+', '_', 'g') AS sid, concat('Objek pajak ', p_brand) AS label, m FROM b)
    SELECT doc_id, 'subject' AS level, sid AS id, label, CAST(NULL AS VARCHAR) AS parent FROM s
    UNION ALL SELECT doc_id, 'huruf', regexp_replace(x, '[^a-z0-9]+', '_', 'g'), x, sid FROM (SELECT *, unnest(m) AS x FROM s)""")
def category_harvest(spark: SparkSession, d: str) -> DataFrame:
    """Categories of provisions that list the part types of each brand."""
    rows = _read(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(F.lower("p_type"))).alias("m"))
    items = F.array_join(F.transform("m", lambda x, i: F.concat(F.char(97 + i), F.lit(". "), x, F.lit(";\n"))), "")
    docs = rows.select(F.concat(F.lit("UU_"), "p_brand").alias("doc_id"), F.concat(F.lit("Pasal 1\n(1) Objek pajak "), "p_brand", F.lit(" meliputi:\n"), items).alias("text"))
    cats, _ = ontology.harvest(segment.units(docs))
    return cats.select("doc_id", "level", "id", "label", "parent")


@query(f"""{_R}, n AS (SELECT sup, pasal, max(ayat) AS top FROM r GROUP BY 1, 2) SELECT concat({_DOC}, '#', r.pasal, '#', ayat) AS norm, CAST(CASE WHEN ayat + 1 <= top THEN 1 ELSE 0 END AS BIGINT) AS hits,
    CASE WHEN ayat + 1 <= top THEN 'ok' ELSE 'MISSING' END AS verdict FROM r JOIN n USING (sup, pasal)""")
def gold_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Records that cite the paragraph after their own."""
    norms = corpus.paragraphs(spark, d).select("doc_id", F.concat_ws("#", "doc_id", "pasal", "ayat").alias("norm"), F.concat(F.lit("Pasal "), "pasal", F.lit(" ayat ("), F.col("ayat") + 1, F.lit(")")).alias("citation"))
    return crossref.gold_resolution(norms, _units(spark, d))


@query("""WITH f AS (SELECT DISTINCT regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g') AS id, lower(p_type) AS label FROM part),
    g AS (SELECT CASE WHEN length(label) % 2 = 0 THEN concat('g_', id) ELSE id END AS id, label FROM f UNION ALL SELECT 'none', 'none')
    SELECT g.id, CASE WHEN g.id IN (SELECT id FROM f) THEN 'matched' WHEN g.label IN (SELECT label FROM f) THEN 'renamed' ELSE 'missed' END AS verdict FROM g
    UNION ALL SELECT id, 'extra' FROM f WHERE id NOT IN (SELECT id FROM g)""")
def ontology_compare(spark: SparkSession, d: str) -> DataFrame:
    """Part types against a copy in which some have other identifiers."""
    found = _read(spark, d, "part").select(text.slug(F.col("p_type")).alias("id"), F.lower("p_type").alias("label")).distinct()
    gold = found.select(F.when(F.length("label") % 2 == 0, F.concat(F.lit("g_"), "id")).otherwise(F.col("id")).alias("id"), "label")
    return ontology.compare(found, gold.unionByName(spark.createDataFrame([("none", "none")], "id string, label string")))


def _rates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Categories (brands under types), and the rules of a national and a local
    instrument with their bounds."""
    k = _read(spark, d, "part").groupBy(F.col("p_type").alias("t"), F.col("p_brand").alias("b")).agg(F.count("*").alias("n"))
    own = F.concat_ws("@", "b", "t")
    cats = k.select(own.alias("id"), own.alias("label"), F.col("t").alias("parent")).unionByName(k.select(F.col("t").alias("id"), F.col("t").alias("label"), F.lit(None).cast("string").alias("parent")).distinct())
    caps = k.groupBy("t").agg((F.sum("n") % 11).alias("v")).where(F.length("t") % 2 == 0)

    def norm(rows: DataFrame, name: Column, instrument: str, rank: int, applies: Column, residual: bool, op: str, value: Column) -> DataFrame:
        return rows.select(name.alias("norm"), F.lit(0).alias("ord"), F.lit(instrument).alias("instrument"), F.lit(rank).alias("rank"), F.lit("rate_constraint").alias("norm_type"), F.array(applies).alias("applies_to"), F.lit(residual).alias("is_residual"), F.lit(op).alias("op"), (value / 100.0).alias("value"))

    rules = norm(caps, F.concat(F.lit("U-"), "t"), "U", 3, F.col("t"), False, "<=", F.col("v"))
    rules = rules.unionByName(norm(spark.range(1), F.lit("U-rest"), "U", 3, F.lit("*"), True, "<=", F.lit(5)))
    rules = rules.unionByName(norm(k, F.concat(F.lit("L-"), own), "L", 7, own, False, "==", F.col("n") % 11))
    return cats, rules


@query("""WITH k AS (SELECT p_type AS t, p_brand AS b, count(*) AS n FROM part GROUP BY 1, 2), c AS (SELECT t, CASE WHEN length(t) % 2 = 0 THEN sum(n) % 11 END AS cap FROM k GROUP BY 1)
    SELECT concat(b, '@', t) AS category, CASE WHEN n % 11 <= coalesce(cap, 5) THEN 'COMPLIANT' ELSE 'CONFLICT' END AS verdict, CAST(CASE WHEN n % 11 <= coalesce(cap, 5) THEN n % 11 END AS INT) AS witness, cap IS NULL AS national_via_residual
    FROM k JOIN c USING (t)""")
def rate_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Rates of a local instrument for brands under types, against the caps of a
    national one for some types and its residual rule for the rest."""
    cats, rules = _rates(spark, d)
    norms = rules.select("norm", "ord", "instrument", "rank", "norm_type", "applies_to", "is_residual", F.array().cast("array<string>").alias("delegated_scope"), F.array().cast("array<string>").alias("open_textured_terms"))
    none = spark.createDataFrame([], "id string, label string")
    got = conflict.verdicts(norms, rules.select("norm", "ord", "op", "value"), cats, none, "U", "L")
    return got.select("category", "verdict", F.round(F.col("witness") * 100).cast("int").alias("witness"), "national_via_residual")


@query("""WITH k AS (SELECT p_type AS t, p_brand AS b, count(*) AS n FROM part GROUP BY 1, 2), c AS (SELECT t, CASE WHEN length(t) % 2 = 0 THEN sum(n) % 11 END AS cap FROM k GROUP BY 1)
    SELECT concat(b, '@', t) AS category, CASE WHEN length(t) % 5 = 0 THEN 'ABSTAIN' WHEN n % 11 <= coalesce(cap, 5) THEN 'COMPLIANT' ELSE 'CONFLICT' END AS verdict,
    CASE WHEN cap IS NOT NULL AND n % 11 <= cap THEN 'U-gives' END AS authorised_by, CASE WHEN length(t) % 5 = 0 THEN 'vague' END AS abstained_on, CASE WHEN length(t) % 5 <> 0 AND length(b) % 2 = 0 THEN 'vague' END AS caveat FROM k JOIN c USING (t)
    UNION ALL SELECT t, 'COMPLIANT', CASE WHEN cap IS NOT NULL THEN 'U-gives' END, NULL, 'vague' FROM c WHERE length(t) % 5 = 0""")
def delegated_rates(spark: SparkSession, d: str) -> DataFrame:
    """The same rates where the national instrument delegates its caps, some local
    rules have an open term, and others with one reach brands from their type."""
    cats, rules = _rates(spark, d)
    none = F.array().cast("array<string>")
    vague = F.array(F.lit("vague"))
    own = rules.withColumn("delegated_scope", none).withColumn("open_textured_terms", F.when((F.col("instrument") == "L") & (F.length(F.substring_index("norm", "@", 1)) % 2 == 0), vague).otherwise(none))
    types = cats.where("parent is null and length(id) % 5 = 0")
    reach = types.select(F.concat(F.lit("L-all-"), "id").alias("norm"), F.lit(1).alias("ord"), F.lit("L").alias("instrument"), F.lit(7).alias("rank"), F.lit("rate_constraint").alias("norm_type"), F.array("id").alias("applies_to"), F.lit(False).alias("is_residual"), F.lit(">=").alias("op"), F.lit(0.0).alias("value"), none.alias("delegated_scope"), vague.alias("open_textured_terms"))
    gives = rules.where("instrument = 'U' and not is_residual").agg(F.collect_set("norm").alias("delegated_scope")).select(F.lit("U-gives").alias("norm"), F.lit(2).alias("ord"), F.lit("U").alias("instrument"), F.lit(3).alias("rank"), F.lit("delegation").alias("norm_type"), none.alias("applies_to"), F.lit(False).alias("is_residual"), "delegated_scope", none.alias("open_textured_terms"))
    norms = own.unionByName(reach)
    terms = spark.createDataFrame([("vague", "v")], "id string, label string")
    got = conflict.verdicts(norms.drop("op", "value").unionByName(gives), norms.select("norm", "ord", "op", "value"), cats, terms, "U", "L")
    return got.select("category", "verdict", "authorised_by", F.array_join("abstained_on", ",").alias("abstained_on"), F.array_join("caveat", ",").alias("caveat"))


_ARTICLE_HIT = f"""{_R}, h AS (SELECT sup, pasal, bool_or((kind <= 5 AND {_HIT}) OR (kind = 6 AND {_COUNT_HIT})) AS hit FROM r GROUP BY 1, 2)"""


@query(f"{_ARTICLE_HIT} SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page FROM h WHERE hit AND pasal % 4 <> 0")
def candidate_pages(spark: SparkSession, d: str) -> DataFrame:
    """Text-layer pages with a figure that a second reading should confirm."""
    pages = corpus.articles(spark, d).select("doc_id", F.col("pasal").alias("page"), F.when(F.col("pasal") % 4 == 0, "ocr").otherwise("text_layer").alias("method"), "text")
    return reconcile.candidate_pages(pages).select("doc_id", "page")


@query(f"""{_ARTICLE_HIT}, n AS (SELECT *, row_number() OVER (PARTITION BY sup ORDER BY pasal) AS k FROM h WHERE hit AND pasal % 4 <> 0) SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS page FROM n WHERE k <= 3""")
def candidate_pages_limited(spark: SparkSession, d: str) -> DataFrame:
    """The first three such pages of each document."""
    pages = corpus.articles(spark, d).select("doc_id", F.col("pasal").alias("page"), F.when(F.col("pasal") % 4 == 0, "ocr").otherwise("text_layer").alias("method"), "text")
    return reconcile.candidate_pages(pages, 3).select("doc_id", "page")


@query(f"{_PER_PASAL} SELECT count(*) AS body_pasal, count(*) FILTER (rates + days > 0) AS extract, count(*) FILTER (rates + days > 0) / count(*) AS share FROM a")
def prefilter_share(spark: SparkSession, d: str) -> DataFrame:
    """How much of the corpus goes to extraction."""
    return prefilter.corpus_share(prefilter.prefilter(segment.pasals(corpus.documents(spark, d))))


_LAYER = "CASE s % 5 WHEN 0 THEN 'ocr' WHEN 1 THEN 'ocr' WHEN 2 THEN 'ocr_failed' ELSE 'text_layer' END"


@query(f"""WITH p AS (SELECT CAST(s_suppkey AS INT) AS s FROM supplier)
    SELECT concat('D_', s % 3) AS doc_id, s AS page, {_LAYER} AS method, CASE WHEN s % 5 = 2 THEN 'empty' ELSE 'clean' END AS classification, CASE s % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'corrupted' END AS replaced_classification, s % 5 = 1 AS kept_layer FROM p""")
def extracted_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose layer is empty, garbage or clean, with and without an OCR reading."""
    found = _extracted(spark, d)
    return found.select("doc_id", "page", "method", "classification", "replaced_classification", F.col("replaced_text_layer").isNotNull().alias("kept_layer"))


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey").cast("int")
    prose = F.lit("Ketentuan ini berlaku bagi setiap orang dan badan.")
    layer = F.when(s % 5 == 0, " ").when(s % 5 == 1, F.concat(prose, F.repeat(F.lit("一"), 9))).when(s % 5 == 2, F.lit(None).cast("string")).otherwise(prose)
    rows = _read(spark, d, "supplier").select(F.concat(F.lit("D_"), s % 3).alias("doc_id"), s.alias("page"), layer.alias("text"))
    return layout.extracted_pages(rows, rows.where(F.col("page") % 5 < 2).select("doc_id", "page", prose.alias("text")))


@query(f"""WITH p AS (SELECT s % 3 AS k, {_LAYER} AS method FROM (SELECT CAST(s_suppkey AS INT) AS s FROM supplier))
    SELECT concat('D_', k) AS doc_id, count(*) AS n_pages, count(*) FILTER (method = 'ocr') AS ocr, count(*) FILTER (method = 'ocr_failed') AS ocr_failed, count(*) FILTER (method = 'text_layer') AS text_layer FROM p GROUP BY 1""")
def page_tallies(spark: SparkSession, d: str) -> DataFrame:
    """Pages of each document by how they were read."""
    got = layout.page_tallies(_extracted(spark, d))
    return got.select("doc_id", "n_pages", *(F.coalesce(F.try_element_at("methods", F.lit(m)), F.lit(0)).cast("bigint").alias(m) for m in ("ocr", "ocr_failed", "text_layer")))


@query("""WITH p AS (SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'UU_' WHEN 1 THEN 'Perwal ' ELSE 'Perda ' END, p_name, '#', p_size) AS n FROM part)
    SELECT n AS name, regexp_replace(n, '[^A-Za-z0-9]', '_', 'g') AS slug, CASE WHEN starts_with(n, 'UU_') THEN 'national' WHEN starts_with(n, 'Perwal') THEN 'perwal' ELSE 'perda' END AS rank,
    concat(trim(substr(regexp_replace(lower(n), '[^a-z0-9]+', '_', 'g'), 1, 24), '_'), '__pasal_5_ayat_2') AS place FROM p""")
def document_names(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers and ranks by documents' names."""
    k = F.col("p_partkey") % 3
    name = F.concat(F.when(k == 0, "UU_").when(k == 1, "Perwal ").otherwise("Perda "), "p_name", F.lit("#"), "p_size")
    rows = _read(spark, d, "part").select(name.alias("name"))
    n = F.col("name")
    return rows.select("name", text.file_slug(n).alias("slug"), text.instrument_rank(n).alias("rank"), text.citation_slug(n, F.lit("Pasal 5 ayat (2)")).alias("place"))


_CLEAN = "CASE WHEN kind <= 5 THEN concat('Tarif ', ['paling tinggi', 'paling rendah', 'paling lama', 'paling sedikit', 'paling banyak', 'ditetapkan sebesar', 'ditetapkan dengan'][mk + 1], ' ', p, '% (', w, ' persen)'"
_WORD = "['nol', 'satu', 'dua', 'tiga', 'empat', 'lima', 'enam', 'tujuh', 'delapan', 'sembilan', 'sepuluh']"


@query(f"""{_R}, s AS (SELECT *, {_WORD}[p + 1] AS w FROM r) SELECT {_DOC} AS doc_id, CAST(pasal AS INT) AS pasal, CAST(ayat AS INT) AS ayat,
    {_CLEAN}, ' [N1].') WHEN kind = 6 THEN concat('Laporan wajib dikirim dalam ', greatest(p, 1), ' (', {_WORD}[greatest(p, 1) + 1], ') hari kerja [N1].') ELSE 'Ketentuan ini berlaku.' END AS annotated,
    CASE WHEN kind <= 5 AND mk IN (0, 2, 4) THEN '<=' WHEN kind <= 5 AND mk IN (1, 3) THEN '>=' WHEN kind <= 5 AND mk = 5 THEN '==' END AS op FROM s""")
def annotated_slots(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs with their figures numbered, and the comparison that each states."""
    rows = corpus.paragraphs(spark, d, False).withColumn("figures", numerals.figures(F.col("text")))
    at = F.get("figures", F.lit(0))["start"]
    return rows.select("doc_id", "pasal", "ayat", slots.annotate(F.col("text"), F.col("figures")).alias("annotated"), slots.operator_before(F.col("text"), at).alias("op"))


@query(f"""{_R} SELECT concat({_DOC}, '#', pasal, '#', ayat) AS case_id, CASE WHEN kind > 5 THEN 'NOT_FOUND' WHEN ln % 3 = 0 AND p <> 7 THEN 'FAIL' WHEN ln % 3 = 1 THEN 'SMOOTHED' ELSE 'PASS' END AS verdict FROM r""")
def reading_gate(spark: SparkSession, d: str) -> DataFrame:
    """Cases that a reading passes, fails, smooths over or lacks."""
    word = F.element_at(F.array(*map(F.lit, corpus.WORDS)), F.col("p") + 1)
    rate = F.col("kind") <= 5
    rows = corpus.truth(spark, d).select(
        F.concat_ws("#", F.concat(F.lit("PERDA_"), "sup"), "pasal", "ayat").alias("case_id"), F.concat(word, F.lit(" persen")).alias("match_words"), F.lit(None).cast("string").alias("expect_status"),
        F.when(F.col("ln") % 3 == 0, 0.07).otherwise(F.col("p") / 100).alias("expect_value"), F.when(F.col("ln") % 3 == 1, F.col("p") / 100).alias("wrong_value"),
        F.when(rate, F.concat(F.lit("Tarif "), "p", F.lit("% ("), word, F.lit(" persen)."))).otherwise(corpus.NEUTRAL).alias("text"),
    )
    return calibrate.gate(rows).select("case_id", "verdict")


@query(f"""{_R}, a AS (SELECT sup, pasal, string_agg(concat('(', ayat, ') x'), chr(10) ORDER BY ayat) AS t FROM r GROUP BY 1, 2),
    s AS (SELECT sup, pasal, coalesce(sum(length(t) + 1) OVER (PARTITION BY sup ORDER BY pasal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, length(t) AS n FROM a),
    p AS (SELECT sup, pasal AS page, b, b + n AS e FROM s), u AS (SELECT sup, pasal AS unit_no, b + n - 3 AS f, b + n + 4 AS t FROM s)
    SELECT concat('PERDA_', u.sup) AS doc_id, CAST(unit_no AS INT) AS unit_no, string_agg(page, ',' ORDER BY page) AS pages FROM u JOIN p ON p.sup = u.sup AND p.b < u.t AND u.f < p.e GROUP BY 1, 2""")
def unit_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages that a unit across a page break lies on."""
    spans = page_spans(spark, d)
    units = spans.select("doc_id", F.col("page").alias("unit_no"), (F.col("end") - 3).alias("start"), (F.col("end") + 4).alias("end"))
    return layout.pages_of(units, spans, ["doc_id", "unit_no"]).select("doc_id", "unit_no", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


@query("""WITH k AS (SELECT p_type AS t, p_brand AS b, count(*) AS n FROM part GROUP BY 1, 2), c AS (SELECT t, CASE WHEN length(t) % 2 = 0 THEN sum(n) % 11 END AS cap FROM k GROUP BY 1),
    v AS (SELECT CASE WHEN n % 11 <= coalesce(cap, 5) THEN 'COMPLIANT' ELSE 'CONFLICT' END AS verdict FROM k JOIN c USING (t) UNION ALL SELECT 'ABSTAIN' FROM nation)
    SELECT verdict, count(*) AS n FROM v GROUP BY 1""")
def verdict_tally(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts by kind; every open-textured term is one more abstention."""
    return conflict.tally(rate_conflicts(spark, d), _read(spark, d, "nation"))


@query("""SELECT p_partkey AS norm, concat('c', p_size) AS category FROM part WHERE p_size NOT IN (SELECT n_nationkey FROM nation) AND p_size % 10 <> 0""")
def outside_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Categories of rules that no vocabulary holds; the star is always in."""
    applies = _read(spark, d, "part").select(F.col("p_partkey").alias("norm"), F.when(F.col("p_size") % 10 == 0, "*").otherwise(F.concat(F.lit("c"), "p_size")).alias("category"))
    return slots.outside_vocabulary(applies, _read(spark, d, "nation").select(F.concat(F.lit("c"), "n_nationkey").alias("id")))
