"""Category taxonomies from enumerated provisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import let
from ..functions.matchers import cut
from ..functions.text import canonical, citation_slug, instrument_rank, slug, term_like, words

# Patterns and limits of the source language.
OPENERS = r"(?iuU)\b(meliputi|terdiri\s+atas|terdiri\s+dari|mencakup|adalah|yaitu)\s*:?\s*$"
EXCLUSION = r"(?iuU)\b(dikecualikan|tidak\s+termasuk|bukan\s+merupakan|tidak\s+dikenakan)\b"
TAXABLE = r"(?iuU)\b(objek\s+(pajak|retribusi|pbjt|bphtb)|jenis\s+(pajak|retribusi)|^jasa\b|^pajak\b|merupakan\s+objek|dasar\s+pengenaan)\b"
CROSSREF = r"(?iuU)\s+(sebagaimana\s+dimaksud|yang\s+dipungut|yang\s+selanjutnya|dalam\s+Pasal)\b"
OPEN_TEXTURED = r"(?iuU)\bdan\s+(sejenisnya|lain-lain|lainnya)\b"
SUBORDINATOR = r"(?iuU)\b(yang|dengan|untuk|dalam|secara|atas|dari|pada|lainnya|sejenisnya|berdasarkan|melalui|terhadap)\b"
SPLIT_ON = r"(?iuU)\s*,\s*|\s+dan/atau\s+|\s+dan\s+|\s+atau\s+"
LEADING_CONJUNCTION = r"(?iuU)^(dan/atau|dan|atau)\s+"
TRAILING_CONJUNCTION = r"(?iuU)[;,]?\s*(dan|atau|dan/atau)\s*$"
HEADING = r"(?U)\s*\b(BAB|Bagian|Paragraf|Pasal)\b\s+[A-Z0-9].*"
MEMBER_WORDS, LABEL_WORDS, SUBJECT_WORDS, NOTE_CHARS = 4, 40, 12, 110


def _rstrip(c: Column, chars: str) -> Column:
    return F.rtrim(c, F.lit(chars))


def chapeau(text: Column, first_child: Column) -> Column:
    """A container's text up to its first item, without the item's marker."""
    return F.regexp_replace(canonical(cut(text, F.lit(0), first_child)), r"(?U)\s*[a-zA-Z0-9]{1,3}[.)]\s*$", "")


def subject(chap: Column) -> Column:
    """The term that a list spells out, null if none is left."""
    head = F.btrim(F.regexp_replace(chap, OPENERS, ""))
    head = F.btrim(F.split(head, CROSSREF, 2)[0])
    head = F.btrim(F.regexp_replace(head, r"(?U)^\(\d+\)\s*", ""), F.lit(" ,.:;"))
    return F.nullif(head, F.lit(""))


def trim_label(text: Column) -> Column:
    """struct(label, bled): an item's label, cut where a heading ran into it."""

    def of(label: Column) -> Column:
        bled = label.rlike(HEADING)
        short = F.when(bled, _rstrip(F.regexp_replace(label, f"(?s){HEADING}", ""), " .;,:")).otherwise(label)
        return F.struct(F.btrim(F.regexp_replace(short, TRAILING_CONJUNCTION, "")).alias("label"), bled.alias("bled"))

    return let(_rstrip(canonical(text), ".;"), of)


def split_services(text: Column) -> Column:
    """struct(members, reason): the members of a flat list, or why it is none."""

    def of(body: Column) -> Column:
        parts = F.transform(F.split(body, SPLIT_ON), lambda m: F.btrim(F.regexp_replace(m, LEADING_CONJUNCTION, ""), F.lit(" .;,")))

        def verdict(members: Column) -> Column:
            long = F.exists(members, lambda m: F.size(words(m)) > MEMBER_WORDS)
            reason = F.when(body == "", "empty").when(body.rlike(SUBORDINATOR), "qualified_by_subordinate_clause").when(F.size(members) < 2, "single_member").when(long, "member_too_long_to_be_a_bare_term")
            return F.struct(F.when(reason.isNull(), members).alias("members"), reason.alias("reason"))

        return let(F.filter(parts, lambda m: m != ""), verdict)

    return let(F.btrim(F.regexp_replace(_rstrip(canonical(text), ".;"), TRAILING_CONJUNCTION, "")), of)


def distributive_head(members: Column) -> Column:
    """The first word, if the first of three or more members may lend it to the rest."""
    first = words(members[0])
    shorter = F.forall(F.slice(members, F.lit(2), F.greatest(F.size(members), F.lit(1))), lambda m: F.size(words(m)) < F.size(first))
    return F.when((F.size(members) >= 3) & (F.size(first) >= 2) & shorter, first[0])


def containers(units: DataFrame) -> DataFrame:
    """Units of the operative part that own a list: (doc_id, citation, start, text,
    first_child, level)."""
    kids = units.where(F.col("parent").isNotNull() & (F.col("level") != "ayat")).groupBy("doc_id", F.col("parent").alias("citation"), F.col("parent_start").alias("start")).agg(F.min("start").alias("kid"))
    return units.where(F.col("section") == "body").join(kids, ["doc_id", "citation", "start"]).select("doc_id", "citation", "start", "text", (F.col("kid") - F.col("start")).alias("first_child"), "level")


def harvest(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categories and coverage notes of all documents' units.

    Exclusion lists are noted before an opener is asked for; a list without
    one is passed over; its subject is a category, and so are its items and,
    where an item is a flat list itself, the members of that.
    """
    chap = chapeau(F.col("text"), F.col("first_child"))
    lists = containers(units).withColumn("chap", chap).withColumn("subject", subject(F.col("chap")))
    excluded, opened = F.col("chap").rlike(EXCLUSION), F.col("chap").rlike(OPENERS)
    named = F.col("subject").isNotNull() & (F.size(words(F.col("subject"))) <= SUBJECT_WORDS)
    tail = F.substring(F.col("chap"), F.greatest(F.length("chap") - NOTE_CHARS + 1, F.lit(1)), F.lit(NOTE_CHARS))

    def note(rows: DataFrame, test: Column, reason: Column, text: Column, cite: str = "citation") -> DataFrame:
        return rows.where(test).select("doc_id", F.col(cite).alias("citation"), reason.alias("reason"), text.alias("chapeau"))

    good = lists.where(~excluded & opened & named).select("doc_id", F.col("citation").alias("owner"), F.col("start").alias("owner_start"), "subject", slug(F.col("subject")).alias("subject_id"), F.col("subject").rlike(TAXABLE).alias("taxable_subject"))
    subjects = good.select(F.col("subject_id").alias("id"), F.col("subject").alias("label"), F.lit(None).cast("string").alias("parent"), F.col("owner").alias("origin_citation"), "doc_id", F.lit("subject").alias("level"), "taxable_subject", F.lit(False).alias("open_textured"), F.lit(None).cast("string").alias("head"))
    items = units.where(F.col("level") != "ayat").select("doc_id", F.col("parent").alias("owner"), F.col("parent_start").alias("owner_start"), "citation", trim_label(F.col("text")).alias("t"))
    items = good.join(items, ["doc_id", "owner", "owner_start"]).select("*", "t.label", "t.bled").withColumn("s", split_services(F.col("label"))).select("*", "s.members", "s.reason")
    long = F.size(words(F.col("label"))) > LABEL_WORDS
    own = F.when(F.col("members").isNotNull() | ~term_like(F.col("label")), citation_slug(F.col("doc_id"), F.col("citation"))).otherwise(slug(F.col("label")))
    kept = items.where(~long).withColumn("item_id", own).where("item_id <> ''").withColumn("head", distributive_head(F.col("members")))
    huruf = kept.select(F.col("item_id").alias("id"), "label", F.col("subject_id").alias("parent"), F.col("citation").alias("origin_citation"), "doc_id", F.lit("huruf").alias("level"), "taxable_subject", F.col("label").rlike(OPEN_TEXTURED).alias("open_textured"), F.lit(None).cast("string").alias("head"))
    service = kept.where(F.col("members").isNotNull()).select("*", F.explode("members").alias("member")).select(slug(F.col("member")).alias("id"), F.col("member").alias("label"), F.col("item_id").alias("parent"), F.col("citation").alias("origin_citation"), "doc_id", F.lit("service").alias("level"), "taxable_subject", F.lit(False).alias("open_textured"), "head")
    cats = subjects.unionByName(huruf).unionByName(service).withColumn("rank", instrument_rank(F.col("doc_id")))
    short = F.substring("label", 1, NOTE_CHARS)
    notes = note(lists, excluded, F.lit("exclusion_list_not_a_category"), tail)
    notes = notes.unionByName(note(lists, ~excluded & opened & ~named, F.lit("subject_not_identifiable"), tail))
    notes = notes.unionByName(note(items, F.col("bled"), F.lit("heading_bled_into_huruf"), short))
    notes = notes.unionByName(note(items, long, F.lit("label_implausibly_long_segmentation_suspect"), short))
    notes = notes.unionByName(note(kept, F.col("head").isNotNull(), F.lit("distributive_head_suspected"), F.concat(F.lit("head "), "head")))
    notes = notes.unionByName(note(kept, F.col("members").isNull(), F.concat(F.lit("huruf_not_split:"), "reason"), short))
    return cats, notes


def note_reasons(notes: DataFrame) -> DataFrame:
    """(reason, n) by what stands before a colon, most frequent first."""
    return notes.groupBy(F.substring_index("reason", ":", 1).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def alignments(live: DataFrame, local: DataFrame) -> DataFrame:
    """Local labels that equal a statutory label, or start with one at a word's end.

    live, local: ord, id, label, doc_id, origin_citation, taxable_subject.  A
    proposal, never a merge.  The prefix test is an equi-join: a local label is
    exploded into its own word-end prefixes, so no pair is tried in vain.
    """
    statute = live.where("taxable_subject").groupBy(F.lower("label").alias("term")).agg(F.min_by(F.struct(F.col("id").alias("statutory_id"), F.col("origin_citation").alias("statutory_origin"), "ord"), "ord").alias("s"))
    mine = local.where("taxable_subject").withColumn("lab", F.lower("label"))
    ends = F.filter(F.sequence(F.lit(1), F.length("lab")), lambda i: ~(F.substring(F.col("lab"), i, F.lit(1)).rlike(r"(?U)\w") & F.substring(F.col("lab"), i + 1, F.lit(1)).rlike(r"(?U)\w")) & (F.substring(F.col("lab"), i, F.lit(1)).rlike(r"(?U)\w") | F.substring(F.col("lab"), i + 1, F.lit(1)).rlike(r"(?U)\w")))
    starts = F.transform(F.array_union(ends.cast("array<int>"), F.array(F.length("lab"))), lambda i: F.substring(F.col("lab"), F.lit(1), i))
    each = mine.where(F.length("lab") > 0).select("*", F.explode(F.array_distinct(starts)).alias("term")).join(statute, "term")
    equal = F.col("term") == F.col("lab")
    fits = each.where(equal | (F.length("term") >= 3)).withColumn("proposed_relation", F.when(equal, "same_as").otherwise("subclass_of"))
    first = Window.partitionBy("ord").orderBy(F.when(F.col("proposed_relation") == "same_as", 0).otherwise(1), "s.ord")
    kept = fits.withColumn("rn", F.row_number().over(first)).where("rn = 1")
    basis = F.when(F.col("proposed_relation") == "same_as", "label matches a statutory label exactly").otherwise(F.concat(F.lit("label extends the statutory term "), "term"))
    return kept.select(F.col("id").alias("local_id"), F.col("label").alias("local_label"), "doc_id", "origin_citation", "proposed_relation", "s.statutory_id", "s.statutory_origin", basis.alias("basis"))


def compare(found: DataFrame, gold: DataFrame) -> DataFrame:
    """(id, verdict) of two category tables (id, label): matched by id, renamed
    (by label), missed or extra."""
    f, g = found.select("id", F.lower(canonical(F.col("label"))).alias("lab")).distinct(), gold.select("id", F.lower(canonical(F.col("label"))).alias("lab")).distinct()
    matched = g.join(f.select("id"), "id", "left_semi").select("id", F.lit("matched").alias("verdict"))
    rest = g.join(f.select("id"), "id", "left_anti")
    renamed = rest.join(f.select("lab").distinct(), "lab", "left_semi").select("id", F.lit("renamed").alias("verdict"))
    missed = rest.join(f.select("lab").distinct(), "lab", "left_anti").select("id", F.lit("missed").alias("verdict"))
    extra = f.join(g.select("id"), "id", "left_anti").select("id", F.lit("extra").alias("verdict")).distinct()
    return matched.unionByName(renamed).unionByName(missed).unionByName(extra)
