"""Document text to addressable units.

Markers are found with their offsets; folds over the ordered markers keep the
ones that number on; everything else is a lead, a rank or an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import let, rows_of
from ..functions.matchers import cut, find_all, find_with_rest, first_start
from ..functions.numerals import GLYPH_FROM, GLYPH_TO
from ..plans.storage import kept
from . import interval, layout

# Headers, markers and limits of the source format.
PASAL = r"(?dm)^[ \t]*Pasal[ \t]+([0-9]+[A-Za-z]?)[ \t]*$"
LAMPIRAN = r"(?dmU)^[ \t]*LAMPIRAN\b"
PENJELASAN = r"(?dmU)^[ \t]*PENJELASAN\b"
HURUF = r"(?dm)^[ \t]*([a-z])[.)][ \t]+"
ANGKA = r"(?dm)^[ \t]*([0-9]+)[.)][ \t]+"
AYAT = r"(?dm)^[ \t]*\(([0-9lIOoSB]{1,3})([)1lI\]}])?[ \t]+"
LOOK_AHEAD, RESTART_DROP = 4000, 10
SECTION_PREFIX = {"body": "", "penjelasan": "Penjelasan ", "lampiran": "Lampiran ", "unlabelled_restart": "[bagian tak berlabel] "}
_INTS = "array<int>"
_ANOMALY = "array<struct<from_num:int,to_num:int,offset:int>>"


def pasal_number(label: Column) -> Column:
    """The number of an article's label, its suffix left off."""
    return F.regexp_extract(label, "^([0-9]+)", 1).try_cast("int")


def repaired_number(label: Column) -> Column:
    """The number with a suffix that stands for a digit, else null."""
    return F.when(label.rlike(r"^[0-9]+[OolISB]\z"), F.translate(label, GLYPH_FROM, GLYPH_TO).try_cast("int"))


def _restart_cuts(text: Column) -> Column:
    """struct(cuts, anomalies): where the article numbers start again, moved up
    to the last section heading before, and where they merely go back."""
    headers = F.transform(find_all(text, PASAL, "label"), lambda m: F.struct(m["start"].alias("start"), pasal_number(m["label"]).alias("number"), repaired_number(m["label"]).alias("repaired")))
    headings = F.transform(F.concat(find_all(text, PENJELASAN), find_all(text, LAMPIRAN)), lambda m: m["start"])

    def fold(known: Column) -> Column:
        zero = F.struct(F.lit(None).cast("int").alias("previous"), F.array(F.lit(0)).cast(_INTS).alias("cuts"), F.array().cast(_ANOMALY).alias("anomalies"))

        def step(acc: Column, h: Column) -> Column:
            number, repaired = h["number"], h["repaired"]
            back = F.coalesce(number < acc["previous"], F.lit(False))
            mended = back & F.coalesce(repaired >= acc["previous"], F.lit(False))
            restart = back & ~mended & ((number <= 2) | (acc["previous"] - number >= RESTART_DROP))
            odd = back & ~mended & ~restart
            above = F.array_max(F.filter(known["headings"], lambda x: x < h["start"]))
            return F.struct(
                F.when(mended, repaired).otherwise(number).alias("previous"),
                F.when(restart, F.concat(acc["cuts"], F.array(F.coalesce(above, h["start"])))).otherwise(acc["cuts"]).alias("cuts"),
                F.when(odd, F.concat(acc["anomalies"], F.array(F.struct(acc["previous"].alias("from_num"), number.alias("to_num"), h["start"].alias("offset"))))).otherwise(acc["anomalies"]).alias("anomalies"),
            )

        folded = F.aggregate(known["headers"], zero, step)
        return F.struct(folded["cuts"].alias("cuts"), folded["anomalies"].alias("anomalies"), known["headings"].alias("headings"), F.size(known["headers"]).alias("headers"))

    # numbers that never go back need no fold, and no offsets
    labels = F.regexp_extract_all(text, F.lit(PASAL), F.lit(1))
    numbers = labels.try_cast(_INTS)
    onward = ~F.coalesce(F.array_contains(numbers, -1), F.lit(True)) & (F.sort_array(numbers) == numbers)
    simple = F.struct(F.array(F.lit(0)).cast(_INTS).alias("cuts"), F.array().cast(_ANOMALY).alias("anomalies"), headings.alias("headings"), F.size(labels).alias("headers"))
    return F.when(onward, simple).otherwise(let(F.struct(headers.alias("headers"), headings.alias("headings")), fold))


def section_label(head: Column, opening: Column) -> Column:
    """The kind of a section by its first ``LOOK_AHEAD`` characters; opening:
    whether it is a document's first."""

    def leads(pattern: str) -> Column:
        at = first_start(head, pattern)
        return F.coalesce(at < F.coalesce(first_start(head, PASAL), F.lit(1 << 30)), F.lit(False))

    first = F.when(leads(PENJELASAN), "penjelasan").when(leads(LAMPIRAN), "lampiran").otherwise("body")
    later = F.when(F.coalesce(first_start(head, LAMPIRAN) == 0, F.lit(False)), "lampiran").when(head.rlike(PENJELASAN), "penjelasan").when(head.rlike(LAMPIRAN), "lampiran").otherwise("unlabelled_restart")
    return F.when(opening, first).otherwise(later)


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, section_no, section, start, end, restart, chunk) of (doc_id, text)."""
    plain = F.col("c.headers") == 0
    whole = F.when(F.col("text").rlike(LAMPIRAN), "lampiran").when(F.col("text").rlike(PENJELASAN), "penjelasan").otherwise("body")
    cuts = F.when(plain, F.array(F.lit(0))).otherwise(F.array_sort(F.array_distinct(F.concat("c.cuts", "c.headings"))))
    split = docs.select("doc_id", "text", _restart_cuts(F.col("text")).alias("c"))
    split = split.withColumn("at", F.filter(cuts, lambda x: (x < F.length("text")) | (x == 0)))

    def part(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("at", i + 1), F.length("text"))
        return F.struct(i.alias("section_no"), start.alias("start"), end.alias("end"), cut(F.col("text"), start, end).alias("chunk"))

    named = split.select("doc_id", plain.alias("plain"), F.when(plain, whole).alias("whole"), F.col("c.cuts").alias("cuts"), F.transform("at", part).alias("parts"))
    each = rows_of(named, F.col("parts"), "doc_id", "plain", "whole", "cuts").select("doc_id", "plain", "whole", "cuts", "m.*")
    label = F.when(F.col("plain"), F.col("whole")).otherwise(section_label(F.substring("chunk", 1, LOOK_AHEAD), F.col("section_no") == 0))
    restart = ~F.col("plain") & (F.col("section_no") > 0) & F.array_contains("cuts", F.col("start"))
    return each.select("doc_id", "section_no", label.alias("section"), "start", "end", restart.alias("restart"), "chunk")


def section_anomalies(docs: DataFrame) -> DataFrame:
    """(doc_id, warning, from_num, to_num, offset): article numbers that go back."""
    found = rows_of(docs, _restart_cuts(F.col("text"))["anomalies"], "doc_id").select("doc_id", "m.*")
    return found.select("doc_id", F.lit("pasal_numbering_goes_backwards").alias("warning"), "from_num", "to_num", "offset")


def section_prefix(section: Column) -> Column:
    """What a citation of the section starts with."""
    known = F.create_map(*(F.lit(x) for pair in SECTION_PREFIX.items() for x in pair))
    return F.coalesce(F.try_element_at(known, section), F.concat(F.lit("["), section, F.lit("] ")))


def pasals(docs: DataFrame) -> DataFrame:
    """(doc_id, section, pasal, occurrence, citation, start, end, text): the
    articles of every section, numbered where a label comes again."""
    found = find_with_rest(F.col("chunk"), PASAL, "pasal")
    bodies = F.transform(found, lambda m: F.struct(m["pasal"].alias("pasal"), m["end"].alias("from"), (m["end"] + F.length(m["rest"])).alias("to"), m["rest"].alias("text")))
    each = rows_of(sections(docs), bodies, "doc_id", "section", "start").select("doc_id", "section", F.col("start").alias("base"), "m.*")
    rows = each.select("doc_id", "section", "pasal", (F.col("base") + F.col("from")).alias("start"), (F.col("base") + F.col("to")).alias("end"), "text")
    return cited(rows)


def cited(rows: DataFrame) -> DataFrame:
    """Articles (doc_id, section, pasal, start, end, text) with what they are
    cited by: occurrence and citation."""
    again = F.row_number().over(Window.partitionBy("doc_id", "section", "pasal").orderBy("start"))
    cite = F.concat(section_prefix(F.col("section")), F.lit("Pasal "), F.col("pasal"), F.when(F.col("occurrence") > 1, F.concat(F.lit(" #"), F.col("occurrence"))).otherwise(""))
    return rows.withColumn("occurrence", again).withColumn("citation", cite).select("doc_id", "section", "pasal", "occurrence", "citation", "start", "end", "text")


_MARK = "array<struct<at:int,from:int,label:string>>"


def _chains(places: Column, breaks) -> Column:
    """array<struct<at,size>>: stretches of ``0 .. n-1`` that begin where
    ``breaks`` says so; the whole is walked once."""
    starts = F.filter(places, breaks)
    return let(starts, lambda b: F.transform(b, lambda x, k: F.struct(x.alias("at"), (F.coalesce(F.get(b, k + 1), F.size(places)) - x).alias("size"))))


def _places(marks: Column) -> Column:
    return F.when(F.size(marks) > 0, F.sequence(F.lit(0), F.size(marks) - 1)).otherwise(F.array().cast(_INTS))


def _runs(marks: Column, first: str, following) -> Column:
    """Marks in runs that open at ``first`` and go on by one; a mark that does
    neither ends a run.  Labels are compared as text.

    Runs are islands between the marks that don't follow the one before them; an
    island counts if it opens at ``first``.
    """

    def of(known: Column) -> Column:
        # most texts have no marks at all
        return F.when(F.size(known) == 0, known).otherwise(islands_of(known))

    def islands_of(known: Column) -> Column:
        label = lambda i: F.get(known, i)["label"]
        opens = lambda i: (label(i) == first) | ~F.coalesce(label(i) == following(label(i - 1)), F.lit(False))
        islands = F.filter(_chains(_places(known), opens), lambda c: label(c["at"]) == first)
        return F.flatten(F.transform(islands, lambda c: F.slice(known, c["at"] + 1, c["size"])))

    return let(marks, of)


def _plain_marks(text: Column, pattern: str) -> Column:
    return F.transform(find_all(text, pattern, "label"), lambda m: F.struct(m["start"].alias("at"), m["end"].alias("from"), m["label"].alias("label")))


def _where_any(text: Column, pattern: str, marks: Column) -> Column:
    # lambdas are interpreted: a text without a mark gets to none
    return F.when(text.rlike(pattern), marks).when(text.isNotNull(), F.array().cast(_MARK))


def huruf_marks(text: Column) -> Column:
    """Letter items a, b, c ... of a text."""
    return _where_any(text, HURUF, _runs(_plain_marks(text, HURUF), "a", lambda x: F.char(F.ascii(x) + 1)))


def angka_marks(text: Column) -> Column:
    """Number items 1, 2, 3 ... of a text."""
    return _where_any(text, ANGKA, _runs(_plain_marks(text, ANGKA), "1", lambda x: (x.try_cast("bigint") + 1).cast("string")))


def ayat_marks(text: Column, found: Column | None = None) -> Column:
    """Paragraphs (1), (2), (3) ... of a text, damaged numbers included.

    A number whose closing bracket is lost may end in that bracket.  A run of
    one counts only if it needed no repair.  found: all that ``AYAT`` matches, if
    a column has it.
    """

    def reading(m: Column) -> Column:
        body, closer = m["body"], m["closer"]
        digits = F.translate(body, GLYPH_FROM, GLYPH_TO)
        less = F.when((closer == "") & (F.length(digits) > 1), F.substring(digits, F.lit(1), F.length(digits) - 1)).try_cast("int")
        return F.struct(m["start"].alias("at"), m["end"].alias("from"), digits.try_cast("int").alias("one"), less.alias("two"), (digits == body).alias("literal"))

    def of(known: Column) -> Column:
        # Marks that read 1, 2, 3 ... throughout are one run, in which any other begins.
        labelled = F.transform(known, lambda m, k: F.struct(m["at"].alias("at"), m["from"].alias("from"), (k + 1).cast("string").alias("label")))
        plain = F.forall(F.transform(known, lambda m, k: m["one"].eqNullSafe(k + 1)), lambda x: x)
        whole = plain & ((F.size(known) > 1) | F.coalesce(F.get(known, F.lit(0))["literal"], F.lit(True)))
        return F.when(whole, labelled).otherwise(islands_of(known))

    def islands_of(known: Column) -> Column:
        # Where the run would have opened in which a mark has one of its readings:
        # marks of one run are islands of successive places with the same opening.
        opening = lambda i, v: F.when(v >= 1, (i - v.cast("long") + 1) * (1 << 32) + i)
        read = lambda i: F.array(opening(i, F.get(known, i)["one"]), opening(i, F.get(known, i)["two"]))
        return let(F.sort_array(F.array_distinct(F.array_compact(F.flatten(F.transform(_places(known), read))))), lambda p: chains(known, p))

    def chains(known: Column, pairs: Column) -> Column:
        start, place = lambda p: F.shiftright(p, 32), lambda p: p.bitwiseAND(F.lit((1 << 32) - 1))
        breaks = lambda i: F.coalesce(F.get(pairs, i) - F.get(pairs, i - 1) != 1, F.lit(True))
        islands = F.filter(_chains(_places(pairs), breaks), lambda c: start(F.get(pairs, c["at"])) == place(F.get(pairs, c["at"])))
        runs = F.transform(islands, lambda c: F.struct(start(F.get(pairs, c["at"])).cast("int").alias("at"), c["size"].alias("size")))
        return let(runs, lambda r: lasting(known, r))

    def lasting(known: Column, runs: Column) -> Column:
        # a mark that could open a run but goes on in an earlier one opens none: at most every tenth can
        code = lambda r: r["at"].cast("long") * (1 << 32) + r["size"]
        zero = F.struct(F.lit(0).alias("until"), F.array().cast("array<long>").alias("inside"))
        within = lambda acc, r: F.struct(acc["until"].alias("until"), F.array_append(acc["inside"], code(r)).alias("inside"))
        after = lambda acc, r: F.struct((r["at"] + r["size"]).alias("until"), acc["inside"].alias("inside"))
        inside = F.aggregate(runs, zero, lambda acc, r: F.when(r["at"] < acc["until"], within(acc, r)).otherwise(after(acc, r)))["inside"]
        good = F.filter(runs, lambda r: (r["size"] > 1) | F.get(known, r["at"])["literal"])
        at, size = lambda r: F.shiftright(r, 32).cast("int"), lambda r: r.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        marks = lambda r: F.transform(F.slice(known, at(r) + 1, size(r)), lambda m, k: F.struct(m["at"].alias("at"), m["from"].alias("from"), (k + 1).cast("string").alias("label")))
        return F.flatten(F.transform(F.array_except(F.transform(good, code), inside), marks))

    # most articles have one paragraph, whose number needs no repair: no lambda for these
    all_marks = F.regexp_extract_all(text, F.lit(AYAT), F.lit(0)) if found is None else found
    mark = F.get(all_marks, F.lit(0))
    one = (F.size(all_marks) == 1) & (F.regexp_extract(mark, AYAT, 1) == "1")
    # it mostly is the first line, which saves a split by a pattern that is compiled for every text
    at = F.when(text.startswith(F.concat(F.lit("\n"), mark)), 1).otherwise(F.length(F.split(text, AYAT, 2)[0]))
    single = F.array(F.struct(at.alias("at"), (at + F.length(mark)).alias("from"), F.lit("1").alias("label")))
    several = let(F.transform(find_all(text, AYAT, "body", "closer"), reading), of)
    return F.when(F.size(all_marks) == 0, F.array().cast(_MARK)).when(one, single).when(text.isNotNull(), several)


_UNIT = ("level", "label", "citation", "parent", "parent_start", "start", "end", "text", "leaf", "scan")


def _descend(rows: DataFrame, level: str, form: str, marks) -> DataFrame:
    """``rows``, each followed by the units of one level inside it.

    ``scan`` marks what may still hold a list: a unit in which one is found
    hands the mark on to the items.
    """
    rows = rows.withColumn("found", F.when(F.col("scan"), marks(F.col("text"))).otherwise(F.array().cast(_MARK)))
    none, (before, after) = F.size("found") == 0, form.split("%s")
    own = F.struct(*((F.col(c) & none).alias(c) if c in ("leaf", "scan") else F.col(c) for c in _UNIT))

    def item(m: Column, end: Column) -> Column:
        fields = (F.lit(level), m["label"], F.concat("citation", F.lit(before), m["label"], F.lit(after)), F.col("citation"), F.col("start"), F.col("start") + m["from"], F.col("start") + end, cut(F.col("text"), m["from"], end), F.lit(True), F.lit(True))
        return F.struct(*(v.alias(k) for k, v in zip(_UNIT, fields, strict=True)))

    key = ("doc_id", "section", "pasal", "occurrence")
    first = item(F.get("found", F.lit(0)), F.length("text"))
    several = F.concat(F.array(own), F.transform("found", lambda m, i: item(m, F.coalesce(F.get("found", i + 1)["at"], F.length("text")))))
    every = F.when(none, F.array(own)).when(F.size("found") == 1, F.array(own, first)).otherwise(several)
    return rows_of(rows, every, *key).select(*key, "m.*")


def units(docs: DataFrame) -> DataFrame:
    """All units of all levels, flat: (doc_id, section, pasal, occurrence,
    level, label, citation, parent, parent_start, start, end, text, leaf).

    Levels exclude each other: letters stand under an article only without
    paragraphs, numbers only where there are neither.  One pass over each
    article's text, level by level.
    """
    return units_of(pasals(docs))


def units_of(articles: DataFrame) -> DataFrame:
    """``units`` of articles that are found already."""
    null = F.lit(None)
    top = articles.select("doc_id", "section", "pasal", "occurrence", F.lit("pasal").alias("level"), F.col("pasal").alias("label"), "citation", null.cast("string").alias("parent"), null.cast("int").alias("parent_start"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "text", F.lit(True).alias("leaf"), F.lit(True).alias("scan"))
    top = top.withColumn("ayat_found", F.regexp_extract_all("text", F.lit(AYAT), F.lit(0)))
    out = _descend(top, "ayat", " ayat (%s)", lambda text: ayat_marks(text, F.col("ayat_found")))
    out = _descend(out, "huruf", " huruf %s", huruf_marks)
    return _descend(out, "angka", " angka %s", angka_marks).drop("scan")


def leaves(all_units: DataFrame) -> DataFrame:
    """Units that hold no smaller unit."""
    return all_units.where("leaf")


def level_counts(all_units: DataFrame) -> DataFrame:
    """(doc_id, pasal, ayat, huruf, angka, units): how many of each, and leaves."""
    n = [F.count_if(F.col("level") == x).alias(x) for x in ("pasal", "ayat", "huruf", "angka")]
    return all_units.groupBy("doc_id").agg(*n, F.count_if("leaf").alias("units"))


def unit_warnings(all_units: DataFrame) -> DataFrame:
    """(doc_id, warning, citation, section, pasal, occurrence): articles that
    come again, and containers in which a list opens twice."""
    again = all_units.where((F.col("level") == "pasal") & (F.col("occurrence") > 1)).select("doc_id", F.lit("duplicate_pasal_in_section").alias("warning"), F.lit(None).cast("string").alias("citation"), "section", "pasal", "occurrence")
    opens = ((F.col("level") == "huruf") & (F.col("label") == "a")) | ((F.col("level") == "angka") & (F.col("label") == "1") & F.col("parent").rlike(r"ayat \([0-9]+\)\z"))
    own = F.when(F.col("parent").rlike(r"ayat \([0-9]+\)\z"), "ayat").otherwise("pasal")
    twice = all_units.where(opens).groupBy("doc_id", "parent", "parent_start", "level").agg(F.count("*").alias("n"), F.first(own).alias("own")).where("n > 1")
    runs = twice.select("doc_id", F.concat(F.lit("multiple_"), "level", F.lit("_runs_in_"), "own").alias("warning"), F.col("parent").alias("citation"), F.lit(None).cast("string").alias("section"), F.lit(None).cast("string").alias("pasal"), F.lit(None).cast("int").alias("occurrence"))
    return again.unionByName(runs)


def unit_index(all_units: DataFrame) -> DataFrame:
    """One row for each citation of an article: of those that collide, the last."""
    last = Window.partitionBy("doc_id", "section", "pasal", "occurrence", "citation").orderBy(F.col("start").desc())
    return all_units.withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn")


def segment_pages(pages: DataFrame) -> DataFrame:
    """The units of documents given as pages, each with the pages that it lies
    on and the methods these were read by.  pages: doc_id, page, method, text."""
    # what several branches need is worked out once: stripped pages, and units
    methods = F.collect_set("method").over(Window.partitionBy("doc_id", "page"))
    read = pages.withColumn("methods", F.when(F.col("page").isNotNull(), methods))
    clean = kept(layout.strip_furniture(read, "methods").select("doc_id", "page", "text", "methods"))
    whole = units(layout.join_pages(clean))
    numbered = kept(whole.withColumn("unit_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("start", F.length("citation"), "citation"))))
    spans = layout.page_spans(clean, "methods")
    hit = interval.overlaps(numbered.select("doc_id", "unit_no", "start", "end"), spans, ["doc_id"])
    methods = F.array_sort(F.array_distinct(F.flatten(F.collect_list("r.methods"))))
    found = hit.groupBy("doc_id", F.col("l.unit_no").alias("unit_no")).agg(F.array_sort(F.collect_set("r.page")).alias("pages"), methods.alias("methods"))
    return numbered.join(found, ["doc_id", "unit_no"], "left")
