"""Segmentation of documents that are rows of pages from end to end.

No document is put together.  Markers are found page by page; the numbering of
articles, which decides where a document starts again, is a function that each
page composes onto those before it: summaries of pages are composed by chunk, the
chunks by document, and the states that result are handed back down.  What lies
before or after a marker comes from windows over chunks of offsets, and only the
text of one article, or the head of one section, is assembled from the pages that
it covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import let, rows_of
from ..functions.matchers import cut, find_all
from ..plans.storage import kept, portioned
from . import interval, segment
from .segment import LAMPIRAN, LOOK_AHEAD, PASAL, PENJELASAN, RESTART_DROP

#: Pages whose summaries are composed in one row, and offsets in one window.
CHUNK_PAGES, CHUNK_OFFSETS = 512, 1 << 20


_HEADERS = "array<struct<start:int,end:int,label:string,number:int,repaired:int>>"


def _last(array: str) -> Column:
    return F.get(array, F.size(array) - 1)


def _before(*by: str) -> WindowSpec:
    return Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)


def _earlier(column: str, *by: str) -> Column:
    return F.last(column, ignorenulls=True).over(_before(*by))


def _marked(pages: DataFrame) -> DataFrame:
    """Each page with its markers, by offsets of the page, and what the pages of
    its chunk before it hand on, by offsets of the chunk.

    within: where it starts; heading, point, number: the last heading, the last
    heading or header, and the number after the last header; n and ``last_*``:
    its own.  A number is unknown after a header that a repair could change.
    """
    text = F.col("text")
    found = pages.select("doc_id", "page", F.coalesce("text", F.lit("")).alias("text")).withColumn("chunk", F.floor(F.col("page") / CHUNK_PAGES))
    headers = F.transform(find_all(text, PASAL, "label"), lambda m: F.struct(m["start"], m["end"], m["label"], segment.pasal_number(m["label"]), segment.repaired_number(m["label"])))
    headings = F.concat(find_all(text, PENJELASAN), find_all(text, LAMPIRAN))
    headings = F.when(F.size(headings) > 0, F.array_sort(F.transform(headings, lambda m: m["start"]))).otherwise(F.array().cast("array<int>"))
    found = found.withColumns({"n": (F.length("text") + 1).cast("long"), "headers": headers.cast(_HEADERS), "headings": headings})
    found = found.withColumn("within", F.coalesce(F.sum("n").over(_before("doc_id", "chunk", "page")), F.lit(0)))
    head, heading = _last("headers"), _last("headings")
    at = F.greatest(head["start"], heading)
    found = found.withColumns({
        "last_heading": F.col("within") + heading,
        "last_point": F.when(at.isNotNull(), F.struct((F.col("within") + at).alias("at"), head["start"].eqNullSafe(at).alias("header"))),
        "last_number": F.when(head.isNotNull() & head["repaired"].isNull(), F.struct(head["number"].alias("number"))),
    })
    return found.withColumns({name: _earlier(f"last_{name}", "doc_id", "chunk", "page") for name in ("heading", "point", "number")})


def _chunks(marked: DataFrame) -> DataFrame:
    """(doc_id, chunk, start, length, some, above_heading, above_point,
    above_number): where each chunk starts, the document's length, whether it has
    a header, and what the chunks before hand on."""
    top = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("page"))).alias(c)
    own = marked.groupBy("doc_id", "chunk").agg(F.sum("n").alias("n"), F.bool_or(F.size("headers") > 0).alias("any"), top("last_heading"), top("last_point"), top("last_number"))
    whole = Window.partitionBy("doc_id")
    own = own.withColumns({"start": F.coalesce(F.sum("n").over(_before("doc_id", "chunk")), F.lit(0)), "length": F.sum("n").over(whole) - 1, "some": F.bool_or("any").over(whole)})
    own = own.withColumns({"last_heading": F.col("start") + F.col("last_heading"), "last_point": _moved("last_point")})
    return own.select("doc_id", "chunk", "start", "length", "some", *(_earlier(f"last_{x}", "doc_id", "chunk").alias(f"above_{x}") for x in ("heading", "point", "number")))


def _moved(point: str) -> Column:
    return F.when(F.col(point).isNotNull(), F.struct((F.col("start") + F.col(f"{point}.at")).alias("at"), F.col(f"{point}.header").alias("header")))


def placed(marked: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, page, text, base, heads, headings, heading, point): each page with
    where it starts in the joined text, its markers by offsets of the page, and
    the last heading, and marker, of the document before it.

    heads (start, end, label, previous, number, restart, odd): restart: the
    numbers start again there; odd: they go back.
    """
    # after a header that needs no repair the number is known; only documents with others are followed through
    unknown = F.col("last_point").isNotNull() & F.col("last_number").isNull() & (F.size("headers") > 0)
    followed = kept(marked.where(unknown).select("doc_id").distinct())
    exact = kept(numbered(marked.join(followed, "doc_id", "left_semi"))).withColumn("known", F.lit(True))
    rows = marked.join(chunks, ["doc_id", "chunk"]).join(exact, ["doc_id", "page"], "left")
    before = F.when(F.col("known"), F.col("before")).otherwise(F.coalesce("number", "above_number")["number"])
    rows = rows.select(
        "doc_id", "page", "text", "headers", "headings", (F.col("start") + F.col("within")).alias("base"), before.alias("before"),
        F.coalesce(F.col("start") + F.col("heading"), "above_heading").alias("heading"), F.coalesce(_moved("point"), "above_point").alias("point"),
    )

    def head(h: Column, previous: Column) -> Column:
        number = h["number"]
        back = F.coalesce((number < previous) & ~F.coalesce(h["repaired"] >= previous, F.lit(False)), F.lit(False))
        again = (number <= 2) | (previous - number >= RESTART_DROP)
        return F.struct(h["start"].alias("start"), h["end"].alias("end"), h["label"].alias("label"), previous.alias("previous"), number.alias("number"), (back & again).alias("restart"), (back & ~again).alias("odd"))

    state = F.aggregate("headers", F.array("before"), lambda acc, h: F.array_append(acc, _next(F.element_at(acc, -1), h["number"], h["repaired"])))
    several = let(state, lambda s: F.transform("headers", lambda h, i: head(h, F.get(s, i))))
    one = F.array(head(F.get("headers", F.lit(0)), F.col("before")))
    heads = F.when(F.size("headers") == 1, one).when(F.size("headers") > 1, several).otherwise(F.slice(one, 1, 0))
    return rows.withColumn("heads", heads).drop("headers", "before")


def _next(previous: Column, number: Column, repaired: Column) -> Column:
    """The number that counts as the last one after a header."""
    return F.when(F.coalesce((number < previous) & (repaired >= previous), F.lit(False)), repaired).otherwise(number)


def _applied(f: Column, x: Column) -> Column:
    """A page's summary applied to the number before it: ``mended`` if its first
    header reads as going on only when repaired, else ``plain``."""
    return F.when(F.coalesce((f["number"] < x) & (f["repaired"] >= x), F.lit(False)), f["mended"]).otherwise(f["plain"])


_SUMMARY = "struct<number:int,repaired:int,mended:int,plain:int>"


def _composed(summaries: Column) -> Column:
    """One summary of a list of them, in order: the composition of such functions
    is one of the same form, and it doesn't matter how they are bracketed."""

    def step(acc: Column, f: Column) -> Column:
        after = F.struct(acc["number"].alias("number"), acc["repaired"].alias("repaired"), _applied(f, acc["mended"]).alias("mended"), _applied(f, acc["plain"]).alias("plain"))
        return F.when(acc.isNull(), f).otherwise(after)

    return F.aggregate(summaries, F.lit(None).cast(_SUMMARY), step)


def _entries(summaries: Column, first: Column) -> Column:
    """The number before each summary of a short list, and after the last."""
    zero = F.array(first.cast("int"))
    return F.aggregate(summaries, zero, lambda acc, f: F.array_append(acc, _applied(f, F.element_at(acc, -1))))


def numbered(marked: DataFrame) -> DataFrame:
    """(doc_id, page, before): the number of the last article before each page
    that has a header.

    Summaries of pages are collected by chunk and those of chunks by document, so
    a task sees 512 pages, or one number for each 512 pages of a document.
    """
    tail = F.slice("headers", F.lit(2), F.greatest(F.size("headers") - 1, F.lit(0)))
    folded = lambda x: F.aggregate(tail, x, lambda acc, h: _next(acc, h["number"], h["repaired"]))
    first = F.get("headers", F.lit(0))
    summary = F.struct(first["number"].alias("number"), first["repaired"].alias("repaired"), folded(first["repaired"]).alias("mended"), folded(first["number"]).alias("plain"))
    some = marked.where(F.size("headers") > 0).select("doc_id", "page", F.floor(F.col("page") / CHUNK_PAGES).alias("chunk"), summary.alias("f"))
    chunks = some.groupBy("doc_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("page", "f"))).alias("pages"))
    whole = chunks.select("doc_id", "chunk", _composed(F.transform("pages", lambda p: p["f"])).alias("f"))
    lists = whole.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "f"))).alias("c"))
    # bound by let: a column that only a lambda reads would be put into it, and computed for each element
    entries = let(_entries(F.transform("c", lambda x: x["f"]), F.lit(None)), lambda at: F.transform("c", lambda x, i: F.struct(x["chunk"].alias("chunk"), F.get(at, i).alias("before"))))
    entered = rows_of(lists, entries, "doc_id").select("doc_id", "m.*")
    entries = let(_entries(F.transform("pages", lambda p: p["f"]), F.col("before")), lambda at: F.transform("pages", lambda p, i: F.struct(p["page"].alias("page"), F.get(at, i).alias("before"))))
    return rows_of(chunks.join(entered, ["doc_id", "chunk"]), entries, "doc_id").select("doc_id", "m.*")


def _chunked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("chunk", F.floor(F.col("start") / CHUNK_OFFSETS))


def last_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` (doc_id, start, ...; one for each start) with the last value that
    isn't null up to each row, from chunks of offsets."""
    rows = _chunked(rows).withColumn("_own", value)
    chunks = rows.groupBy("doc_id", "chunk").agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), F.col("start"))).alias("_top"))
    earlier = Window.partitionBy("doc_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    above = chunks.select("doc_id", "chunk", F.last("_top", ignorenulls=True).over(earlier).alias("_above"))
    here = Window.partitionBy("doc_id", "chunk").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_here", F.last("_own", ignorenulls=True).over(here)).join(above, ["doc_id", "chunk"])
    return found.withColumn(name, F.coalesce("_here", "_above")).drop("chunk", "_own", "_here", "_above")


def next_start(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the start of the next row of the document, null for the last."""
    rows = _chunked(rows)
    chunks = rows.groupBy("doc_id", "chunk").agg(F.min("start").alias("low"))
    below = chunks.select("doc_id", "chunk", F.lead("low").over(Window.partitionBy("doc_id").orderBy("chunk")).alias("_below"))
    here = F.lead("start").over(Window.partitionBy("doc_id", "chunk").orderBy("start"))
    return rows.withColumn("_here", here).join(below, ["doc_id", "chunk"]).withColumn(name, F.coalesce("_here", "_below")).drop("chunk", "_here", "_below")


def assembled(stretches: DataFrame, pages: DataFrame) -> DataFrame:
    """``stretches`` (doc_id, start, end, ...; one for each start) with their text,
    from the pages that each covers."""
    narrow = stretches.select("doc_id", "start", "end")
    spans = pages.select("doc_id", F.col("base").alias("start"), (F.col("base") + F.length("body")).alias("end"), "page")
    hit = interval.overlaps(narrow, spans, ["doc_id"], 4 * interval.WIDTH)
    hit = hit.select("doc_id", F.col("l.start").alias("start"), F.col("l.end").alias("end"), F.col("r.page").alias("page"))
    inside = lambda x: (x - F.col("base")).cast("int")
    piece = cut(F.col("body"), F.greatest(inside(F.col("start")), F.lit(0)), F.least(inside(F.col("end")), F.length("body")))
    pieces = hit.join(pages, ["doc_id", "page"]).groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("page", piece.alias("piece")))).alias("p"))
    texts = pieces.select("doc_id", "start", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"))
    return stretches.join(texts, ["doc_id", "start"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def _pieces(pages: DataFrame) -> DataFrame:
    """(doc_id, page, at, label, body, above, piece): what each page holds of each
    article: of those that begin on it with their label, where their text starts
    and the last heading before; of the one that goes on from before, the rest,
    with the line feed between the pages."""
    text, base = F.col("text"), F.col("base")

    def own(h: Column, following: Column, heading: Column, above: Column) -> Column:
        end = F.greatest(F.least(following, heading, F.length(text)), h["end"])
        return F.struct((base + h["start"]).alias("at"), h["label"].alias("label"), (base + h["end"]).alias("body"), above.alias("above"), cut(text, h["end"], end).alias("piece"))

    none = F.lit(None)
    first = F.get("heads", F.lit(0))
    next_heading = lambda h: F.array_min(F.filter("headings", lambda x: x > h["start"]))
    above = lambda h: F.coalesce(base + F.array_max(F.filter("headings", lambda x: x < h["start"])), F.col("heading"))
    every = F.transform("heads", lambda h, i: own(h, F.get("heads", i + 1)["start"], next_heading(h), above(h)))
    one = F.array(own(first, none.cast("int"), none.cast("int"), F.col("heading")))
    rest = F.concat(F.lit("\n"), cut(text, F.lit(0), F.least(first["start"], F.get("headings", F.lit(0)), F.length(text))))
    on = F.array(F.struct(F.col("point.at").alias("at"), none.cast("string").alias("label"), none.cast("long").alias("body"), none.cast("long").alias("above"), rest.alias("piece")))
    begun = F.when((F.size("heads") == 1) & (F.size("headings") == 0), one).when(F.size("heads") > 0, every).otherwise(F.slice(one, 1, 0))
    goes_on = F.coalesce(F.col("point.header"), F.lit(False))
    return rows_of(pages, F.when(goes_on, F.concat(on, begun)).otherwise(begun), "doc_id", "page").select("doc_id", "page", "m.*")


def pasals(pages: DataFrame) -> DataFrame:
    """``segment.pasals`` of documents given as pages (doc_id, page, text), which
    are joined by line feeds in the order of their numbers.

    One row for each page number; a null text is an empty page; other columns are
    ignored.  Only an article must fit a row, a document never does.  Pages are
    read once; each gives its pieces of articles, which are put together in one
    shuffle.
    """
    marked = kept(_marked(pages))
    chunks = kept(_chunks(marked))
    at = placed(marked, chunks)
    # a restart counts from the last heading before it, which is a cut anyway, else from itself
    heads = rows_of(at, F.col("heads"), "doc_id", "base", "headings", "heading").select("doc_id", (F.col("base") + F.col("m.start")).alias("start"), (F.col("m.restart") & F.col("heading").isNull() & ~F.coalesce(F.get("headings", F.lit(0)) < F.col("m.start"), F.lit(False))).alias("cut"))
    restarts = kept(heads.where("cut").select("doc_id", "start"))
    again = kept(restarts.select("doc_id").distinct().withColumn("again", F.lit(True)))
    since = last_before(heads.join(again, "doc_id", "left_semi"), F.when(F.col("cut"), F.col("start")), "since")
    since = kept(since.where("since is not null").select("doc_id", F.col("start").alias("at"), "since"))
    headings = at.where(F.size("headings") > 0).select("doc_id", "base", F.explode("headings").alias("x")).select("doc_id", (F.col("base") + F.col("x")).alias("start"))
    documents = chunks.where("some").select("doc_id", "length").distinct()
    every = kept(documents.select("doc_id", F.lit(0).cast("long").alias("start")).unionByName(headings).unionByName(restarts).distinct())
    # the head of each section, from the pages that may hold some of it
    ends = next_start(every, "end").join(documents, "doc_id").select("doc_id", "start", F.least(F.coalesce("end", "length"), F.col("start") + LOOK_AHEAD).alias("end"))
    near = (F.col("base") < LOOK_AHEAD) | (F.size("headings") > 0) | (F.col("base") - F.col("heading") < LOOK_AHEAD) | F.col("again")
    some = at.join(again, "doc_id", "left").where(near).select("doc_id", "page", "base", F.concat("text", F.lit("\n")).alias("body"))
    named = kept(assembled(ends, some).select("doc_id", F.col("start").alias("section_start"), segment.section_label(F.col("text"), F.col("start") == 0).alias("section")))
    pieces = portioned(_pieces(at), "doc_id", "at")
    parts = F.sort_array(F.collect_list(F.struct("page", "piece")))
    whole = pieces.groupBy("doc_id", "at").agg(F.max("label").alias("pasal"), F.max("body").alias("start"), F.max("above").alias("above"), F.array_join(parts["piece"], "").alias("text"))
    articles = whole.join(since, ["doc_id", "at"], "left").withColumn("section_start", F.coalesce("above", "since", F.lit(0)))
    rows = articles.join(named, ["doc_id", "section_start"]).select("doc_id", "section", "pasal", "start", (F.col("start") + F.length("text")).alias("end"), "text")
    return segment.cited(portioned(rows, "doc_id", "section", "pasal"))


def anomalies(pages: DataFrame) -> DataFrame:
    """``segment.section_anomalies`` of documents given as pages."""
    marked = kept(_marked(pages))
    rows = rows_of(placed(marked, kept(_chunks(marked))), F.col("heads"), "doc_id", "base").where("m.odd")
    return rows.select("doc_id", F.lit("pasal_numbering_goes_backwards").alias("warning"), F.col("m.previous").alias("from_num"), F.col("m.number").alias("to_num"), (F.col("base") + F.col("m.start")).cast("int").alias("offset"))


def units(pages: DataFrame) -> DataFrame:
    """``segment.units`` of documents given as pages (doc_id, page, text)."""
    return segment.units_of(pasals(pages))
