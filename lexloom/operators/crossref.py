"""Internal citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import let, rows_of
from ..functions.matchers import cut, find_with_rest, first_start, rows_of_all, sentinels
from ..functions.numerals import GLYPH_FROM, GLYPH_TO
from ..functions.text import strip
from ..plans.storage import kept, portioned

# Keywords and patterns of the source language, in order.
KEYWORDS = ("pasal", "ayat", "huruf", "angka", "dan", "atau", "pada", "dalam")
TOKEN = r"\(\s*[0-9A-Za-z]{1,3}\s*\)?|[A-Za-z]+|[0-9]+"
ANCHOR = r"(?iusU)sebagaimana\s+(?:telah\s+)?(?:beberapa\s+kali\s+)?(dimaksud|diatur|ditetapkan|tercantum|dimaksudkan|diubah)[\s,]*(.{0,200}?)(?=\.|\n?\z)"
ANCHOR_PARTS = r"(?iusU)^sebagaimana\s+(?:telah\s+)?(?:beberapa\s+kali\s+)?(dimaksud|diatur|ditetapkan|tercantum|dimaksudkan|diubah)[\s,]*(.*)\z"
EXTERNAL = (
    r"undang-undang\s+dasar",
    r"ketentuan\s+peraturan\s+perundang-undangan",
    r"peraturan\s+perundang-undangan",
    r"undang-undang\s+(mengenai|di\s+bidang|nomor)",
    r"peraturan\s+(daerah|pemerintah|presiden|menteri)(\s+ini)?",
    r"lampiran",
)
NOTE_CHARS = 60
ARTICLE = r"(?dm)^[ \t]*Pasal[ \t]+([0-9]+[A-Za-z]?)[ \t]*$"
BODY_END = r"(?dm)^[ \t]*PENJELASAN[ \t]*$"
PARAGRAPH = r"(?dm)^[ \t]*\(([0-9]+)\)[ \t]+"
LETTER = r"(?dm)^[ \t]*([a-z])\.[ \t]+"
#: What every letter holds, wherever the text around it is cut.
SOME_LETTER = r"[a-z]\.[ \t]"
_TARGET = "array<struct<pasal:string,ayat:string,huruf:string>>"


def tokens(span: Column) -> Column:
    """Lower-case words, numbers and bracketed numbers."""
    return F.transform(F.regexp_extract_all(span, F.lit(f"({TOKEN})"), 1), F.lower)


def snap_keyword(token: Column) -> Column:
    """A word one edit from a keyword is that keyword, the first in order."""
    near = F.filter(F.array(*map(F.lit, KEYWORDS)), lambda k: (F.abs(F.length(k) - F.length(token)) <= 1) & (F.levenshtein(token, k, 1) >= 0))
    word = token.rlike("^[a-z]+$") & ~token.isin(*KEYWORDS)
    return F.when(word, F.coalesce(F.try_element_at(near, F.lit(1)), token)).otherwise(token)


def read_targets(span: Column, current: Column) -> Column:
    """array<struct<pasal, ayat, huruf>> that a citation names.

    A fold over the token positions: ``skip`` counts tokens already used,
    ``stop`` ends the chain at the first token that is no part of it, and an
    article named alone is a target when the chain ends.
    """

    def of(known: Column) -> Column:
        raw, word = known["raw"], known["word"]
        null = F.lit(None).cast("string")
        zero = F.struct(null.alias("pasal"), null.alias("ayat"), F.lit(False).alias("alone"), F.lit(0).alias("skip"), F.lit(False).alias("stop"), F.array().cast(_TARGET).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            w, next_raw, next_word = word[i], F.get(raw, i + 1), F.get(word, i + 1)
            idle = acc["stop"] | (acc["skip"] > 0)
            yes = lambda c: F.coalesce(c, F.lit(False))
            doubled = w.isin(*KEYWORDS) & yes(next_word == w)
            article = ~doubled & (w == "pasal") & yes(next_raw.rlike("^[0-9]+$"))
            bracket = ~doubled & (w == "ayat") & yes(next_raw.startswith("("))
            number = F.nullif(F.regexp_extract(F.translate(F.btrim(next_raw, F.lit("()")), GLYPH_FROM, GLYPH_TO), "^([0-9]+)", 1), F.lit(""))
            paragraph = bracket & number.isNotNull()
            item = yes(F.get(word, i + 2) == "huruf") & yes(F.get(raw, i + 3).rlike("^[a-z]$"))
            letter = ~doubled & (w == "huruf") & yes(next_raw.rlike("^[a-z]$"))
            joint = ~doubled & w.isin("dan", "atau", "pada", "dalam")
            home = F.coalesce(acc["pasal"], current)
            target = F.when(paragraph, F.struct(home.alias("pasal"), number.alias("ayat"), F.when(item, F.get(raw, i + 3)).alias("huruf"))).when(letter, F.struct(home.alias("pasal"), acc["ayat"].alias("ayat"), next_raw.alias("huruf")))
            stop = ~(doubled | article | paragraph | letter | joint)
            moved = F.struct(
                F.when(article, next_raw).otherwise(acc["pasal"]).alias("pasal"),
                F.when(article, null).when(paragraph, number).otherwise(acc["ayat"]).alias("ayat"),
                F.when(article, F.lit(True)).when(paragraph | letter, F.lit(False)).otherwise(acc["alone"]).alias("alone"),
                F.when(paragraph & item, 3).when(article | paragraph | letter, 1).otherwise(0).alias("skip"),
                stop.alias("stop"),
                F.when(paragraph | letter, F.concat(acc["out"], F.array(target))).otherwise(acc["out"]).alias("out"),
            )
            waiting = F.struct(acc["pasal"].alias("pasal"), acc["ayat"].alias("ayat"), acc["alone"].alias("alone"), F.greatest(acc["skip"] - 1, F.lit(0)).alias("skip"), acc["stop"].alias("stop"), acc["out"].alias("out"))
            return F.when(idle, waiting).otherwise(moved)

        def last(acc: Column) -> Column:
            return F.when(acc["alone"], F.concat(acc["out"], F.array(F.struct(acc["pasal"].alias("pasal"), null.alias("ayat"), null.alias("huruf"))))).otherwise(acc["out"])

        places = F.when(F.size(raw) > 0, F.sequence(F.lit(0), F.size(raw) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, zero, step, last)

    return let(tokens(span), lambda raw: let(F.struct(raw.alias("raw"), F.transform(raw, snap_keyword).alias("word")), of))


def _spellings() -> dict[str, str]:
    """For each keyword a pattern of the words that ``snap_keyword`` reads as it."""

    def near(word: str) -> str:
        swapped = [word[:i] + "[a-z]" + word[i + 1 :] for i in range(len(word))]
        longer = [word[:i] + "[a-z]" + word[i:] for i in range(len(word) + 1)]
        shorter = [word[:i] + word[i + 1 :] for i in range(len(word))]
        return "|".join(dict.fromkeys(swapped + longer + shorter))

    taken, out = ["|".join(KEYWORDS)], {}
    for word in KEYWORDS:
        out[word] = rf"(?:{word}|(?!(?:{'|'.join(taken)})\|)(?:{near(word)}))\|"
        taken.append(near(word))
    return out


_WORD = _spellings()
_JOINTS = "(?:" + "|".join(_WORD[w] for w in ("dan", "atau", "pada", "dalam")) + ")"
#: Tokens, each with a bar behind it, that name one place at most, with its parts.
ONE_PLACE = rf"^{_JOINTS}*(?:{_WORD['pasal']}([0-9]+)\|)?{_JOINTS}*(?:{_WORD['ayat']}\(([0-9]+)\)?\|(?:{_WORD['huruf']}([a-z])\|)?)?\z"
#: Tokens of which the first that joins none leads to no place either.
NO_PLACE = rf"^{_JOINTS}*+(?!{'|'.join(_WORD[w] for w in ('pasal', 'ayat', 'huruf'))})[^|]"


def with_targets(refs: DataFrame) -> DataFrame:
    """``refs`` (pasal, verb, span, ...) with ``read_targets`` of the spans.

    The fold is interpreted; a citation of one place, or of none, is read by two
    patterns in columns of their own, which Spark compiles.
    """
    columns = refs.columns
    said = F.lower(F.array_join(F.regexp_extract_all("span", F.lit(f"({TOKEN})"), F.lit(1)), "|"))
    each = refs.select(*columns, F.when(said == "", said).otherwise(F.concat(said, F.lit("|"))).alias("__said"))
    each = each.select(*columns, "__said", F.split(F.regexp_replace("__said", ONE_PLACE, "$1\x01$2\x01$3"), "\x01").alias("__part"))
    pasal, ayat, huruf = (F.nullif(F.get("__part", F.lit(k)), F.lit("")) for k in range(3))
    nothing = F.array().cast(_TARGET)
    place = F.array(F.struct(F.coalesce(pasal, F.col("pasal")).alias("pasal"), ayat.alias("ayat"), huruf.alias("huruf"))).cast(_TARGET)
    one = F.when(pasal.isNull() & ayat.isNull(), nothing).otherwise(place)
    read = F.when(F.size("__part") == 3, one).when(F.col("__said").rlike(NO_PLACE), nothing).otherwise(read_targets(F.col("span"), F.col("pasal")))
    return each.select(*columns, F.when(F.col("verb") == "diubah", nothing).otherwise(read).alias("targets"))


def external_note(span: Column) -> Column:
    """What names something outside the document, by the first pattern that occurs."""
    found = [F.nullif(F.regexp_extract(span, f"(?ius)({p}.*)", 1), F.lit("")) for p in EXTERNAL]
    return strip(F.substring(F.coalesce(*found), 1, NOTE_CHARS))


def references(pasals: DataFrame) -> DataFrame:
    """(doc_id, pasal, ref_no, phrase, start, end, verb, span, targets): every
    reference phrase of each article.  pasals: doc_id, pasal, text."""
    each = rows_of_all(pasals, F.col("text"), ANCHOR, "doc_id", "pasal").select("doc_id", "pasal", F.col("i").alias("ref_no"), "m.*")
    parts = F.split(F.regexp_replace("text", ANCHOR_PARTS, "$1\x01$2"), "\x01")
    read = each.select("doc_id", "pasal", "ref_no", F.col("text").alias("phrase"), "start", "end", parts.alias("parts"))
    read = read.select("doc_id", "pasal", "ref_no", "phrase", "start", "end", F.lower(F.get("parts", F.lit(0))).alias("verb"), F.get("parts", F.lit(1)).alias("span"))
    return with_targets(read)


def _labelled(text: Column, pattern: str) -> Column:
    """array<struct<label, from, to, text>>: what follows each marker, up to the
    next; of markers with one label the last."""
    found = F.transform(find_with_rest(text, pattern, "label"), lambda m: F.struct(m["label"].alias("label"), m["end"].alias("from"), (m["end"] + F.length(m["rest"])).alias("to"), m["rest"].alias("text")))

    def last(all_: Column) -> Column:
        # the highest place of each label: of label and place sorted, those before another label
        order = F.array_sort(F.transform(all_, lambda x, i: F.struct(x["label"].alias("label"), i.alias("i"))))
        ends = let(order, lambda o: F.filter(o, lambda x, i: F.coalesce(F.get(o, i + 1)["label"] != x["label"], F.lit(True))))
        return F.transform(F.array_sort(F.transform(ends, lambda x: x["i"])), lambda i: F.get(all_, i))

    return let(found, last)


def strict_index(docs: DataFrame) -> DataFrame:
    """(doc_id, pasal, ayat, huruf, start, end, text): what citations are looked
    up in: articles, their paragraphs, and letters below a paragraph or, in an
    article without paragraphs, below the article.  docs: doc_id, text.

    Unlike ``segment.units`` nothing is repaired and no order is asked for: only
    undamaged markers count, up to the first line that is just PENJELASAN, and
    of units with one label the last.  Offsets are those of the document.  A
    null text has no units.
    """
    stop = first_start(F.col("text"), BODY_END)
    body = docs.select("doc_id", F.substring("text", F.lit(1), F.coalesce(stop, F.length("text"))).alias("text"))
    marks = F.transform(find_with_rest(F.col("text"), ARTICLE, "pasal"), lambda m: F.struct(m["pasal"].alias("pasal"), m["end"].alias("start"), m["rest"].alias("text")))
    each = rows_of(body, marks, "doc_id").select("doc_id", "m.*").groupBy("doc_id", "pasal").agg(F.max_by(F.struct("start", "text"), "start").alias("p"))
    # lambdas are interpreted: an article with one paragraph or none, and nothing like a letter, gets to none
    marks = F.regexp_extract_all("text", F.lit(PARAGRAPH), F.lit(0))
    whole = each.select("doc_id", "pasal", "p.start", "p.text").withColumn("marks", marks)
    plain = (F.size("marks") <= 1) & ~F.col("text").rlike(SOME_LETTER) & ~sentinels(F.col("text"))
    whole = whole.withColumn("plain", plain).withColumn("ayat", F.when(~F.col("plain"), _labelled(F.col("text"), PARAGRAPH)))
    mark = F.get("marks", F.lit(0))
    at = F.when(F.col("text").startswith(F.concat(F.lit("\n"), mark)), 1).otherwise(F.length(F.split("text", PARAGRAPH, 2)[0]))
    whole = whole.withColumn("from", F.when(F.col("plain") & mark.isNotNull(), at + F.length(mark)))
    none = F.lit(None).cast("string")

    def unit(ayat: Column, huruf: Column, start: Column, end: Column, text: Column) -> Column:
        return F.struct(ayat.alias("ayat"), huruf.alias("huruf"), start.cast("int").alias("start"), end.cast("int").alias("end"), text.alias("text"))

    def letters(ayat: Column, base: Column, text: Column) -> Column:
        return F.transform(_labelled(text, LETTER), lambda h: unit(ayat, h["label"], base + h["from"], base + h["to"], h["text"]))

    base = F.col("start")
    own = F.array(unit(none, none, base, base + F.length("text"), F.col("text")))
    below = F.flatten(F.transform("ayat", lambda a: F.concat(F.array(unit(a["label"], none, base + a["from"], base + a["to"], a["text"])), letters(a["label"], base + a["from"], a["text"]))))
    direct = F.when(F.size("ayat") == 0, letters(none, base, F.col("text"))).otherwise(F.array().cast("array<struct<ayat:string,huruf:string,start:int,end:int,text:string>>"))
    only = unit(F.regexp_extract(mark, PARAGRAPH, 1), none, base + F.col("from"), base + F.length("text"), cut(F.col("text"), F.col("from"), F.length("text")))
    every = F.when(~F.col("plain"), F.concat(own, below, direct)).when(F.col("from").isNull(), own).otherwise(F.concat(own, F.array(only)))
    return rows_of(whole, every, "doc_id", "pasal").select("doc_id", "pasal", "m.*")


_KEY = ("doc_id", "pasal", "ayat", "huruf")


def _same(*pairs: tuple[str, str]) -> Column:
    """Equal names; a part that neither side names counts as equal."""
    on = F.lit(True)
    for i, (a, b) in enumerate(pairs):
        on = on & (F.col(a) == F.col(b) if i < 2 else F.col(a).eqNullSafe(F.col(b)))
    return on


def deepest(targets: DataFrame, units: DataFrame) -> DataFrame:
    """(doc_id, pasal, ayat, huruf, found_ayat, found_huruf, exact): for each
    different target that names an article there is, the deepest unit that is
    there, and whether it is the one asked for.

    Keys alone: each target is looked up as an article, a paragraph and a letter
    among the units' keys.  Both sides are shuffled once, by article, in portions
    that grow in number with the input; a window says which keys a unit has.
    """
    no_ayat, no_huruf = F.col("ayat").isNull(), F.col("huruf").isNull()
    level = lambda n, ayat, huruf: F.struct(F.lit(n).alias("level"), ayat.alias("at_ayat"), huruf.alias("at_huruf"))
    none = F.lit(None).cast("string")
    ways = F.array(level(0, none, none), F.when(~no_ayat, level(1, F.col("ayat"), none)), F.when(~no_huruf, level(2, F.col("ayat"), F.col("huruf"))))
    side = lambda df, unit: df.select(*_KEY, F.lit(unit).alias("unit"))
    both = portioned(side(targets, False).unionByName(side(units, True)).where("doc_id is not null and pasal is not null"), "doc_id", "pasal")
    own = F.array(level(-1, F.col("ayat"), F.col("huruf")))
    tried = both.select(*_KEY, "unit", F.inline(F.when(F.col("unit"), own).otherwise(F.array_compact(ways))))
    there = F.bool_or("unit").over(Window.partitionBy("doc_id", "pasal", "at_ayat", "at_huruf"))
    hits = tried.withColumn("there", there).where("there and not unit")
    known = hits.groupBy(*_KEY).agg(*(F.bool_or(F.col("level") == n).alias(k) for n, k in enumerate(("p", "a", "h")))).where("p")
    below = no_ayat | F.col("a")
    found_huruf = F.when(F.col("h") & below, F.col("huruf"))
    return known.select(*_KEY, F.when(F.col("a"), F.col("ayat")).alias("found_ayat"), found_huruf.alias("found_huruf"), (below & (no_huruf | F.col("h"))).alias("exact"))


def lookup(targets: DataFrame, units: DataFrame) -> DataFrame:
    """``targets`` (doc_id, pasal, ayat, huruf) with found_text and exact: the
    deepest unit that is there, and whether that is the one asked for.

    units: doc_id, pasal, ayat, huruf, text; one row for each unit.  Keys decide
    first; the last join fetches the texts of the units that were found, and no
    earlier step moves any.  A target whose article isn't there has no text and
    isn't exact.
    """
    found = deepest(targets, units).select(*(F.col(k).alias(f"k_{k}") for k in _KEY), "found_ayat", "found_huruf", F.col("exact").alias("known_exact"))
    placed = targets.join(found, _same(*((k, f"k_{k}") for k in _KEY)), "left").drop(*(f"k_{k}" for k in _KEY))
    texts = units.select(*(F.col(k).alias(f"u_{k}") for k in _KEY), F.col("text").alias("found_text"))
    known = F.col("known_exact").isNotNull()
    out = placed.join(texts, known & _same(("doc_id", "u_doc_id"), ("pasal", "u_pasal"), ("found_ayat", "u_ayat"), ("found_huruf", "u_huruf")), "left")
    return out.select(*targets.columns, "found_text", F.coalesce("known_exact", F.lit(False)).alias("exact"))


def resolve(pasals: DataFrame, units: DataFrame) -> DataFrame:
    """Every reference with its status, targets with texts, review flag and note."""
    key = ["doc_id", "current", "ref_no"]
    refs = kept(references(pasals).withColumnRenamed("pasal", "current"))
    each = rows_of(refs, F.col("targets"), *key).select(*key, F.col("i").alias("target_no"), "m.*")
    cross = each.where(F.col("pasal") != F.col("current"))
    found = lookup(cross, units).unionByName(each.where(F.col("pasal") == F.col("current")).withColumns({"found_text": F.lit(None).cast("string"), "exact": F.lit(None).cast("boolean")}))
    target = F.struct("target_no", "pasal", "ayat", "huruf", F.col("found_text").alias("text"))
    rows = found.groupBy(*key).agg(F.sort_array(F.collect_list(target)).alias("resolved"), F.bool_or(F.col("pasal") != F.col("current")).alias("cross"), F.bool_or(~F.col("exact")).alias("vague"))
    out = refs.join(rows, key, "left")
    note = external_note(F.col("span"))
    amended, some = F.col("verb") == "diubah", F.size("targets") > 0
    status = F.when(amended, "amendment_history").when(some & F.col("cross"), "cross_pasal").when(some, "same_pasal").when(note.isNotNull(), "external").otherwise("unresolved")
    out = out.withColumn("status", status)
    review = F.when(F.col("status") == "unresolved", True).when(F.col("status") == "cross_pasal", F.coalesce("vague", F.lit(False))).otherwise(False)
    said = F.when(F.col("status") == "external", note).when(F.col("status") == "unresolved", strip(F.col("span")))
    return out.select("doc_id", F.col("current").alias("pasal"), "ref_no", "phrase", "start", "end", "verb", "status", F.coalesce("resolved", F.array().cast("array<struct<target_no:int,pasal:string,ayat:string,huruf:string,text:string>>")).alias("targets"), review.alias("needs_review"), said.alias("note"))


def resolve_documents(docs: DataFrame) -> DataFrame:
    """``resolve`` of whole documents (doc_id, text), against their own strict index."""
    units = kept(strict_index(docs))
    return resolve(units.where("ayat is null and huruf is null").select("doc_id", "pasal", "text"), units)


def gold_resolution(norms: DataFrame, units: DataFrame) -> DataFrame:
    """(norm, hits, verdict): whether each cited unit is there just once.

    One shuffle by citation, in portions that grow in number with the input.
    """
    none = F.lit(None)
    there = units.select("doc_id", "citation", none.cast(norms.schema["norm"].dataType).alias("norm"), F.lit(True).alias("unit"))
    both = portioned(norms.select("doc_id", "citation", "norm", F.lit(False).alias("unit")).unionByName(there), "doc_id", "citation")
    n = F.count_if("unit").over(Window.partitionBy("doc_id", "citation"))
    cites = F.col("doc_id").isNotNull() & F.col("citation").isNotNull()
    out = both.withColumn("hits", F.when(cites, n).otherwise(F.lit(0))).where(~F.col("unit"))
    return out.select("norm", "hits", F.when(F.col("hits") == 0, "MISSING").when(F.col("hits") == 1, "ok").otherwise("AMBIG").alias("verdict"))
