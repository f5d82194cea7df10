"""Figures written twice, in digits and in words.

Digits and words are parsed apart, damage of the scan is repaired in each, and
the two are reconciled into one value with its provenance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import let, rows_of
from .matchers import find_all
from .text import strip

# Look-alikes, vocabulary, bounds and patterns of the source format.
GLYPH_FROM, GLYPH_TO = "lIOoSB", "110058"
PERCENT_CEILING, COUNT_CEILING = 300, 1000
UNITS = {"nol": 0, "satu": 1, "dua": 2, "tiga": 3, "empat": 4, "lima": 5, "enam": 6, "tujuh": 7, "delapan": 8, "sembilan": 9}
SPECIAL = {"sepuluh": 10, "sebelas": 11, "seratus": 100, "seribu": 1000}
STRUCTURE = ("belas", "puluh", "ratus", "koma", "persen")
PERCENT_TAIL = r"(?iu)(?:%|Vo|Yo|o/o|7o|%o|Zo)(?U:\s*)$"
PAIR = r"(?dU)([0-9lIOoSB][0-9lIOoSB,. ]{0,8}(?:%|[VY]o|o/o|7o|o%|%o|Zo))\s*[\(\[l]\s*([a-zA-Z][a-zA-Z\s]*?persen)\s*[\)\]]?"
_DURATION = r"([0-9lIOoSB][0-9lIOoSB ]{0,5})\s*[\(\[l]\s*([a-zA-Z][a-zA-Z\s]*?)\s*[\)\]]\s*((?iu:hari\s+kerja|hari\s+kalender|hari|bulan|tahun))\b"
PAIR_DURATION = rf"(?dU)(?<![\d.,]){_DURATION}"
DURATION_PARTS = rf"(?dU){_DURATION}"

VOCABULARY = sorted({*UNITS, *SPECIAL, *STRUCTURE})
_ANY_WORD = "|".join(VOCABULARY)  # no word starts another: a glued token has one reading
PARSED = "struct<value:double,repaired:boolean>"


def _words_array(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _value_map(values: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _parsed(value: Column, repaired: Column) -> Column:
    return F.struct(value.cast("double").alias("value"), F.coalesce(repaired, F.lit(False)).alias("repaired"))


def _glyphs(c: Column) -> Column:
    return F.translate(c, GLYPH_FROM, GLYPH_TO)


#: Phrases of one number word, which most figures are: value, and whether it needed repair.
_ONE_WORD = {w: n for w, n in (UNITS | SPECIAL).items() if w != "seribu"}
_RATES = {f"{w}{gap}persen": (n / 100.0, not gap) for gap in (" ", "") for w, n in _ONE_WORD.items()}
_COUNTS = {w: (float(n), False) for w, n in _ONE_WORD.items() if n > 0}


def _known(phrases: dict[str, tuple[float, bool]], raw: Column, otherwise: Column) -> Column:
    """What a phrase is known to spell, else what its words do.

    Most are in small letters: these are looked up as they are, without a lambda.
    """
    place = lambda c: F.array_position(_words_array(list(phrases)), c).cast("int")
    values = F.array(*(_parsed(F.lit(v), F.lit(fixed)) for v, fixed in phrases.values()))
    others = let(place(F.lower(raw)), lambda k: F.when(k > 0, F.get(values, k - 1)).otherwise(otherwise))
    return F.when(raw.isin(*phrases), F.get(values, place(raw) - 1)).otherwise(others)


def parse_digits(raw: Column) -> Column:
    """struct(value, repaired) of a percentage's digits, as a fraction."""

    def tail(s: Column) -> Column:
        def of(body: Column) -> Column:
            plain = F.replace(F.replace(_glyphs(body), F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
            number = F.when((body != s) & plain.rlike(r"^[0-9]+(\.[0-9]+)?\z"), plain).try_cast("double")
            value = F.when(number <= PERCENT_CEILING, number / F.lit(100.0))
            return _parsed(value, number.isNotNull() & ((number > PERCENT_CEILING) | (plain != body)))

        return let(F.regexp_replace(s, PERCENT_TAIL, ""), of)

    def short_or(digits: Column) -> Column:
        number = F.when(digits != "", _glyphs(digits)).try_cast("double")
        short = _parsed(F.when(number <= PERCENT_CEILING, number / F.lit(100.0)), (number > PERCENT_CEILING) | (_glyphs(digits) != digits))
        return F.when(number.isNotNull(), short).otherwise(let(F.regexp_replace(strip(raw), r"(?U)^[a-zA-Z]\.?\s+", ""), tail))

    return let(F.regexp_extract(raw, r"^([0-9lIOoSB]{1,3})(?:%|o/o)\z", 1), short_or)


def parse_digits_count(raw: Column) -> Column:
    """struct(value, repaired) of a bare count."""

    def of(body: Column) -> Column:
        number = F.when(_glyphs(body).rlike(r"^[0-9]+\z"), _glyphs(body)).try_cast("double")
        value = F.when(number <= COUNT_CEILING, number)
        return _parsed(value, number.isNotNull() & ((number > COUNT_CEILING) | (_glyphs(body) != body)))

    number = _glyphs(raw).try_cast("double")
    return F.when(raw.rlike(r"^[0-9lIOoSB]{1,3}\z"), _parsed(F.when(number <= COUNT_CEILING, number), _glyphs(raw) != raw)).otherwise(let(F.replace(strip(raw), F.lit(" "), F.lit("")), of))


def snap(token: Column) -> Column:
    """struct(words, fixed): the vocabulary word one edit away, if it is the
    only one or all such words have one value.

    Words of another length are passed over and the distance stops at two.  A
    dictionary of deletions as a map literal took twice as long as comparing all
    words, since a map is searched in order; this takes half.
    """
    near = F.filter(_words_array(VOCABULARY), lambda w: (F.abs(F.length(w) - F.length(token)) <= 1) & (F.levenshtein(token, w, 1) == 1))

    def of(found: Column) -> Column:
        values = F.array_distinct(F.transform(found, lambda w: F.coalesce(F.try_element_at(_value_map(UNITS | SPECIAL), w), F.lit(-1))))
        one = F.size(values) == 1
        return F.struct(F.when(one, F.slice(found, 1, 1)).otherwise(F.array().cast("array<string>")).alias("words"), F.lit(True).alias("fixed"))

    return let(near, of)


def normalise_token(token: Column) -> Column:
    """struct(words, fixed): itself, its glued words, or its repair."""
    known = F.array_contains(_words_array(VOCABULARY), token)
    glued = token.rlike(rf"^({_ANY_WORD})+\z")
    same = F.struct(F.array(token).alias("words"), F.lit(False).alias("fixed"))
    parts = F.struct(F.regexp_extract_all(token, F.lit(f"({_ANY_WORD})"), 1).alias("words"), F.lit(True).alias("fixed"))
    return F.when(known, same).when(glued, parts).otherwise(snap(token))


def word_tokens(raw: Column) -> Column:
    """struct(tokens, repaired, unresolved) of a spelled figure."""
    split = F.filter(F.split(F.regexp_replace(F.lower(raw), "[^a-z ]", " "), " "), lambda t: t != "")

    def of(norm: Column) -> Column:
        return F.struct(F.flatten(F.transform(norm, lambda n: n["words"])).alias("tokens"), F.exists(norm, lambda n: n["fixed"]).alias("repaired"), F.exists(norm, lambda n: F.size(n["words"]) == 0).alias("unresolved"))

    return let(F.transform(split, normalise_token), of)


def int_from(tokens: Column) -> Column:
    """The whole number that number words spell; other words are passed over."""
    unit = lambda t: F.try_element_at(_value_map(UNITS), t)

    def step(acc: Column, t: Column) -> Column:
        total, now = acc["total"], acc["now"]
        tens = F.when(now == 0, 1).otherwise(now)
        added = F.when(t == "seratus", 100).when(t == "puluh", tens * 10).when(t == "ratus", tens * 100)
        fresh = F.when(added.isNotNull(), 0).when(t == "sepuluh", 10).when(t == "sebelas", 11).when(t == "belas", now + 10)
        return F.struct((total + F.coalesce(added, F.lit(0))).alias("total"), F.coalesce(unit(t), fresh, now).alias("now"))

    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("now"))
    return F.aggregate(tokens, zero, step, lambda a: a["total"] + a["now"])


def parse_words(raw: Column) -> Column:
    """struct(value, repaired) of a percentage in words, as a fraction."""

    def of(w: Column) -> Column:
        until = F.array_position(w["tokens"], "persen").cast("int")

        def value(head: Column) -> Column:
            comma = F.array_position(head, "koma").cast("int")
            whole = int_from(F.when(comma > 0, F.slice(head, F.lit(1), F.greatest(comma - 1, F.lit(0)))).otherwise(head))
            units = F.transform(F.slice(head, comma + 1, F.size(head)), lambda t: F.try_element_at(_value_map(UNITS), t).cast("string"))
            digits = F.when(comma > 0, F.array_join(units, "")).otherwise("")
            number = F.concat(whole.cast("string"), F.when(digits != "", F.concat(F.lit("."), digits)).otherwise("")).try_cast("double")
            return F.when(number <= PERCENT_CEILING, number / F.lit(100.0))

        usable = ~w["unresolved"] & (until > 1)
        head = F.slice(w["tokens"], F.lit(1), F.greatest(until - 1, F.lit(0)))
        return _parsed(F.when(usable, let(head, value)), w["repaired"])

    return _known(_RATES, raw, let(word_tokens(raw), of))


def parse_words_count(raw: Column) -> Column:
    """struct(value, repaired) of a count in words; zero is no count."""

    def of(w: Column) -> Column:
        tokens = w["tokens"]
        usable = ~w["unresolved"] & (F.size(tokens) > 0) & ~F.arrays_overlap(tokens, _words_array(["koma", "persen"]))
        return let(int_from(tokens), lambda n: _parsed(F.when(usable & (n > 0) & (n <= COUNT_CEILING), n), w["repaired"]))

    return _known(_COUNTS, raw, let(word_tokens(raw), of))


def _reconciled(numeral: Column, words: Column, d: Column, w: Column, unit: Column) -> Column:
    dv, wv, dr, wr = d["value"], w["value"], d["repaired"], w["repaired"]
    two = dv.isNotNull() & wv.isNotNull()
    same = two & (F.abs(dv - wv) < 1e-9)
    value = F.when(same, dv).when(two & dr & ~wr, wv).when(two & wr & ~dr, dv).when(~two, F.coalesce(dv, wv))
    status = F.when(same & ~dr & ~wr, "agree").when(same | (two & (dr != wr)), "recovered").when(two, "disagree").when(value.isNotNull(), "single_channel").otherwise("unparsed")
    fields = {
        "source_numeral": numeral, "source_words": words, "digit_value": dv, "digit_repaired": dr, "word_value": wv, "word_repaired": wr,
        "value": value, "status": status, "ocr_recovered": status.isin("recovered", "single_channel"), "needs_review": status.isin("disagree", "unparsed"), "unit": unit,
    }
    return F.struct(*(c.alias(k) for k, c in fields.items()))


def reconcile(numeral: Column, words: Column, digits: Column, spelled: Column, unit: Column) -> Column:
    """One value with its provenance from the two readings of a figure.

    A reading that needed no repair wins over one that did; two readings that
    stand alike and differ are left to a human.
    """

    return let(F.struct(digits.alias("d"), spelled.alias("w")), lambda both: _reconciled(numeral, words, both["d"], both["w"], unit))


def recover(numeral: Column, words: Column) -> Column:
    """A percentage; its value is a fraction."""
    return reconcile(numeral, words, parse_digits(numeral), parse_words(words), F.lit("fraction"))


def normalise_unit(raw: Column) -> Column:
    """Lower case with underscores; day types are never merged."""
    return F.regexp_replace(F.lower(strip(raw)), r"(?U)\s+", "_")


def recover_duration(numeral: Column, words: Column, unit: Column) -> Column:
    """A duration; its value is a count of its unit."""
    return reconcile(numeral, words, parse_digits_count(numeral), parse_words_count(words), normalise_unit(unit))


def apart(some: Column, others: Column) -> Column:
    """Matches of one list that overlap none of another; either is in order and
    its matches are apart.

    A match can only overlap the last other one that starts before its end, whose
    number is its place in one sorted list of ends and starts, less its own.
    """
    ends = F.transform(some, lambda m, i: m["end"].cast("long") * (1 << 33) + i)
    starts = F.transform(others, lambda m, i: m["start"].cast("long") * (1 << 33) + (1 << 32) + i)
    own = lambda k: F.shiftright(k, 32).bitwiseAND(F.lit(1)) == 0
    number = lambda k: k.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    met = F.transform(F.sort_array(F.concat(ends, starts)), lambda k, p: F.when(own(k), F.struct(F.get(some, number(k)).alias("m"), F.get(others, p - number(k) - 1).alias("o"))))
    free = F.filter(met, lambda x: x.isNotNull() & ~F.coalesce(x["o"]["end"] > x["m"]["start"], F.lit(False)))
    return F.transform(free, lambda x: x["m"])


def figures(text: Column) -> Column:
    """array<struct<start, end, text, duration>>: where the figures written twice
    are, in reading order; nothing of them is parsed.  A duration that overlaps a
    percentage is none."""
    marked = lambda found, duration: F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), F.lit(duration).alias("duration")))

    def both(percents: Column) -> Column:
        def of(d: Column) -> Column:
            merged = F.sort_array(F.concat(marked(percents, False), marked(let(d, lambda x: apart(x, percents)), True)))
            return F.when(F.size(d) == 0, marked(percents, False)).when(F.size(percents) == 0, marked(d, True)).otherwise(merged)

        return let(find_all(text, PAIR_DURATION), of)

    return let(find_all(text, PAIR), both)


def figures_by_row(text: Column) -> Column:
    """``figures`` for a column of its own, which Spark compiles: lambdas are
    interpreted, and a text with one figure, as most paragraphs have, or without
    any gets to none.  Inside a lambda the other is quicker."""

    def single(pattern: str, duration: bool) -> Column:
        start = F.length(F.regexp_replace(text, pattern + r"(?s:.*)\z", ""))
        found = F.regexp_extract(text, pattern, 0)
        return F.array(F.struct(start.alias("start"), (start + F.length(found)).alias("end"), found.alias("text"), F.lit(duration).alias("duration")))

    rate, count = text.rlike(PAIR), text.rlike(PAIR_DURATION)
    once = lambda pattern: F.regexp_count(text, F.lit(pattern)) == 1
    none = F.array().cast("array<struct<start:int,end:int,text:string,duration:boolean>>")
    few = F.when(~rate & ~count, none).when(~count & once(PAIR), single(PAIR, False)).when(~rate & once(PAIR_DURATION), single(PAIR_DURATION, True))
    return few.when(text.isNotNull(), figures(text))


def scan(text: Column) -> Column:
    """array<struct> of all figures written twice, in reading order, each with
    start, end and matched_text.  A duration that overlaps a percentage is none."""

    def of(m: Column, pattern: str, duration: bool) -> Column:
        def record(p: Column) -> Column:
            # of all groups only a count's digits may end in a space
            part = [strip(p[k]) if duration and k == 0 else p[k] for k in range(3 if duration else 2)]
            rec = recover_duration(*part) if duration else recover(*part)
            return let(rec, lambda r: F.struct(m["start"].alias("start"), m["end"].alias("end"), *(r[k].alias(k) for k in RECORD), m["text"].alias("matched_text")))

        return let(_parts(m["text"], pattern, duration), record)

    return F.transform(figures(text), lambda m: F.when(m["duration"], of(m, DURATION_PARTS, True)).otherwise(of(m, PAIR, False)))


def _parts(text: Column, pattern: str, duration: bool) -> Column:
    # one run of the pattern for all groups
    return F.split(F.regexp_replace(text, pattern, "\x01".join(f"${k + 1}" for k in range(3 if duration else 2))), "\x01")


def with_record(rows: DataFrame, found: str) -> DataFrame:
    """``rows`` with a figure of ``figures`` in the column ``found`` made its
    record of ``scan``.

    Column by column, which Spark compiles, where the lambda of ``scan`` is interpreted.
    """
    others = [F.col(c) for c in rows.columns if c != found]
    m = F.col(found)
    duration = m["duration"]
    each = rows.select(*others, m, F.when(duration, _parts(m["text"], DURATION_PARTS, True)).otherwise(_parts(m["text"], PAIR, False)).alias("__p"))
    p = [F.get("__p", F.lit(k)) for k in range(3)]
    unit = F.when(duration, normalise_unit(p[2])).otherwise("fraction")
    each = each.select(*others, m, F.when(duration, strip(p[0])).otherwise(p[0]).alias("__numeral"), p[1].alias("__words"), unit.alias("__unit"))
    numeral, words = F.col("__numeral"), F.col("__words")
    digits = F.when(duration, parse_digits_count(numeral)).otherwise(parse_digits(numeral))
    spelled = F.when(duration, parse_words_count(words)).otherwise(parse_words(words))
    each = each.select(*others, m, numeral, words, "__unit", digits.alias("__d"), spelled.alias("__w"))
    each = each.select(*others, m, _reconciled(numeral, words, F.col("__d"), F.col("__w"), F.col("__unit")).alias("__r"))
    record = F.struct(m["start"].alias("start"), m["end"].alias("end"), *(F.col("__r")[k].alias(k) for k in RECORD), m["text"].alias("matched_text"))
    # a filter on the record stays above a generator; pushed below, it would hold every step's expressions many times over
    return each.select(*others, F.explode_outer(F.array(record)).alias(found))


def scanned(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``rows`` (..., text) with a row for each figure of ``scan``:
    its place ``i`` and itself, ``m``."""
    return with_record(rows_of(rows, figures_by_row(F.col("text")), *columns), "m")


RECORD = ("source_numeral", "source_words", "digit_value", "digit_repaired", "word_value", "word_repaired", "value", "status", "ocr_recovered", "needs_review", "unit")
