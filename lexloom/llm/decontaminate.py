"""Benchmark decontamination by template canonicalisation.

Numbers, names and units in a text become typed placeholders.  Windows of the
resulting templates are joined by hash with those of the benchmark items; a
document is contaminated if one occurrence in it covers enough of an item and
what fills its placeholders is one consistent, one-to-one renaming of what fills
the item's.  So a question asked again with other numbers is found like a
verbatim copy.  Beside that, any verbatim run of an item's words is a match, and
so is a whole short item.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import free_name, keyed_text, portions, release, stored
from .shingles import mix, span_hashes, word_spans

#: Template tokens of a window; an item of fewer is one window.  Literal tokens
#: among them, at least, and in a shorter window.
WINDOW, LITERALS, SHORT_LITERALS = 8, 3, 4
#: Share of an item's tokens that matching windows cover, at least, and share
#: of the placeholder positions that follow the renaming, at least.
COVER, AGREE = 0.5, 0.8
#: Words of a verbatim run that is a match whatever its share of the item; an
#: item of fewer words is one run.
EXACT = 13
#: Different hashes of the benchmark's windows and runs, at most, by which every
#: task drops what can't match before the join (8 MB); beyond, the join does it.
SENT_HASHES = 1 << 20
#: Leading bits of a hash by which most are told to be unknown.
LEADING = 22
BATCH = 1 << 20
NUMBER, NAME, UNIT = np.uint64(1), np.uint64(2), np.uint64(3)
# Number words and units in English, French, German and Spanish.
_NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille "
    "zwei drei vier f\u00fcnf sechs sieben acht neun zehn elf zw\u00f6lf dreizehn vierzehn f\u00fcnfzehn zwanzig drei\u00dfig vierzig f\u00fcnfzig sechzig siebzig achtzig neunzig hundert tausend "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil"
).split()
_UNITS = (
    "km m cm mm mi ft yd inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres kg g mg lb lbs oz ton tons tonne tonnes gram grams kilogram kilograms pound pounds ounce ounces "
    "l ml liter liters litre litres gallon gallons cup cups s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur gbp percent degree degrees mph kmh kph w kw kwh v hz j kj cal kcal "
    "kilom\u00e8tre kilom\u00e8tres m\u00e8tre m\u00e8tres seconde secondes heure heures jour jours semaine semaines mois an ans ann\u00e9e ann\u00e9es pour-cent degr\u00e9 degr\u00e9s "
    "sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren prozent grad pfund "
    "kil\u00f3metro kil\u00f3metros metro metros segundo segundos minuto minutos hora horas d\u00eda d\u00edas semana semanas mes meses a\u00f1o a\u00f1os gramo gramos kilo kilos litro litros grado grados"
).split()
# First byte and range of the second of capital letters beyond ASCII: Latin-1, Greek, Cyrillic.
_CAPITALS = ((0xC3, 0x80, 0x9E), (0xCE, 0x91, 0xA9), (0xD0, 0x80, 0xAF))
#: The ways to read a text, by whether a capitalised word that opens a sentence is
#: a name, and what tells their windows apart.
READINGS = ((False, np.uint64(0)), (True, np.uint64(0x2545F4914F6CDD1D)))
_ODD = np.random.default_rng(0x7E3A).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)

_EXACT_ODD = np.random.default_rng(0x7E3B).integers(1, 1 << 63, EXACT, dtype=np.uint64) | np.uint64(1)


def _hash_of(words: list[str]) -> np.ndarray:
    raw, begin, end, _ = word_spans([" ".join(words)])
    return np.unique(span_hashes(raw, begin, end))


_NUMBER_HASH, _UNIT_HASH = _hash_of(_NUMBER_WORDS), _hash_of(_UNITS)


@dataclass
class Templates:
    """Template tokens of texts, end to end."""

    token: np.ndarray  # hash of a literal token, or a placeholder
    value: np.ndarray  # hash of what stands there
    owner: np.ndarray  # its text
    sizes: np.ndarray  # tokens of each text
    word: np.ndarray  # hash of each word, placeholder or not, adjacent names apart
    word_owner: np.ndarray
    word_sizes: np.ndarray  # words of each text
    place: np.ndarray  # the template token that holds the word


def templates(texts: list[str], initial: bool = False) -> Templates:
    """One reading of the texts."""
    return readings(texts)[initial]


def readings(texts: list[str]) -> list[Templates]:
    """The texts in each of ``READINGS``.

    Words without the punctuation around them, A-Z lower-cased; a word with
    a digit or a number word is a number; a known unit right after a number is
    a unit; a capitalised word (Latin, Greek or Cyrillic) that starts neither a
    line nor a sentence is a name, in the second reading one that does, too;
    adjacent names inside a sentence are one, known by the last.  Words of
    punctuation alone vanish.
    """
    raw, begin, end, words = word_spans(texts, lower=False)
    digit = (raw >= 0x30) & (raw <= 0x39)
    upper = (raw >= 0x41) & (raw <= 0x5A)
    solid = digit | upper | ((raw >= 0x61) & (raw <= 0x7A)) | (raw >= 0x80)
    index = np.arange(len(raw))
    after = np.minimum.accumulate(np.where(solid, index, len(raw))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(solid, index, -1))
    core_begin, core_end = after[begin], before[end - 1] + 1
    kept = core_begin < end
    stops = np.cumsum(np.isin(raw, [ord(c) for c in ".!?:;"]))
    lines = np.cumsum(raw == 0x0A)
    owner = np.repeat(np.arange(len(texts)), words)
    closes = kept & (stops[end - 1] > stops[np.maximum(core_end - 1, 0)])
    n = len(begin)
    begin, end, owner, closes = core_begin[kept], core_end[kept], owner[kept], closes[kept]
    n = len(begin)
    opens = np.ones(n, bool)
    opens[1:] = closes[:-1] | (owner[1:] != owner[:-1]) | (lines[begin[1:]] != lines[begin[:-1]])
    lowered = np.where(upper, raw | 0x20, raw)
    value = span_hashes(lowered, begin, end)
    digits = np.concatenate([[0], np.cumsum(digit)])
    is_number = (digits[end] > digits[begin]) | np.isin(value, _NUMBER_HASH)
    first = raw[begin] if n else np.zeros(0, np.uint8)
    second = raw[np.minimum(begin + 1, len(raw) - 1)] if n else first
    capital = (first >= 0x41) & (first <= 0x5A)
    for lead, low, high in _CAPITALS:
        capital |= (first == lead) & (second >= low) & (second <= high)
    is_unit = np.zeros(n, bool)
    is_unit[1:] = is_number[:-1] & ~is_number[1:] & np.isin(value[1:], _UNIT_HASH) & (owner[1:] == owner[:-1])
    other = is_number | is_unit
    counts = np.bincount(owner, minlength=len(texts))
    inner = capital & ~other & ~opens
    return [_template(value, owner, counts, is_number, is_unit, capital & ~other if initial else inner, inner) for initial, _ in READINGS]


def _template(value: np.ndarray, owner: np.ndarray, counts: np.ndarray, is_number: np.ndarray, is_unit: np.ndarray, is_name: np.ndarray, inner: np.ndarray) -> Templates:
    """Words with their kinds as template tokens; names inside sentences join, so
    that every reading has as many tokens."""
    token = np.where(is_number, NUMBER, np.where(is_unit, UNIT, np.where(is_name, NAME, value | np.uint64(4))))
    word, word_owner, place = value, owner, np.arange(len(value))
    joined = np.zeros(len(value), bool)
    joined[1:] = inner[1:] & inner[:-1] & (owner[1:] == owner[:-1])
    if joined.any():
        place = np.cumsum(~joined) - 1
        value = value[np.append(~joined[1:], True)]
        token, owner = token[~joined], owner[~joined]
    return Templates(token, value, owner, np.bincount(owner, minlength=len(counts)), word, word_owner, counts, place)


def windows(t: Templates, size: int = WINDOW, salt: np.uint64 = READINGS[0][1]) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``size`` tokens with enough literal ones."""
    n = len(t.token) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    spread = mix(t.token)
    for k in range(size):
        total += spread[k : k + n] * _ODD[k]
    plain = np.concatenate([[0], np.cumsum(t.token > UNIT)])
    good = (t.owner[:n] == t.owner[size - 1 :]) & (plain[size:] - plain[:n] >= (LITERALS if size == WINDOW else SHORT_LITERALS))
    at = np.flatnonzero(good)
    return at, mix(total[at] + np.uint64(size) + salt)


def runs(t: Templates, sizes: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size its runs of words: start and hash of every one."""
    total = np.zeros(len(t.word), np.uint64)
    spread = mix(t.word)
    for k in range(min(max(sizes, default=0), len(t.word))):
        n = len(t.word) - k
        total = total[:n] + spread[k:] * _EXACT_ODD[k]
        if k + 1 in sizes:
            at = np.flatnonzero(t.word_owner[:n] == t.word_owner[k:])
            yield k + 1, at, mix(total[at] + np.uint64(k + 1))


def covered_by(found: list[tuple[int, int]], tokens: np.ndarray, places: np.ndarray) -> tuple[int, int, float, bool]:
    """The verdict on verbatim runs: (position in the item's words, size) of each."""
    covered = np.unique(np.concatenate([places[i : i + size] for i, size in found]))
    return len(covered), int((tokens[covered] <= UNIT).sum()), 1.0, False


def _verdict(filled: dict[int, int], tokens: np.ndarray, item_values: np.ndarray) -> tuple[int, int, float, bool] | None:
    """The verdict on one occurrence: the value found at each item position.

    The renaming is one-to-one: a slot agrees if most slots with the item's
    value have the text's, and most with the text's have the item's.
    """
    if len(filled) < COVER * len(tokens):
        return None
    there, back = defaultdict(Counter), defaultdict(Counter)
    slots = [p for p in filled if tokens[p] <= UNIT]
    for p in slots:
        there[int(item_values[p])][filled[p]] += 1
        back[filled[p]][int(item_values[p])] += 1
    agree = min(sum(max(c.values()) for c in x.values()) for x in (there, back)) / len(slots) if slots else 1.0
    if agree < AGREE:
        return None
    return len(filled), len(slots), agree, any(c.most_common(1)[0][0] != v for v, c in there.items())


def judge(hits: list[tuple[int, int, list[int]]], tokens: np.ndarray, item_values: np.ndarray) -> tuple[int, int, float, bool] | None:
    """Whether matched windows make a document contain an item.

    hits: (position in the item, position in the text, values found there) of
    each window.  Hits of one alignment, the difference of the two positions,
    are an occurrence of the item, which is judged on its own, and again with
    what nearby alignments add where words were put in or left out.
    Returns covered tokens, slots, their agreement and whether any was renamed,
    of the best occurrence: verbatim before renamed.
    """
    by_shift: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for i, d, values in hits:
        by_shift[d - i].append((i, values))
    shifts = sorted(by_shift)
    gap = max(WINDOW, len(tokens) // 2)
    best = None
    low = high = 0
    for shift in shifts:
        while shifts[low] < shift - gap:
            low += 1
        while high < len(shifts) and shifts[high] <= shift + gap:
            high += 1
        filled: dict[int, int] = {}
        for near in sorted(shifts[low:high], key=lambda s: (abs(s - shift), s)):
            if len(filled) == len(tokens):
                break
            for i, values in by_shift[near]:
                for k, v in enumerate(values):
                    filled.setdefault(i + k, v)
            if near == shift:
                verdicts = [_verdict(filled, tokens, item_values)]
        verdicts.append(_verdict(filled, tokens, item_values))
        best = max((v for v in [best, *verdicts] if v), key=lambda v: (not v[3], v[2], v[0]), default=None)
        if best and best[0] == len(tokens) and best[2] == 1.0 and not best[3]:
            break
    return best


FIELDS = "item_id long, covered long, item_tokens long, slots long, agreement double, renamed boolean"


def _row(key: str) -> Column:
    """Hash of a row's key and text."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("long").cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary"))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, reading, item_id, tokens, vals, places, h, size, at): every different
    item in each reading that differs, with its template and the hashes of its
    windows (size < 0) and, in the first, verbatim runs."""
    once = keyed_text(benchmark, "item_id").select(_row("item_id").alias("item"), "item_id", "text").dropDuplicates(["item"])
    names = ["item", "reading", "item_id", "tokens", "vals", "places", "h", "size", "at"]
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = None
                for reading, (t, (_, salt)) in enumerate(zip(readings([text]), READINGS, strict=True)):
                    if before is not None and np.array_equal(before, t.token):
                        continue
                    before = t.token
                    size = min(WINDOW, len(t.token))
                    at, hashes = windows(t, size, salt) if size else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                    found = [(h, -size, i) for h, i in zip(hashes.view(np.int64).tolist(), at.tolist(), strict=True)]
                    for n, start, h in runs(t, {min(EXACT, len(t.word))} - {0}) if not reading else ():
                        found += [(x, n, i) for x, i in zip(h.view(np.int64).tolist(), start.tolist(), strict=True)]
                    if found:
                        out.append((item, reading, key, *(x.astype(np.int64, copy=False).tolist() if x.dtype != np.uint64 else x.view(np.int64).tolist() for x in (t.token, t.value, t.place)), *map(list, zip(*found, strict=True))))
            columns = zip(*out, strict=True) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), *[longs] * 6), strict=True)], names)

    return once.mapInArrow(run, "item string, reading long, item_id long, " + ", ".join(f"{n} array<long>" for n in names[3:]))


def leading(known: np.ndarray) -> np.ndarray:
    """Flags of the leading bits that known hashes have."""
    out = np.zeros(1 << LEADING, bool)
    out[known >> np.uint64(64 - LEADING)] = True
    return out


def among(h: np.ndarray, known: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Indices of the hashes that are known: most fail by their leading bits."""
    maybe = np.flatnonzero(flags[h >> np.uint64(64 - LEADING)])
    some = h[maybe]
    return maybe[known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some]


def _hits(docs: DataFrame, shapes: list[int], held) -> DataFrame:
    """(uid, row, doc_id, reading, h, size, place, found): the windows of every
    document, in each reading, and runs that may be some item's, with the values
    in a window.

    uid numbers the rows of a task, so that equal rows are told apart.
    """
    names = ["uid", "row", "doc_id", "reading", "h", "size", "place", "found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_row = TaskContext.get().partitionId() << 40
        flags = None if held is None else leading(held.value)
        for whole in batches:
            for batch in portions(whole, 2, BATCH):
                keyed, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
                for reading, (t, (_, salt)) in enumerate(zip(readings(texts), READINGS, strict=True)):
                    begin = np.cumsum(t.sizes) - t.sizes
                    found = [(n, *windows(t, -n, salt), t.owner) for n in shapes if n < 0]
                    if not reading:
                        found += [(n, at, h, t.word_owner) for n, at, h in runs(t, {n for n in shapes if n > 0})]
                    for size, at, h, owner in found:
                        if held is not None:
                            good = among(h, held.value, flags)
                            at, h = at[good], h[good]
                        if not len(at):
                            continue
                        doc = owner[at]
                        wide = max(-size, 0)
                        values = t.value[at[:, None] + np.arange(wide)].view(np.int64).ravel() if wide else np.zeros(0, np.int64)
                        spans = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * wide, pa.int32()), pa.array(values))
                        place = at - begin[doc] if wide else np.zeros(len(at), np.int64)
                        take = pa.array(doc)
                        yield pa.RecordBatch.from_arrays([pa.array(doc + at_row), keyed.take(take), keys.take(take), pa.array(np.full(len(at), reading)), pa.array(h.view(np.int64)), pa.array(np.full(len(at), size)), pa.array(place, pa.int64()), spans], names)
                at_row += len(texts)
            release()

    return docs.mapInArrow(run, "uid long, row string, doc_id long, reading long, h long, size long, place long, found array<long>")


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_(), *[pa.int64()] * 4, pa.float64(), pa.bool_()]
    names = ["uid", "row", "doc_id", "item", "judged", "item_id", "covered", "item_tokens", "slots", "agreement", "renamed"]
    for batch in batches:
        rows = []
        for uid, row, key, item, hits, number, tokens, vals, places in zip(*(batch.column(c).to_pylist() for c in ("uid", "row", "doc_id", "item", "hits", "item_id", "tokens", "vals", "places")), strict=True):
            tokens, vals = (np.array(x, np.int64).view(np.uint64) for x in (tokens, vals))
            spans = [(h["at"], h["place"], np.array(h["found"], np.int64).view(np.uint64).tolist()) for h in hits if h["size"] < 0]
            verbatim = [(h["at"], h["size"]) for h in hits if h["size"] > 0]
            judged = judge(spans, tokens, vals)
            verdict = judged or (covered_by(verbatim, tokens, np.array(places, np.int64)) if verbatim else None)
            if verdict:
                rows.append((uid, row, key, item, judged is not None, number, verdict[0], len(tokens), *verdict[1:]))
        columns = zip(*rows, strict=True) if rows else [[]] * 11
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _found(docs: DataFrame, benchmark: DataFrame, sent: int) -> DataFrame:
    """``matches`` with the hash ``row`` of the document's key and text."""
    spark = docs.sparkSession
    items = stored(_items(benchmark), "benchmark-items")
    hashes = items.select("item", "reading", F.inline(F.arrays_zip("h", "size", "at")))
    shapes = [r["size"] for r in hashes.select("size").distinct().collect()]  # 20 at most
    once = hashes.select("h").distinct()
    held = None
    if once.count() <= sent:
        known = np.sort(np.array(once.toArrow().column(0), np.int64).view(np.uint64))
        if not len(known):
            shapes, known = [], np.zeros(1, np.uint64)
        held = spark.sparkContext.broadcast(known)
    hits = _hits(keyed_text(docs).select(_row("doc_id").alias("row"), "doc_id", "text"), shapes, held)
    met = hits.join(hashes, ["h", "size", "reading"])
    each = met.groupBy("uid", "item", "reading").agg(F.first("row").alias("row"), F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("size", "at", "place", "found")).alias("hits"))
    read = each.join(items.select("item", "reading", "item_id", "tokens", "vals", "places"), ["item", "reading"]).mapInArrow(_judged, f"uid long, row string, doc_id long, item string, judged boolean, {FIELDS}")
    # of the readings the best: whole windows, verbatim, the same renaming all over, most of the item
    best = F.max(F.struct("judged", (~F.col("renamed")).alias("same"), "agreement", "covered", *(c for c in ("item_tokens", "slots", "renamed", "row", "doc_id", "item_id")))).alias("m")
    found = read.groupBy("uid", "item").agg(best)
    return found.select("m.row", "m.doc_id", *(f"m.{f.split()[0]}" for f in FIELDS.split(", ")))


def matches(docs: DataFrame, benchmark: DataFrame, sent: int = SENT_HASHES) -> DataFrame:
    """(doc_id, item_id, ...) for every document and item that it contains.

    covered and item_tokens: tokens of the item that matching windows or runs cover,
    and all of them; slots, agreement: placeholders met, and the share of them
    that one renaming explains; renamed: whether any was renamed.  Null and
    empty texts match nothing, nor do items without a word.  Every row is judged
    by its own text: repeated rows match alike, rows or items of one key and
    different texts stay apart, and a null key is a key like others.  Items are
    looked for in two readings, with and without the capitalised words that open
    sentences as names.  An item of
    fewer than WINDOW tokens is found re-parameterised if SHORT_LITERALS of them
    are plain words; any is found verbatim.  ``sent`` decides only where hashes
    that match nothing are dropped, in the scan or in the join.
    """
    return _found(docs, benchmark, sent).drop("row")


def without_matches(docs: DataFrame, benchmark: DataFrame, sent: int = SENT_HASHES) -> DataFrame:
    """The documents that contain no benchmark item, all columns as they are.

    Null and empty texts stay; of rows with one key only those whose own text
    contains an item go.
    """
    name = free_name(docs, "leaked")
    found = stored(_found(docs, benchmark, sent).select(F.col("row").alias(name)).distinct(), "leaked")
    return docs.join(found, _row("doc_id") == F.col(name), "left_anti")
