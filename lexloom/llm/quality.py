"""Quality rules: boosted trees over document statistics.

Counts of a text's words, lines, symbols and repeats, and of marker words and
word beginnings learnt from the labels, feed two constrained tree ensembles, for low quality
and for toxicity.  A text is kept if it passes the base rule and both.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boosting
from .bpe import LETTER, NUMBER, char_classes
from .runtime import WORD_RE, annotated, free_name

SYMBOLS = "#*$%&|<>"
POINTS = ".,;:!?"
BLANK = " \t\n\x0b\x0c\r"
#: Labelled rows that the models are fitted on, at most: those of smallest hash.
LABELLED = 8192
#: A marker occurs in so many positive rows at least, whatever their share, and
#: is this many times as frequent there.
MARKER_ROWS, MARKER_LIFT = 5, 20.0
#: Letters of a word beginning that is a marker, and different words of the
#: positive rows that it begins, at least.
BEGINNING, BEGUN = range(4, 13), 5
#: Statistics, and whether the chance of rejection may only rise (+1) with each.
FEATURES = {
    "words": 0, "word_length": 0, "symbol_share": 1, "dup_line_share": 1, "repeat_share": 1, "stutter_share": 1, "letter_share": -1,
    "number_share": 0, "point_share": 0, "line_words": 0, "distinct_share": 0, "top_share": 0, "markers": 1, "marker_share": 1,
}
#: How the chance of toxicity is boosted: shallow and slow, since most texts
#: differ in one respect, their marker words.
TOXIC_FIT = {"rounds": 60, "depth": 2, "rate": 0.1, "least": 32}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_classes: list[np.ndarray] = []
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """The base counts of a text, exactly as they are defined."""
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            if line in seen:
                dup += 1
            seen.add(line)
    repeat = 0
    if n > 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        if len(set(windows)) < len(windows):
            often = Counter(windows)
            until = 0
            for i, w in enumerate(windows):
                if often[w] > 1:
                    repeat += i + 5 - max(i, until)
                    until = i + 5
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat


@dataclass(frozen=True)
class Markers:
    """Words, and beginnings of words, that set the positive rows apart."""

    words: frozenset[str] = frozenset()
    beginnings: frozenset[str] = frozenset()

    def hits(self, text: str) -> tuple[int, int]:
        """Distinct marker words in a text, and their occurrences."""
        if not self.words and not self.beginnings:
            return 0, 0
        sizes = sorted({len(b) for b in self.beginnings})
        found = [n for w, n in Counter(_LETTERS.findall(text.lower())).items() if w in self.words or any(w[:k] in self.beginnings for k in sizes)]
        return len(found), sum(found)


def statistics(texts: list[str], markers: Markers) -> tuple[np.ndarray, np.ndarray]:
    """Base counts and model features of texts."""
    if not _classes:
        _classes.append(char_classes())
    base = np.zeros((len(texts), len(COUNTS)), np.int64)
    x = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        words = WORD_RE.findall(text)
        n, chars, symbols, dup, repeat = base[i] = counts(text, words)
        if not n:
            continue
        kinds = np.bincount(_classes[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=4)
        freq = Counter(words)
        distinct, total = markers.hits(text)
        lines = text.count("\n") + 1
        stutter = sum(map(str.__eq__, words, words[1:]))
        x[i] = (n, chars / n, symbols / chars, dup / lines, min(1.0, repeat / n), stutter / n, kinds[LETTER] / chars, kinds[NUMBER] / chars,
                sum(map(text.count, POINTS)) / n, n / lines, len(freq) / n, max(freq.values()) / n, distinct, total / n)
    return base, x


@dataclass
class QualityModel:
    """Marker words, and the chance of low quality and of toxicity."""

    markers: Markers
    low: boosting.Trees
    toxic: boosting.Trees

    def rejects(self, x: np.ndarray) -> np.ndarray:
        return (self.low.probability(x) > 0.5) | (self.toxic.probability(x) > 0.5)


def _markers(rows: DataFrame, label: str) -> Markers:
    """Words and word beginnings that set the positive rows apart, however few
    of these they occur in: a language with few labels has markers of its own.
    """
    both = rows.where(F.col(label).isNotNull()).select((F.col(label) > 0).alias("positive"), "text")
    n = both.agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("q")).first()
    if not n["p"] or not n["q"]:
        return Markers()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for positive, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = sorted(w for w in set(_LETTERS.findall(text.lower())) if len(w) >= 3)
                begun = Counter(w[:k] for w in words for k in BEGINNING if k < len(w))
                size = len(words) + len(begun)
                columns = [positive] * size, words + list(begun), [True] * len(words) + [False] * len(begun), [1] * len(words) + list(begun.values())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.string(), pa.bool_(), pa.int64()), strict=True)], ["positive", "part", "whole", "n"])

    def lift(p: str, q: str, of_p: int, of_q: int) -> Column:
        return ((F.col(p) + 0.5) / (of_p + 1)) / ((F.col(q) + 0.5) / (of_q + 1))

    clean = ~F.col("positive")
    each = both.mapInArrow(parts, "positive boolean, part string, whole boolean, n long").groupBy("part", "whole").agg(
        F.count_if("positive").alias("p"), F.count_if(clean).alias("q"), F.sum(F.when(F.col("positive"), F.col("n")).otherwise(0)).alias("np"), F.sum(F.when(clean, F.col("n")).otherwise(0)).alias("nq")
    ).cache()
    words = each.where((F.col("p") >= MARKER_ROWS) & F.col("whole") & (lift("p", "q", n["p"], n["q"]) >= MARKER_LIFT))
    # a beginning is met by chance in long texts: what counts is how many of a text's words it begins
    of = each.where("whole").agg(F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("q"), F.lit(0)).alias("q")).first()
    some = F.transform(F.sequence(F.lit(BEGINNING[0]), F.least(F.lit(BEGINNING[-1]), F.length("part") - 1)), lambda k: F.substring("part", F.lit(1), k))
    begun = each.where((F.col("p") > 0) & F.col("whole") & (F.length("part") > BEGINNING[0])).select(F.explode(some).alias("part")).groupBy("part").count().where(F.col("count") >= BEGUN)
    beginnings = each.where((F.col("p") >= MARKER_ROWS) & ~F.col("whole") & (lift("np", "nq", of["p"], of["q"]) >= MARKER_LIFT)).join(begun, "part", "left_semi")
    found = Markers(frozenset(r["part"] for r in words.select("part").collect()), frozenset(r["part"] for r in beginnings.select("part").collect()))
    each.unpersist()
    return found


def fit(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> QualityModel:
    """Fit on at most ``sample`` labelled documents, those of smallest hash.

    A document labelled more than once counts as its worst labels, one with
    several texts as the smallest; so the same rows give the same model in any
    order.  Null labels and labels without a document teach nothing.  Without
    labels nothing but the base rule rejects.
    """
    each = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    once = text.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality", "toxic").agg(F.min("text").alias("text"))
    rows = once.select("text", (1 - F.col("quality")).alias("low"), "toxic").cache()
    markers = _markers(rows, "toxic")

    def features(batches):
        for batch in batches:
            x = statistics(batch.column(0).to_pylist(), markers)[1]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "low", "toxic"])

    got = rows.select("text", F.col("low").cast("int"), F.col("toxic").cast("int")).mapInArrow(features, "x array<double>, low int, toxic int").toArrow()
    rows.unpersist()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    ys = [np.array([-1 if v is None else int(v > 0) for v in got[label].to_pylist()], int) for label in ("low", "toxic")]
    order = np.lexsort((*ys, *x.T))
    signs = np.array(list(FEATURES.values()))
    models = []
    for y, how in zip(ys, ({}, TOXIC_FIT), strict=True):
        there = order[y[order] >= 0]
        models.append(boosting.fit(x[there], y[there].astype(float), signs, **how))
    return QualityModel(markers, *models)


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> tuple[DataFrame, str]:
    """Every document with a struct of its counts and verdict; the struct's name.

    A null or empty text has no words and fails the base rule; all other columns
    and repeated rows pass as they are.
    """
    names = [*COUNTS, "base_failed", "kept"]
    kind = T.StructType([T.StructField(n, T.BooleanType() if n in names[-2:] else T.LongType()) for n in names])

    def verdict(texts: list[str]) -> pa.Array:
        base, x = statistics(texts, model.markers)
        failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
        kept = ~failed
        if len(texts):
            kept &= ~model.rejects(x)
        return pa.StructArray.from_arrays([*(pa.array(c) for c in base.T), pa.array(failed), pa.array(kept)], names)

    name = free_name(docs, "quality_rules")
    return annotated(docs, text, verdict, name, kind), name
