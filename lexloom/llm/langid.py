"""Language identification by cross-parsing entropy.

A suffix automaton holds the substrings of some text of each language.  A text
is parsed, for each language, into the longest phrases that occur there.  A
longest match grows with the logarithm of the sample that it is looked for in,
so phrases are normalised: their number times that logarithm, over the length of
the text, estimates the cross entropy, and the language of the least wins.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import LETTER, char_classes
from .runtime import annotated, by_crc, free_name, slices, stored

#: Documents that a language's text is taken from, its characters, and languages
#: that are learnt, those of most documents, at most.
SAMPLE_DOCS, SAMPLE_CHARS, LANGUAGES = 64, 16384, 256
#: Characters that a lane parses; the next one goes on from the state it ends in,
#: which a run-up of so many characters before mostly finds beforehand.
LANE, RUN_UP = 1024, 64
#: Times that lanes run again before all states are tried.
REPAIRS = 2
BATCH = 2 << 20
UNKNOWN = "und"
_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Flags of letters, and simple lower case, by code point."""
    if not _tables:
        is_letter = char_classes() == LETTER
        lower = np.arange(0x110000, dtype=np.int32)
        for c in np.flatnonzero(is_letter):
            low = chr(c).lower()
            if len(low) == 1:
                lower[c] = ord(low)
        _tables.append((is_letter, lower))
    return _tables[0]


def normal(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts, end to end, with one space for each gap
    between them, and the length of each text in that form."""
    is_letter, lower = _letters()
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = is_letter[points]
    new = np.ones(len(points), bool)
    new[1:] = owner[1:] != owner[:-1]
    keep = letter.copy()
    keep[1:] |= ~letter[1:] & letter[:-1] & ~new[1:]
    out = np.where(letter, lower[points], 0x20)[keep]
    return out, np.bincount(owner[keep], minlength=len(texts))


class SuffixAutomaton:
    """All substrings of a sequence of numbers; state 0 is the empty one.

    source, symbol, target: its arcs; their number grows with the sequence, not
    with its alphabet.
    """

    def __init__(self, codes: list[int]):
        jumps: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in codes:
            now = len(jumps)
            jumps.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in jumps[p]:
                jumps[p][c] = now
                p = link[p]
            if p >= 0:
                q = jumps[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    copy = len(jumps)
                    jumps.append(dict(jumps[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and jumps[p].get(c) == q:
                        jumps[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now
        self.states = len(jumps)
        arcs = [(s, c, t) for s, out in enumerate(jumps) for c, t in out.items()]
        self.source, self.symbol, self.target = (np.array(x, np.int64) for x in zip(*arcs, strict=True)) if arcs else (np.zeros(0, np.int64),) * 3


class Arcs:
    """(state, symbol) -> state for many pairs at once: open addressing with a
    quarter of the slots filled."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray):
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.targets = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[slot[won]], self.targets[slot[won]] = keys[won], targets[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            left = left[lost[left]]
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Target of each key, -1 where there is none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.targets[slot], -1).astype(np.int64)
        odd = np.flatnonzero((held != keys) & (held >= 0))
        at = slot[odd]
        while len(odd):
            at = (at + 1) & (len(self.keys) - 1)
            held = self.keys[at]
            hit = held == keys[odd]
            out[odd[hit]] = self.targets[at[hit]]
            more = ~hit & (held >= 0)
            odd, at = odd[more], at[more]
        return out


@dataclass
class LanguageModel:
    """Sample text of each language; the automata are built where they are used."""

    samples: dict[str, str]

    @property
    def key(self) -> str:
        return hashlib.sha1(repr(sorted(self.samples.items())).encode()).hexdigest()

    @cached_property
    def languages(self) -> list[str]:
        return sorted(self.samples)

    @cached_property
    def automata(self) -> tuple[np.ndarray, int, Arcs, np.ndarray, np.ndarray]:
        """Code of each code point (0: in no sample), number of codes, the arcs of
        all languages, the root of each, and the logarithm of each sample's size."""
        forms = [normal([self.samples[x]])[0] for x in self.languages]
        alphabet = np.unique(np.concatenate(forms))
        code = np.zeros(0x110000, np.int32)
        code[alphabet] = np.arange(1, len(alphabet) + 1)
        width = len(alphabet) + 1
        keys, targets, roots, at = [], [], [], 0
        for form in forms:
            made = SuffixAutomaton(code[form].tolist())
            keys.append((made.source + at) * width + made.symbol)
            targets.append(made.target + at)
            roots.append(at)
            at += made.states
        weights = np.log2([max(2, len(f)) for f in forms])
        return code, width, Arcs(np.concatenate(keys), np.concatenate(targets)), np.array(roots, np.int64), weights

    def _parse(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each lane, and the state that it is left in, for
        every language.  state: that in which each lane is entered."""
        _, width, arcs, roots, _ = self.automata
        order = np.argsort(-size, kind="stable")
        start, length = begin[order], size[order]
        state, count = state[order].copy(), np.zeros((len(order), len(roots)), np.int64)
        for step in range(int(length[0]) if len(length) else 0):
            lanes = int(np.searchsorted(-length, -step, "left"))
            c = codes[start[:lanes] + step][:, None]
            now = state[:lanes]
            after = arcs.find((now * width + c).ravel()).reshape(now.shape)
            row, lang = np.nonzero(after < 0)
            if len(row):
                # a phrase ends; the next one starts with this character
                root = roots[lang]
                fresh = arcs.find(root * width + c[row, 0])
                count[row, lang] += (now[row, lang] != root).astype(np.int64) + (fresh < 0)
                after[row, lang] = np.where(fresh < 0, root, fresh)
            state[:lanes] = after
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return count[back], state[back]

    def _maps(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States in which each lane may be entered, and from each its phrases and
        the state that it is left in: (lanes, states, languages), padded.

        A lane is entered in the state of a phrase that began up to ``RUN_UP``
        characters before it, or else earlier.
        """
        lanes, roots = len(begin), self.automata[3]
        back = np.tile(np.arange(1, RUN_UP + 1), lanes)
        _, states = self._parse(codes, np.repeat(begin, RUN_UP) - back, back, np.repeat(roots[None, :], lanes * RUN_UP, 0))
        states = np.sort(states.reshape(lanes, RUN_UP, -1), 1)
        new = np.ones(states.shape, bool)
        new[:, 1:] = states[:, 1:] != states[:, :-1]
        rank = np.cumsum(new, 1) - 1
        entry = np.repeat(states[:, :1], int(rank.max()) + 1, 1)
        lane, _, lang = np.indices(states.shape, sparse=True)
        entry[lane, rank, lang] = states
        width = entry.shape[1]
        count, left = self._parse(codes, np.repeat(begin, width), np.repeat(size, width), entry.reshape(lanes * width, -1))
        return entry, count.reshape(entry.shape), left.reshape(entry.shape)

    def _settle(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, lanes: np.ndarray, nth: np.ndarray, count: np.ndarray, left: np.ndarray) -> None:
        """Put right ``count`` and ``left`` of all lanes of some texts: the lanes'
        maps, composed from each text's first lane on."""
        langs = np.arange(left.shape[1])
        later = lanes[nth[lanes] > 0]
        for part in np.array_split(later, -(-len(later) * RUN_UP * len(langs) >> 22) or 1):
            entry, counts, exits = self._maps(codes, begin[part], size[part])
            for k, lane in enumerate(part.tolist()):
                same = entry[k] == left[lane - 1]
                if same.any(0).all():
                    at = same.argmax(0)
                    count[lane], left[lane] = counts[k, at, langs], exits[k, at, langs]
                else:
                    (count[lane],), (left[lane],) = self._parse(codes, begin[lane : lane + 1], size[lane : lane + 1], left[lane - 1][None])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that each language needs for each text, and the texts' lengths.

        A long text goes in lanes that run at once; a lane that the one before
        leaves in another state than it was entered in runs again.  Where that
        doesn't settle, as in repetitive text, lanes run from all states that
        they may be entered in.
        """
        code, _, _, roots, _ = self.automata
        points, lengths = normal(texts)
        codes = code[points].astype(np.int64)
        first = np.cumsum(lengths) - lengths
        lanes = -(-lengths // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = first[owner] + nth * LANE
        size = np.minimum(LANE, first[owner] + lengths[owner] - begin)
        entry = np.repeat(roots[None, :], len(owner), 0)
        later = np.flatnonzero(nth > 0)
        if len(later):
            _, entry[later] = self._parse(codes, begin[later] - RUN_UP, np.full(len(later), RUN_UP), entry[later])
        count, left = self._parse(codes, begin, size, entry)
        for _ in range(REPAIRS):
            wrong = later[(left[later - 1] != entry[later]).any(1)]
            entry[wrong] = left[wrong - 1]
            count[wrong], left[wrong] = self._parse(codes, begin[wrong], size[wrong], entry[wrong])
        wrong = later[(left[later - 1] != entry[later]).any(1)]
        if len(wrong):
            self._settle(codes, begin, size, np.flatnonzero(np.isin(owner, owner[wrong])), nth, count, left)
        final = np.ones(len(owner), bool)
        final[:-1] = owner[1:] != owner[:-1]
        count += (left != roots) & final[:, None]
        out = np.zeros((len(texts), len(roots)))
        np.add.at(out, owner, count)
        return out, lengths

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` with 0 without a letter."""
        if not self.samples:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        need, lengths = np.zeros((len(texts), len(self.samples))), np.zeros(len(texts), np.int64)
        for a, b in slices([len(t) for t in texts], BATCH):
            need[a:b], lengths[a:b] = self.phrases(texts[a:b])
        rate = need * self.automata[4] / np.maximum(lengths, 1)[:, None]
        best = np.argmin(rate, 1) if len(texts) else np.zeros(0, int)
        rows = np.arange(len(texts))
        least = rate[rows, best]
        others = rate.copy()
        others[rows, best] = np.inf
        second = others.min(1) if rate.shape[1] > 1 else np.where(lengths > 0, 1.0, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(lengths > 0, np.clip(1 - least / second, 0, 1), 0.0)
        return [self.languages[k] if n else UNKNOWN for k, n in zip(best, lengths, strict=True)], np.nan_to_num(score)


_models: dict[str, LanguageModel] = {}


def equal_shares(sizes: list[int], total: int) -> list[int]:
    """Parts of at most ``sizes`` that sum to ``total`` if they can, as equal as
    they can be."""
    out = [0] * len(sizes)
    for rank, i in enumerate(sorted(range(len(sizes)), key=lambda i: (sizes[i], i))):
        out[i] = min(sizes[i], total // (len(sizes) - rank))
        total -= out[i]
    return out


def fit(docs: DataFrame, held_out: Column | None = None) -> LanguageModel:
    """Take sample text of every language from documents with text and lang.

    Bounded: the ``LANGUAGES`` languages of most documents, of each the
    ``SAMPLE_DOCS`` documents of smallest hash, and of those equal shares of
    ``SAMPLE_CHARS`` characters; a shorter document leaves its share to others.
    Shares follow from lengths, so that no more than them reaches the driver.
    Nulls in text, lang or doc_id teach nothing; of rows with one doc_id and
    lang the smallest text counts.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if held_out is not None:
        known = known.where(~held_out)
    common = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    some = known.select("doc_id", "lang").join(F.broadcast(common), "lang").withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS)
    picked = some.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank"))
    rows = known.select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text")).join(F.broadcast(picked), ["doc_id", "lang"])
    chosen = stored(rows.groupBy("lang", "rank").agg(F.min("text").alias("text")), "samples")
    lengths: dict[str, list[tuple[int, int]]] = {}
    for r in chosen.select("lang", "rank", F.length("text").alias("n")).orderBy("lang", "rank").collect():
        lengths.setdefault(r["lang"], []).append((r["rank"], r["n"]))
    shares = [(lang, rank, share) for lang, each in lengths.items() for (rank, _), share in zip(each, equal_shares([n for _, n in each], SAMPLE_CHARS), strict=True)]
    if not shares:
        return LanguageModel({})
    cut = chosen.join(F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, rank int, share int")), ["lang", "rank"])
    texts: dict[str, list[str]] = {}
    for r in cut.select("lang", "rank", F.expr("substring(text, 1, share)").alias("text")).orderBy("lang", "rank").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return LanguageModel({lang: " ".join(each) for lang, each in texts.items()})


def held_out() -> Column:
    """The documents that nothing is learnt from."""
    return F.coalesce(by_crc("doc_id", 4) == 2, F.lit(False))


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> tuple[DataFrame, str]:
    """Every document with a struct (lang_pred, score); the struct's name.

    Null texts and texts without a letter are ``und`` with score 0; so is every
    text if no language was learnt.  Languages of equal cross entropy go by
    their name.  All other columns and repeated rows pass as they are.
    """
    key = model.key

    def predict(texts: list[str]) -> pa.Array:
        if key not in _models:
            _models.clear()
            _models[key] = model
        langs, score = _models[key].predict(texts)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score)], ["lang_pred", "score"])

    name = free_name(docs, "language")
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return annotated(docs, text, predict, name, kind), name
