"""Alignment of two tokenizers' tokens of the same text.

Python only tokenises: a row then has the ids and the byte offsets of token ends
of either side.  Groups, links and their counts over the corpus come from
Spark's array functions and aggregates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, found
from .runtime import free_name, keyed_text, portions, release, stored

#: A blank on both sides of which is no white space: no token of either side reaches over it.
_GAP = re.compile(r"(?<=\S) (?=\S)")
#: Pieces that a worker remembers, and tokens in them, at most.
PIECES, PIECE_TOKENS = 1 << 18, 1 << 23
#: Counted pairs that are sent to every task, at most; more are joined by a shuffle.
SENT_PAIRS = 1 << 18
#: A link is one number: the first side's id times this, plus the second's.
SIDE = 1 << 24


class Pieces:
    """Both tokenizations of pieces of text, remembered.

    A text is cut at single blanks between other characters, where either
    tokenizer starts anew; a vocabulary with a token over such a blank is refused.
    """

    def __init__(self, bytes_vocabulary: str, piece_model: str):
        import sentencepiece

        vocabulary = Vocabulary(bytes_vocabulary)
        self._first, self._json, self._slow = vocabulary.encoder(), bytes_vocabulary, None
        self._second = sentencepiece.SentencePieceProcessor(model_file=found(piece_model))
        names = [self._second.id_to_piece(i) for i in range(len(self._second))]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a token of the second vocabulary reaches over a blank")
        plain = [bytes([int(n[3:5], 16)]) if self._second.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.bytes = (vocabulary.bytes_of, dict(enumerate(plain)))
        self.width = tuple(self._widths(b) for b in self.bytes)
        self._forget()

    @staticmethod
    def _widths(tokens: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(tokens) + 1, np.int32)
        for i, b in tokens.items():
            out[i] = len(b)
        return out

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.held = [np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)]
        self.begin = [np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)]
        self.count = [np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)]
        self.same = np.zeros(1 << 12, bool)
        self.used = [0, 0]

    def _first_ids(self, text: str) -> list[int]:
        try:
            return self._first.encode_ordinary(text)
        except BaseException as e:
            if type(e).__name__ != "PanicException":  # derives from BaseException alone
                raise
            if self._slow is None:
                from tokenizers import Tokenizer

                self._slow = Tokenizer.from_file(found(self._json))
                self._slow.encode_special_tokens = True
            return self._slow.encode(text, add_special_tokens=False).ids

    def _second_ids(self, pieces: list[str]) -> list[list[int]]:
        return self._second.encode(pieces, num_threads=1)

    def slots(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; unknown ones are tokenised."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.slot]
        if len(self.slot) + len(new) > PIECES or max(self.used) > PIECE_TOKENS:
            self._forget()
            new = list(dict.fromkeys(pieces))
        sides = ([self._first_ids(" " + p) for p in new], self._second_ids(new))
        at, now = len(self.slot), len(self.slot) + len(new)
        self.slot.update(zip(new, range(at, now), strict=True))
        self.same = _room(self.same, now)
        self.same[at:now] = self._given_back(new, sides)
        for k, lists in enumerate(sides):
            n = np.fromiter(map(len, lists), np.int64, len(new))
            end = self.used[k] + int(n.sum())
            self.held[k], self.begin[k], self.count[k] = _room(self.held[k], end), _room(self.begin[k], now), _room(self.count[k], now)
            self.begin[k][at:now] = self.used[k] + np.cumsum(n) - n
            self.count[k][at:now] = n
            self.held[k][self.used[k] : end] = np.fromiter(chain.from_iterable(lists), np.int32, end - self.used[k])
            self.used[k] = end
        return np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))

    def _given_back(self, pieces: list[str], sides: tuple[list[list[int]], ...]) -> np.ndarray:
        """Whether the bytes of a piece's tokens are its blank and itself, on either side."""
        whole = [(" " + p).encode("utf-8", "surrogatepass") for p in pieces]
        same = np.ones(len(pieces), bool)
        for tokens, lists in zip(self.bytes, sides, strict=True):
            parts = [b"".join(map(tokens.__getitem__, ids)) for ids in lists]
            if parts != whole:
                same &= [p == w for p, w in zip(parts, whole, strict=True)]
        return same

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each side: number of tokens of each text, ids, and end offsets in
        the bytes of its blank and text; texts that some side doesn't give back
        byte by byte have no tokens."""
        cut = [_GAP.split(t) if t else [] for t in texts]
        slots = self.slots([p for c in cut for p in c])
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        good = np.bincount(owner[~self.same[slots]], minlength=len(texts)) == 0
        kept = good[owner]
        slots, owner = slots[kept], owner[kept]
        out = []
        for k in range(2):
            n = self.count[k][slots]
            place = np.arange(int(n.sum())) + np.repeat(self.begin[k][slots] - (np.cumsum(n) - n), n)
            ids = self.held[k][place]
            tokens = np.bincount(owner, n, len(texts)).astype(np.int64)
            ends = np.cumsum(self.width[k][ids], dtype=np.int64)
            before = np.concatenate([[0], ends])[np.cumsum(tokens) - tokens]
            out.append((tokens, ids, (ends - np.repeat(before, tokens)).astype(np.int32)))
        return out


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` values."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


_known: dict[tuple[str, str], Pieces] = {}


def tokenised(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a_ids, a_ends, b_ids, b_ends) of every row, in one narrow pass.

    ``first`` is a byte-level BPE file, ``second`` a sentencepiece model that adds
    a blank; both encode the blank and the text, special strings as plain text.
    Ends are offsets in bytes.  A null or empty text, or one that either side
    doesn't give back byte by byte, has empty arrays; repeated rows stay; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (first, second) not in _known:
            _known[first, second] = Pieces(first, second)
        known = _known[first, second]
        for whole in batches:
            for batch in portions(whole, 1):
                columns = [batch.column(0)]
                for tokens, ids, ends in known.encode(batch.column(1).to_pylist()):
                    offsets = pa.array(np.concatenate([[0], np.cumsum(tokens)]), pa.int32())
                    columns += [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, ends)]
                yield pa.RecordBatch.from_arrays(columns, [key, "a_ids", "a_ends", "b_ids", "b_ends"])
            release()

    return keyed_text(docs, key, text).mapInArrow(run, f"`{key}` long, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>")


def aligned(tokens: DataFrame) -> DataFrame:
    """``tokens`` with two more columns, in place of any of their names.

    groups: for each stretch between byte offsets at which both sides end a
    token, ``a1,a2|b1`` with the ids in order; links: every pair of tokens whose
    bytes overlap, as ``a * SIDE + b``, once for each occurrence.  Rows without
    tokens have empty arrays.  Only array functions; linear in the tokens but
    for one sort.  Steps are columns of their own: what a lambda returns is copied.
    """
    names = {}
    for name in ("merged", "shared", "packed", "a", "b", "s", "t"):
        names[name] = free_name(tokens, name)
    col = lambda name: F.col(f"`{names[name]}`")
    # end, side and place from 1 of each token in one number; at a common end the first side comes first
    keys = lambda ends, side: F.transform(ends, lambda e, i: F.shiftleft(e.cast("long"), 33).bitwiseOR((i + F.lit((side << 32) + 1)).cast("long")))
    merged = F.sort_array(F.concat(keys("a_ends", 0), keys("b_ends", 1)))
    end = lambda k: F.shiftright(k, 33)
    place = lambda k: k.bitwiseAND(F.lit((1 << 32) - 1))
    second = lambda k: F.shiftright(k, 32).bitwiseAND(F.lit(1)) == 1
    # ids and their texts by the same places
    number = lambda ids: F.concat(F.array(F.lit(-1).cast("long")), F.col(ids).cast("array<long>"))
    named = lambda ids: F.concat(F.array(F.lit("")), F.col(ids).cast("array<string>"))
    m, shared, packed, a, b, s, t = map(col, names)
    ties = F.filter(m, lambda k, p: F.when(second(k), end(F.get(m, p - 1)) == end(k)).otherwise(F.coalesce(end(F.get(m, p + 1)) == end(k), F.lit(False))))
    # the places of the last tokens of each group in one number, after that of no tokens
    places = F.transform(F.sequence(F.lit(1), F.size(F.array_intersect("a_ends", "b_ends"))), lambda g: F.shiftleft(place(shared[2 * g - 2]), 32).bitwiseOR(place(shared[2 * g - 1])))
    nothing = F.array(F.lit(0).cast("long"))

    def whole(names: Column, q: Column, r: Column) -> Column:
        return F.array_join(F.slice(names, q.cast("int") + 2, (r - q).cast("int")), ",")

    def text(q: Column, r: Column) -> Column:
        """Of the group of the tokens after places q up to places r."""
        i, j, x, y = F.shiftright(q, 32), place(q), F.shiftright(r, 32), place(r)
        simple = F.concat(s[x], F.lit("|"), t[y])
        return F.when(r - q == (1 << 32) + 1, simple).otherwise(F.concat(whole(s, i, x), F.lit("|"), whole(t, j, y)))

    def links(q: Column, r: Column) -> Column:
        """Of that group: every token but the last begins an overlap with the
        other side's next one."""
        i, j, x, y = F.shiftright(q, 32), place(q), F.shiftright(r, 32), place(r)
        link = lambda k, p, o: F.when(second(k), a[o] * SIDE + b[p]).otherwise(a[p] * SIDE + b[o])
        several = F.transform(F.slice(m, (i + j).cast("int") + 1, (x - i + y - j).cast("int") - 1), lambda k, n: link(k, place(k), i + j + n + 2 - place(k)))
        return F.when(r - q == (1 << 32) + 1, F.array(a[x] * SIDE + b[y])).otherwise(several)

    there = F.size("a_ids") > 0
    by_group = lambda body: F.zip_with(F.slice(packed, 1, F.size(packed) - 1), F.slice(packed, 2, F.size(packed) - 1), body)
    return (
        tokens.withColumns({names["merged"]: merged, names["a"]: number("a_ids"), names["b"]: number("b_ids"), names["s"]: named("a_ids"), names["t"]: named("b_ids")})
        .withColumn(names["shared"], ties)
        .withColumn(names["packed"], F.when(there, F.concat(nothing, places)).otherwise(nothing))
        .withColumns({"groups": by_group(text), "links": F.flatten(by_group(links))})
        .drop(*names.values())
    )


def pair_counts(links: DataFrame, column: str = "links") -> DataFrame:
    """(link, n, best) of every linked id pair.

    n: how many rows hold it; best: whether no pair of its first id has more.
    """
    counted = stored(links.select(F.explode(F.array_distinct(column)).alias("link")).groupBy("link").agg(F.count("*").alias("n")), "pairs")
    first = F.floor(F.col("link") / SIDE).cast("long")
    most = counted.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return stored(counted.join(most, first == F.col("a")).select("link", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def summary(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: sizes, digest of the groups, and how its
    links stand in the corpus.

    key, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest
    of their first id, ties included), count_sum (of all links), groups_sha256
    ('' without tokens).  Repeated rows and rows without a key stay; other
    columns are ignored; an empty table gives an empty one.
    """
    rows = aligned(tokenised(docs, first, second, key, text))
    size = lambda c: F.size(c).cast("long")
    digest = F.when(F.size("a_ids") > 0, F.sha2(F.array_join("groups", ";"), 256)).otherwise("")
    # links in order, which stores well
    sizes = rows.select(key, size("a_ids").alias("n_a"), size("b_ids").alias("n_b"), size("groups").alias("n_groups"), size("links").alias("n_links"), digest.alias("groups_sha256"), F.sort_array("links").alias("links"))
    kept = stored(sizes.withColumn("row", F.monotonically_increasing_id()), "alignments")
    pairs = pair_counts(kept)
    if pairs.count() <= SENT_PAIRS:
        pairs = F.broadcast(pairs)
    found_ = kept.select("row", F.explode("links").alias("link")).join(pairs, "link")
    stands = found_.groupBy("row").agg(F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return kept.drop("links").join(stands, "row", "left").select(key, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
