"""Scoring texts with a weighted backoff automaton of word n-grams.

States are contexts of at most ORDER - 1 words that training has seen.  A state
has an arc for every word that training has seen after it, weighted with the
smoothed log-probability, and a failure arc to its longest proper suffix that is
a state, weighted with what the smoothing leaves for other words.  A text is
scored in one left-to-right pass that carries the state: where a state has no
arc for the word, failure arcs are taken, at the root at last the arc of all
words that are not known.  Every state shares out a probability of one.

Counts never meet on one machine (see ``exchange``): each block of documents asks
for the counts of its own n-grams and compiles the part of the automaton that
its texts can reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import text_bytes, totals, with_counts
from .runtime import by_crc, keyed_text, slices
from .shingles import mix, word_hashes

#: Words of an n-gram at most.
ORDER = 3
BATCH = 1 << 20
#: Pseudo-counts of the failure arcs of contexts of one and of two words, and
#: discount of a word.
PRIORS, DISCOUNT = (300.0, 20.0), 0.75
#: Tokens that a lane of the traversal scores.
LANE = 256
#: Hash of the end of a text; the start shares its count, one for each text.
END = np.uint64(0x8AE5D3A1C4F0B297)
START = np.uint64(0x3C6EF372FE94F82B)
_ODD = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of the texts, ends included, and tokens of each."""
    made = [word_hashes(texts[a:b]) for a, b in slices([len(t) for t in texts], BATCH)]
    hashes, words = (np.concatenate([m[k] for m in made]) if made else np.zeros(0, t) for k, t in ((0, np.uint64), (1, np.int64)))
    close = np.cumsum(words + 1) - 1
    ids = np.empty(len(hashes) + len(words), np.uint64)
    is_end = np.zeros(len(ids), bool)
    is_end[close] = True
    ids[~is_end], ids[is_end] = hashes, END
    return ids, words + 1


def _grams(ids: np.ndarray, sizes: np.ndarray, bits: int = 64) -> list[np.ndarray]:
    """Hash of the n-gram of each order that ends at each token, of ``bits`` bits
    where it has several words; START fills up what is before a text."""
    first = np.cumsum(sizes) - sizes
    out = [ids]
    total = mix(ids) * _ODD[0]
    before = ids
    for k in range(1, ORDER):
        before = np.concatenate([[START], before[:-1]]).astype(np.uint64)
        before[first] = START
        total = total + mix(before) * _ODD[k]
        out.append(mix(total + np.uint64(k)) >> np.uint64(64 - bits) << np.uint64(64 - bits))
    return out


class Automaton:
    """The arcs and failure arcs that some texts can reach.

    words: hashes of their tokens, sorted, with training counts; pairs: for each
    different one its words' numbers, triples: for each the numbers of the pairs
    that it starts and ends with, both with training counts.  State 0 is the root; the number of a word that isn't there is len(words).
    """

    def __init__(self, words: np.ndarray, count: np.ndarray, pairs: np.ndarray, pair_count: np.ndarray, triples: np.ndarray, triple_count: np.ndarray, total: int, kinds: int):
        self.width = width = len(words) + 1  # START has the number len(words)
        count = count.astype(float)
        ends = int(np.searchsorted(words, END))
        starts = count[ends] if ends < len(words) and words[ends] == END else 0.0
        self.unknown = float(np.log(DISCOUNT * kinds / total)) if total else 0.0
        seen = np.flatnonzero(count > 0)
        context = np.append(count, starts)
        known = np.append(count > 0, starts > 0)
        if ends < len(words) and words[ends] == END:
            known[ends] = False  # nothing follows an end
        # states: the root, words, pairs
        self.state_of = np.zeros(width, np.int64)
        self.state_of[known] = 1 + np.arange(known.sum())
        made = 1 + int(known.sum())
        some = pair_count > 0
        renumbered = np.cumsum(some) - 1
        last_pair = pairs[triples[:, 1]]
        pairs, pair_count = pairs[some], pair_count[some].astype(float)
        inner = pairs[:, 1] != (ends if ends < len(words) and words[ends] == END else -1)
        pair_state = np.where(inner, made + np.cumsum(inner) - 1, 0)
        some = (triple_count > 0) & (last_pair[:, 0] < len(words))  # the start is one word of context
        (left, right), triple_count = renumbered[triples[some]].T, triple_count[some].astype(float)
        # weights, lower orders first
        low = np.log(np.maximum(count[seen] - DISCOUNT, 1e-300) / max(total, 1))
        unigram = np.zeros(len(words))
        unigram[seen] = low
        of = context[pairs[:, 0]]
        second = np.log(pair_count + PRIORS[0] * np.exp(unigram[pairs[:, 1]])) - np.log(of + PRIORS[0])
        third = np.log(triple_count + PRIORS[1] * np.exp(second[right])) - np.log(pair_count[left] + PRIORS[1])
        # arcs, sorted by state and word
        arcs = np.concatenate([seen, self.state_of[pairs[:, 0]] * width + pairs[:, 1], pair_state[left] * width + pairs[right, 1]])
        target = np.concatenate([self.state_of[seen], pair_state, pair_state[right]])
        weight = np.concatenate([low, second, third])
        order = np.argsort(arcs)
        self.arc, self.target, self.weight = arcs[order], target[order], weight[order]
        # failure arcs
        self.fail = np.zeros(made + int(inner.sum()), np.int64)
        self.fall = np.zeros(len(self.fail))
        self.fall[self.state_of[known]] = np.log(PRIORS[0]) - np.log(context[known] + PRIORS[0])
        self.fail[pair_state[inner]] = self.state_of[pairs[inner, 1]]
        self.fall[pair_state[inner]] = np.log(PRIORS[1]) - np.log(pair_count[inner] + PRIORS[1])

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after reading a word in each of ``state``, and log-probabilities."""
        state, gained = state.copy(), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            now, read = state[open_], word[open_]
            key = now * self.width + read
            at = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1) if len(self.arc) else np.zeros(len(key), np.int64)
            hit = self.arc[at] == key if len(self.arc) else np.zeros(len(key), bool)
            done, at = open_[hit], at[hit]
            gained[done] += self.weight[at]
            state[done] = self.target[at]
            root = open_[~hit & (now == 0)]
            gained[root] += self.unknown
            open_ = open_[~hit & (now != 0)]
            gained[open_] += self.fall[state[open_]]
            state[open_] = self.fail[state[open_]]
        return state, gained

    def score(self, code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Natural log-probability of each text, whose tokens have the numbers
        ``code``.  Long texts go in lanes: a lane's first state is that which
        the two tokens before it lead to."""
        first = np.cumsum(sizes) - sizes
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = first[owner] + nth * LANE
        length = np.minimum(LANE, first[owner] + sizes[owner] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, owner, nth = begin[order], length[order], owner[order], nth[order]
        state = np.where(nth == 0, self.state_of[-1], 0)
        later = np.flatnonzero(nth > 0)
        for back in range(ORDER - 1, 0, -1):
            state[later], _ = self.step(state[later], code[begin[later] - back])
        total = np.zeros(len(begin))
        for k in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -k, "left"))
            state[:live], gained = self.step(state[:live], code[begin[:live] + k])
            total[:live] += gained
        return np.bincount(owner, total, len(sizes))


def _score_block(texts: list[str], counts: list[np.ndarray], total: int, kinds: int, bits: int = 64):
    """Known flags of each text's tokens, base scores and model scores."""
    ids, sizes = _tokens(texts)
    grams = _grams(ids, sizes, bits)
    words, code = np.unique(ids, return_inverse=True)
    before = np.concatenate([[len(words)], code[:-1]])
    before[np.cumsum(sizes) - sizes] = len(words)
    _, at, pair = np.unique(grams[1], return_index=True, return_inverse=True)
    pairs = np.stack([before[at], code[at]], 1)
    at = np.unique(grams[2], return_index=True)[1]
    triples = np.stack([pair[at - 1], pair[at]], 1)  # where two starts come first, nothing is asked of the former
    owner = np.repeat(np.arange(len(texts)), sizes)
    c = counts[0].astype(float)[code]
    base = np.bincount(owner, np.log10((c + 0.1) / (total + 0.1 * (kinds + 1))), len(texts))
    known = np.bincount(owner, c > 0, len(texts)).astype(np.int64)
    model = Automaton(words, counts[0], pairs, counts[1], triples, counts[2], total, kinds).score(code, sizes)
    return sizes, known, base, model / np.log(10)


def _hash_bits(size: int) -> int:
    """Bits by which n-grams of several words are told apart, for so many bytes
    of text: an n-gram that training has not seen is taken for one that it has
    with a chance below 2**-20."""
    return min(64, max(32, size.bit_length() + 20))


def scores(docs: DataFrame, learn, key: str = "doc_id") -> DataFrame:
    """(doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score).

    learn: condition on the key for the documents that the model learns from.
    Words have A-Z lower-cased; a text's tokens are its words and one end, so a
    null or empty text is the end alone.  base_score is the additive unigram
    score; without anything to learn from V = N = 0, and every word is the
    unknown one, of probability one.  Repeated rows give repeated rows; a null
    key is a key like others; other columns are ignored.  Words are told apart by
    whole 64-bit hashes, n-grams as ``_hash_bits`` says.
    """
    plain = keyed_text(docs, key).select(F.col(key).alias("key"), "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    size = text_bytes(plain, "text")
    bits = _hash_bits(size)

    def counted(block: pa.Table, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        ids, sizes = _tokens(block.column("text").to_pylist())
        teach = np.repeat(block.column("learn").to_numpy(), sizes)
        made = [np.unique(every, return_inverse=True) for every in _grams(ids, sizes, bits)[:most]]
        return [(unique, np.bincount(place, teach, len(unique)).astype(np.int64)) for unique, place in made]

    total, kinds = totals(plain.where("learn"), "text", lambda block: counted(block, 1), size)

    def finish(block: pa.Table, counts: list[np.ndarray]) -> pa.Table:
        sizes, known, base, model = _score_block(block.column("text").to_pylist(), counts, total, kinds, bits)
        learnt_from = block.column("learn").combine_chunks()
        columns = [block.column("key").combine_chunks(), learnt_from, pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array([total] * len(sizes), pa.int64()), pa.array(base), pa.array(model)]
        return pa.table(columns, [key, "learnt", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return with_counts(plain, "text", lambda block: counted(block, ORDER), lambda n: n, finish, f"`{key}` long, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", size)


def learnt(modulus: int = 10):
    """The documents that the model learns from: those whose remainder isn't 0."""
    return by_crc("doc_id", modulus) != 0
