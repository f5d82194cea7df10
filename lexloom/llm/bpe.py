"""Byte-level BPE vocabularies as finite-state machines.

``Vocabulary`` reads a ``tokenizers`` JSON file.  ``CountTransducer`` compiles
it, lazily, into a deterministic transducer whose transitions carry the change
of the token count; ``pretoken_starts`` is the splitting rule of byte-level
BPE on arrays of code points.
"""

from __future__ import annotations

import json
import os
from functools import cached_property

import numpy as np
import regex

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The splitting pattern of byte-level BPE (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def found(vocabulary: str) -> str:
    """The file of a vocabulary on this machine: a path, or a public name."""
    if os.path.exists(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


class NotFromTheLeft(ValueError):
    """A vocabulary some encoding of which depends on what comes after it."""


class TooManyStates(MemoryError):
    """A machine has reached its limit and must forget its states."""


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(found(path), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        back = _byte_chars()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in model["vocab"].items() if s not in self.specials}
        self.ids = {b: i for i, b in self.bytes_of.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank = dict.fromkeys((self.ids[bytes([b])] for b in range(256)), -1)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = model["vocab"][left], model["vocab"][right]
            made = model["vocab"][left + right]
            self.pair_rank.setdefault((a, b), rank)
            if made not in self.halves and made not in self.rank:
                self.halves[made], self.rank[made] = (a, b), rank

    @cached_property
    def special_re(self) -> regex.Pattern | None:
        """Finds the special strings that the library cuts out of a text."""
        return regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None

    def encoder(self):
        """A fast encoder over the same ranks; special strings become their ids."""
        import tiktoken

        ranks = {b: i for b, i in self.ids.items() if i in self.rank}
        return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(self.specials))


class CountTransducer:
    """Deterministic byte transducer for the token count of one pretoken.

    After reading a prefix p of a pretoken, the encoding of p ends in exactly
    one token.  A state holds, for every position j whose rest p[j:] can still
    grow into a token, the trie node of that rest, the last token of p[:j] and
    count(p[:j]) - count(p).  Reading a byte picks the one token that ends
    there and may follow the token before it; the transition carries
    count(pb) - count(p), so a sum over transitions is the count.  States come
    from a subset construction that runs when a transition is first needed;
    beyond ``limit`` of them it raises, and ``forget`` drops them all.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 1 << 62):
        self.v, self.limit = vocabulary, limit
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        for b, i in vocabulary.ids.items():
            if i in vocabulary.rank:
                self._add(b, i)
        self.start = ((0, -1, 0),)
        self.forget()

    def forget(self) -> None:
        """Start over with the start state alone."""
        self._left: dict[int, tuple] = {}
        self._right: dict[int, tuple] = {}
        self._follows: dict[tuple[int, int], bool] = {}
        self.number: dict[tuple, int] = {self.start: 0}
        self.states: list[tuple] = [self.start]
        self._keys = np.full(1 << 16, -1, np.int64)
        self._next = np.zeros(1 << 16, np.int32)
        self._delta = np.zeros(1 << 16, np.int16)
        self._filled = 0
        firsts = [self._step(0, b) for b in range(256)]
        self.first = np.array([f[0] for f in firsts], np.int32)

    def _add(self, token: bytes, i: int) -> None:
        node = 0
        for b in token:
            self.inner[node] = True
            key = node << 8 | b
            if key not in self.child:
                self.child[key] = len(self.token_at)
                self.token_at.append(-1)
                self.inner.append(False)
            node = self.child[key]
        self.token_at[node] = i

    def _spine(self, token: int, side: int) -> tuple[tuple[int, float], ...]:
        """The symbols at one edge of a token while it is built, each with the
        rank of the merge that consumes it."""
        cache = self._left if side == 0 else self._right
        if token not in cache:
            out, until = [], float("inf")
            part = token
            while True:
                out.append((part, until))
                if part not in self.v.halves:
                    break
                until, part = self.v.rank[part], self.v.halves[part][side]
            cache[token] = tuple(out)
        return cache[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of the joined bytes is just [a, b]: no merge
        across the border may come up while both of its sides are there."""
        key = (a, b)
        known = self._follows.get(key)
        if known is None:
            ranks = self.v.pair_rank
            known = True
            for u, u_until in self._spine(a, 1):
                for w, w_until in self._spine(b, 0):
                    m = ranks.get((u, w))
                    if m is not None and u_until > m and w_until >= m:
                        known = False
            self._follows[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        grown = []
        chosen = None
        for node, last, rel in self.states[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token_at[node]
            if chosen is None and token >= 0 and (last < 0 or self.follows(last, token)):
                chosen = (token, rel + 1)
            if self.inner[node]:
                grown.append((node, last, rel))
        if chosen is None:
            raise NotFromTheLeft("this vocabulary's encodings aren't determined from the left")
        token, delta = chosen
        return self.intern((*((n, last, rel - delta) for n, last, rel in grown), (0, token, 0))), delta

    def intern(self, key: tuple) -> int:
        """The number of a state, which is made if it isn't there."""
        number = self.number.get(key)
        if number is None:
            if len(self.states) >= self.limit:
                raise TooManyStates
            number = self.number[key] = len(self.states)
            self.states.append(key)
        return number

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        size = len(self._keys)
        return ((keys * np.int64(-7046029254386353131)) >> np.int64(20)) & np.int64(size - 1)

    def _insert(self, keys: np.ndarray, nexts: np.ndarray, deltas: np.ndarray) -> None:
        if (self._filled + len(keys)) * 3 > len(self._keys):
            old = self._keys >= 0
            k, n, d = self._keys[old], self._next[old], self._delta[old]
            size = len(self._keys)
            while (self._filled + len(keys)) * 3 > size:
                size *= 2
            self._keys, self._next, self._delta = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int16)
            self._filled = 0
            keys, nexts, deltas = np.concatenate([k, keys]), np.concatenate([n, nexts]), np.concatenate([d, deltas])
        mask = np.int64(len(self._keys) - 1)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self._keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self._keys[slot[won]], self._next[slot[won]], self._delta[slot[won]] = keys[won], nexts[won], deltas[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            left = left[rest[left]]
            slot[left] = (slot[left] + 1) & mask
        self._filled += len(keys)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where it isn't there."""
        mask = np.int64(len(self._keys) - 1)
        slot = self._slot(keys)
        held = self._keys[slot]
        odd = np.flatnonzero(held != keys)
        while len(odd):
            gone = odd[self._keys[slot[odd]] < 0]
            slot[gone] = -1
            odd = odd[slot[odd] >= 0]
            slot[odd] = (slot[odd] + 1) & mask
            odd = odd[self._keys[slot[odd]] != keys[odd]]
        return slot

    def move(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and count changes for many (state, byte) at once."""
        keys = states.astype(np.int64) << 8 | symbols
        slot = self._find(keys)
        if len(missing := np.flatnonzero(slot < 0)):
            new = np.unique(keys[missing])
            made = [self._step(int(k) >> 8, int(k) & 255) for k in new]
            self._insert(new, np.array([m[0] for m in made], np.int32), np.array([m[1] for m in made], np.int16))
            slot = self._find(keys)
        return self._next[slot], self._delta[slot]


def char_classes() -> np.ndarray:
    """Class of every code point under the splitting pattern."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every, where = "".join(map(chr, points)), np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[where[m.start() : m.end()]] = kind
    return out


def pretoken_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Flags of the code points at which a pretoken starts.

    points: code points of several texts, end to end; first: flags of the
    first one of each text.
    """
    n = len(points)
    kind = classes[points]
    before = np.concatenate([[255], kind[:-1]]).astype(np.uint8)
    before[first] = 255
    prev = np.concatenate([[0], points[:-1]])
    blank = kind == SPACE
    last = np.concatenate([first[1:], [True]])
    after_solid = np.zeros(n, bool)  # a non-space of the same text comes next
    after_solid[:-1] = ~blank[1:]
    after_solid[last] = False
    glued = (before == SPACE) & (prev == 0x20)  # the space before belongs to this pretoken
    start = np.where(blank, (before != SPACE) | after_solid, (before != kind) & ~glued)
    quote = np.flatnonzero((points == 0x27) & (before != OTHER) & ~glued)
    if len(quote):
        owner = np.cumsum(first)
        pad = np.concatenate([points, [0, 0]])
        a, b = pad[quote + 1], pad[quote + 2]
        inside = lambda k: (quote + k < n) & (owner[np.minimum(quote + k, n - 1)] == owner[quote])
        one = inside(1) & np.isin(a, [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        two &= inside(2)
        for hit, k in ((one, 2), (two, 3)):
            at = quote[hit]
            start[at] = True
            start[at + 1] = False
            if k == 3:
                start[at + 2] = False
            end = at + k
            start[end[end < n]] = True
    start[first] = True
    return start
