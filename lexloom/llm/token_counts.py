"""Token counts by a compiled finite-state tokenizer.

A byte-level BPE vocabulary becomes a deterministic transducer (see
``bpe.CountTransducer``).  Texts are cut into chunks, and all chunks of a batch
run in lockstep through it.  A chunk that starts inside a pretoken has a state
map: each state in which it can be entered, with the state in which it is then
left and the tokens counted on the way.  Maps compose, and a parallel prefix
scan over them gives the state that every chunk is really entered in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import CountTransducer, NotFromTheLeft, TooManyStates, Vocabulary, char_classes, found, pretoken_starts
from .runtime import keyed_text, release, slices

#: Bytes of a chunk, about; a chunk that can starts at a pretoken.
CHUNK = 256
#: Bytes of text that run in lockstep, and characters of a longer text's parts.
BATCH, PART = 4 << 20, 1 << 20
#: Bytes before a chunk inside a long pretoken from which states that it may be
#: entered in are reached, each as if a pretoken started there.
RUN_UPS = (24, 64, 192)
#: States that a machine holds at most (about a kilobyte each).
STATES = 300_000
#: Before a blank that follows no blank a pretoken always ends.
_SAFE = re.compile(r"(?<=\S)[ \n]")


class StateMaps:
    """One map a chunk: entry state -> (exit state, count), in padded arrays.

    entry, exit and count have a row a chunk; -1 pads rows of fewer entries.  An
    entry of -2 stands for any state: the chunk forgets what was before it.
    """

    def __init__(self, entry: np.ndarray, exit_: np.ndarray, count: np.ndarray):
        self.entry, self.exit, self.count = entry, exit_, count

    def then(self, later: StateMaps) -> StateMaps:
        """Row by row, first this map, then ``later``, which must know every
        exit state of this one.  Associative."""
        hit = (later.entry[:, None, :] == self.exit[:, :, None]) | (later.entry[:, None, :] == -2)
        at = hit.argmax(2)
        there = self.entry != -1
        if not hit.any(2)[there].all():
            raise ValueError("a state map lacks a state")
        take = np.arange(len(at))[:, None]
        return StateMaps(self.entry, np.where(there, later.exit[take, at], -1), np.where(there, self.count + later.count[take, at], 0))

    def rows(self, k) -> StateMaps:
        return StateMaps(self.entry[k], self.exit[k], self.count[k])


def scanned(maps: StateMaps, first: np.ndarray) -> StateMaps:
    """Each row's map after those of all rows before it, back to the last row
    of ``first``: a prefix scan in a logarithmic number of doubling rounds."""
    n = len(first)
    reach = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))  # rows still ahead of each
    now = StateMaps(maps.entry.copy(), maps.exit.copy(), maps.count.copy())
    step = 1
    while (late := np.flatnonzero(reach >= step)).size:
        made = now.rows(late - step).then(now.rows(late))
        now.entry[late], now.exit[late], now.count[late] = made.entry, made.exit, made.count
        step *= 2
    return now


class TokenCounter:
    """Counts tokens of whole texts as the vocabulary's own library does.

    A vocabulary whose encodings aren't determined from the left is left to
    that library.
    """

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = Vocabulary(path)
        self.library = None
        self.lanes = BATCH // CHUNK  # chunks of a group
        try:
            self.machine = CountTransducer(self.vocabulary, STATES)
        except NotFromTheLeft:
            self._give_up()
        self.classes = char_classes()

    def _give_up(self) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(found(self.path))

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special strings count as their one token."""
        if self.library is None:
            try:
                return self._counted(texts)
            except NotFromTheLeft:
                self._give_up()
        return np.array([len(self.library.encode(t, add_special_tokens=False).ids) for t in texts], np.int64)

    def _counted(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        special = self.vocabulary.special_re
        for i, text in enumerate(texts):
            cut = special.split(text) if special and any(s in text for s in self.vocabulary.specials) else [text]
            out[i] = len(cut) - 1
            for part in cut:
                for piece in _pieces(part):
                    parts.append(piece)
                    owner.append(i)
        for a, b in slices([len(p) for p in parts], BATCH):
            np.add.at(out, owner[a:b], self._count(parts[a:b]))
        return out

    def _count(self, parts: list[str]) -> np.ndarray:
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int32)
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        lengths = np.array([len(p) for p in parts])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        first = np.zeros(len(points), bool)
        first[begin] = True
        starts = pretoken_starts(points, first, self.classes)
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.cumsum(width, dtype=np.int64) - width
        flag = np.zeros(len(data), bool)
        flag[at[starts]] = True
        text_at = at[begin]
        cuts, known = self._cuts(len(data), np.flatnonzero(flag), text_at)
        of = np.searchsorted(text_at, cuts, "right") - 1
        out = np.zeros(len(parts), np.int64)
        np.add.at(out, of, self._run(data, flag, cuts, known))
        return out

    @staticmethod
    def _cuts(size: int, starts: np.ndarray, text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunk starts: every text, then the first pretoken of each stretch of
        CHUNK bytes; in a stretch without one, its first byte."""
        grid = np.arange(0, size, CHUNK)
        near = np.searchsorted(starts, grid)
        snapped = np.where(near < len(starts), starts[np.minimum(near, len(starts) - 1)], size)
        chosen = np.where(snapped < grid + CHUNK, snapped, grid)
        cuts = np.unique(np.concatenate([text_at, chosen]))
        known = np.isin(cuts, starts, assume_unique=True)
        return cuts, known

    def _run(self, data: np.ndarray, flag: np.ndarray, cuts: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Counts of the chunks, group by group; a group hands the state that it
        ends in to the next.  Where it needs too many states, the machine starts
        over with half as many chunks, and later takes more again."""
        ends = np.concatenate([cuts[1:], [len(data)]])
        out = np.zeros(len(cuts), np.int64)
        carry, a = self.machine.start, 0
        while a < len(cuts):
            some = slice(a, a + self.lanes)
            try:
                counts, last = self._group(data, flag, cuts[some], ends[some], known[some], self.machine.intern(carry))
            except TooManyStates:
                self.machine.forget()
                self.lanes = max(1, self.lanes // 2)
                continue
            out[some], carry = counts, self.machine.states[last]
            a += self.lanes
            self.lanes = min(2 * self.lanes, BATCH // CHUNK)
        return out

    def _group(self, data, flag, cuts, ends, known, before: int) -> tuple[np.ndarray, int]:
        """Counts of consecutive chunks and the state after the last.

        Chunks that start at a pretoken need no entry state.  Of any other the
        entries are the states that run-ups reach and all that the chunk before
        it is left in, until no new ones appear: then the maps compose.
        """
        n = len(cuts)
        inside = np.flatnonzero(~known)
        if not len(inside):
            exits, counts = self._lockstep(data, flag, cuts, ends, np.zeros(n, np.int32))
            return counts, int(exits[-1])
        rows, states = [np.flatnonzero(known)], [np.zeros(int(known.sum()), np.int32)]
        for back in RUN_UPS:
            reached, _ = self._lockstep(data, flag, np.maximum(cuts[inside] - back, 0), cuts[inside], np.zeros(len(inside), np.int32))
            rows.append(inside)
            states.append(reached)
        if not known[0]:
            rows.append(np.zeros(1, np.int64))
            states.append(np.array([before], np.int32))
        lanes = np.unique(np.stack([np.concatenate(rows), np.concatenate(states)], 1), axis=0)
        held = np.zeros((0, 4), np.int64)  # row, entry, exit, count
        while len(lanes):
            exits, counts = self._lockstep(data, flag, cuts[lanes[:, 0]], ends[lanes[:, 0]], lanes[:, 1].astype(np.int32))
            held = np.concatenate([held, np.stack([lanes[:, 0], lanes[:, 1], exits, counts], 1)])
            after = np.stack([lanes[:, 0] + 1, exits], 1)
            after = np.unique(after[(after[:, 0] < n) & ~known[np.minimum(after[:, 0], n - 1)]], axis=0)
            have = held[:, 0] << 32 | held[:, 1]
            lanes = after[~np.isin(after[:, 0] << 32 | after[:, 1], have)]
        held = held[np.argsort(held[:, 0], kind="stable")]
        size = np.bincount(held[:, 0], minlength=n)
        column = np.arange(len(held)) - np.repeat(np.cumsum(size) - size, size)
        maps = StateMaps(np.full((n, size.max()), -1), np.full((n, size.max()), -1), np.zeros((n, size.max()), np.int64))
        maps.entry[held[:, 0], column], maps.exit[held[:, 0], column], maps.count[held[:, 0], column] = held[:, 1], held[:, 2], held[:, 3]
        maps.entry[known, 0] = -2
        whole = scanned(maps, known | (np.arange(n) == 0))
        at = np.zeros(n, np.int64)
        if not known[0]:
            lead = np.arange(n) < (known.argmax() if known.any() else n)
            at[lead] = (maps.entry[0] == before).argmax()
        upto, exits = whole.count[np.arange(n), at], whole.exit[np.arange(n), at]
        return upto - np.where(known, 0, np.concatenate([[0], upto[:-1]])), int(exits[-1])

    def _lockstep(self, data, flag, begins, ends, entry) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(begins - ends, kind="stable")  # longest first: running lanes stay a prefix
        pos, length = begins[order].copy(), (ends - begins)[order]
        state, total = entry[order].copy(), np.zeros(len(order), np.int64)
        alive = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), "right") if len(order) else []
        for lanes in alive:
            at = pos[:lanes]
            symbol, fresh = data[at], flag[at]
            now = state[:lanes]
            new = self.machine.first[symbol]
            total[:lanes] += fresh
            inside = np.flatnonzero(~fresh)
            if len(inside):
                new[inside], delta = self.machine.move(now[inside], symbol[inside])
                total[inside] += delta
            state[:lanes] = new
            pos[:lanes] += 1
        back_state, back_total = np.empty_like(state), np.empty_like(total)
        back_state[order], back_total[order] = state, total
        return back_state, back_total


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts at places where a pretoken always ends."""
    start = 0
    while len(text) - start > PART and (m := _SAFE.search(text, start + PART)):
        yield text[start : m.start()]
        start = m.start()
    if start < len(text):
        yield text[start:]


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One compiled counter for each worker process and vocabulary."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed ``limit``.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows give repeated
    rows; other columns are ignored; an empty table gives an empty one.  One
    narrow pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = machine.count(texts)
            sizes = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)], [key, "n_bytes", "n_tokens", "over_limit"])
            release()

    return keyed_text(docs, key, text).mapInArrow(run, f"`{key}` long, n_bytes long, n_tokens long, over_limit boolean")
