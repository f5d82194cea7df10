"""Passages that repeat across documents, by recompression.

Words are symbols.  A step names every maximal run of one symbol, then every pair
of a left and a right symbol, where a symbol's side follows from its name; a name
is a hash of what it names, the same all over the corpus.  So a passage has the
same symbols inside wherever it stands, and only those at its rims depend on what
is around it: each symbol keeps the extent of words that it follows from.

Three rounds of Spark, each a count or minimum that is combined before it is
shuffled, and an answer to the block of texts that asked:

1. Stretches of low symbols.  A window's own is that of the smallest name among
   those whose extents it holds; if it is there once, so is the window.
2. Neighbouring symbols of a high level in what is left.  Where such a stretch
   has been before, all its windows have.
3. The windows that are still open, with 128 bits of their words.

Blocks of texts lie in files of the shared folder, so texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import _blocks, _packed, _unpacked
from .runtime import keyed_text, new_path, release, stored
from .shingles import mix, span_hashes, word_spans

#: Steps of the first round's symbols, which a step makes a quarter fewer, and how
#: many make a stretch: seven words about, that follow from two more.  More steps
#: give extents that few windows hold.  Steps of the second round's: two dozen words.
LOW_STEPS, LOW_STRETCH, HIGH_STEPS = 1, 5, 11
#: Constants of the hashes; any odd numbers do.
_FIRST, _SECOND, _LENGTH, _LEVEL = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_RADIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FAR = 1 << 40
#: The place of the row that stands for a block, so that none goes without answer.
_WHOLE = (1 << 62) - 1
#: Blocks that a task answers, about, where there are many.
TASK_BLOCKS = 32


def _level(n: int) -> np.uint64:
    """What tells the n-th way of naming from the others."""
    return np.uint64(n * int(_LEVEL) & (1 << 64) - 1)


@dataclass
class Symbols:
    """What stretches of words are parsed into: symbols that tile them.

    begin: the first word; lo, hi: the words that a symbol follows from, beyond
    any if the stretch's rim matters; owner: the stretch.
    """

    names: np.ndarray
    begin: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    owner: np.ndarray


def _runs(s: Symbols, level: int) -> Symbols:
    """Every maximal run of one symbol as one; it follows from its neighbours, too."""
    new = np.ones(len(s.names), bool)
    new[1:] = (s.names[1:] != s.names[:-1]) | (s.owner[1:] != s.owner[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(new)))
    names = s.names[first]
    many = size > 1
    names[many] = mix(names[many] * _FIRST + size[many].astype(np.uint64) * _LENGTH + _level(2 * level + 1))
    owner = s.owner[first]
    inner = owner[1:] == owner[:-1]
    lo, hi = np.full(len(first), -_FAR), np.full(len(first), _FAR)
    lo[1:][inner] = s.lo[first[1:] - 1][inner]
    hi[:-1][inner] = s.hi[first[1:]][inner]
    return Symbols(names, s.begin[first], lo, hi, owner)


def _pairs(s: Symbols, level: int) -> Symbols:
    """Every left symbol with a right one after it as one."""
    left = (mix(s.names + _level(2 * level)) & np.uint64(1)).astype(bool)
    inner = s.owner[1:] == s.owner[:-1]
    joined = left[:-1] & ~left[1:] & inner
    kept = np.flatnonzero(np.concatenate([[True], ~joined])) if len(left) else np.zeros(0, np.int64)
    pair = np.append(joined, False)[kept]
    lo, hi, names = s.lo[kept], s.hi[kept], s.names[kept]
    at = kept[pair]
    names[pair] = mix(s.names[at] * _FIRST + s.names[at + 1] * _SECOND + _level(2 * level))
    hi[pair] = s.hi[at + 1]
    # one that stays alone follows from the neighbour that it could have been joined with
    last, start = np.append(~inner, True), np.concatenate([[True], ~inner])
    alone = kept[~pair]
    after = np.where(last[alone], _FAR, s.hi[np.minimum(alone + 1, len(left) - 1)])
    before = np.where(start[alone], -_FAR, s.lo[np.maximum(alone - 1, 0)])
    hi[~pair] = np.where(left[alone], after, hi[~pair])
    lo[~pair] = np.where(left[alone], lo[~pair], before)
    return Symbols(names, s.begin[kept], lo, hi, s.owner[kept])


def parsed(words: np.ndarray, owner: np.ndarray, steps: int) -> Symbols:
    """The symbols of hashed words after so many steps; owners are in order."""
    place = np.arange(len(words))
    s = Symbols(words, place, place, place + 1, owner)
    for level in range(steps):
        s = _pairs(_runs(s, level), level)
    return s


def _powers(n: int, radix: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n - 1, 0), r, np.uint64), dtype=np.uint64)])[:n] for r in (radix, pow(radix, -1, 1 << 64)))


def stretch_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
    """A hash of each stretch of hashed words; the kinds are independent."""
    power, inverse = _powers(len(words) + 1, _RADIX[kind])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words + _level(kind)) * power[:-1])])
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _LENGTH)


class Block:
    """The words of a block of texts."""

    def __init__(self, rows: pa.Table):
        self.keys = rows.column(0)
        self.raw, self.begin, self.end, self.count = word_spans(rows.column(1).to_pylist(), lower=False)
        self.words = span_hashes(self.raw, self.begin, self.end)
        self.owner = np.repeat(np.arange(len(self.count)), self.count)
        self.ids = pc.fill_null(self.keys, -(1 << 63)).to_numpy()

    def windows(self, window: int) -> np.ndarray:
        """Flags of the words at which a window starts that is inside one text."""
        whole = np.zeros(len(self.words), bool)
        n = len(self.words) - window + 1
        if n > 0:
            whole[:n] = self.owner[:n] == self.owner[window - 1 :]
        return whole

    def earliest(self, begin: np.ndarray, keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Of the stretches at ``begin`` with equal keys, the first one in the
        order of ids and places; indices in any order."""
        order = np.lexsort((begin, self.ids[self.owner[begin]], keys[1], keys[0]))
        a, b = keys[0][order], keys[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return order[new]


def flagged(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags of ``n`` places that some stretch from begin up to end covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of flags."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def low_stretches(block: Block, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the block's stretches of low symbols that some window holds, and
    for each word the stretch of the window that starts there: that of smallest
    name, -1 without one."""
    s, m = parsed(block.words, block.owner, LOW_STEPS), LOW_STRETCH
    n = max(len(s.names) - m + 1, 0)
    begin, lo, hi = s.begin[:n], s.lo[:n], s.hi[len(s.hi) - n :]
    held = np.flatnonzero((s.owner[:n] == s.owner[len(s.owner) - n :]) & (hi - lo <= window))
    names = np.zeros(n, np.uint64)
    for k in range(m):
        names = names * _FIRST + s.names[k : k + n]
    begin, lo, hi = begin[held], lo[held], hi[held]
    names = mix(names[held] * _SECOND + ((begin - lo).astype(np.uint64) << np.uint64(32)) + (hi - lo).astype(np.uint64) * _LENGTH)
    # the stretches of a window are neighbours: extents are in order of both ends
    words = len(block.words)
    first = np.concatenate([[0], np.cumsum(np.bincount(lo, minlength=words + 1))])[:words]
    last = np.cumsum(np.bincount(hi, minlength=words + window + 1))[window : words + window] - 1
    size = np.where(block.windows(window), last - first + 1, 0)
    chosen = np.full(words, -1)
    smallest, reach = np.arange(len(names)), 1
    while reach <= size.max(initial=0):
        at = np.flatnonzero((size >= reach) & (size < 2 * reach))
        a, b = smallest[first[at]], smallest[last[at] - reach + 1]
        chosen[at] = np.where(names[b] < names[a], b, a)
        a, b = smallest[:-reach], smallest[reach:]
        smallest, reach = np.where(names[b] < names[a], b, a), 2 * reach
    return names, chosen


def asked_once(block: Block, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Each name that some window has for its own, and its stretch, -1 for several."""
    names, chosen = low_stretches(block, window)
    used = np.zeros(len(names), bool)
    used[chosen[chosen >= 0]] = True
    used = np.flatnonzero(used)
    own, first, n = np.unique(names[used], return_index=True, return_counts=True)
    return own, np.where(n == 1, used[first], -1)


def still_open(block: Block, window: int, unique: np.ndarray) -> np.ndarray:
    """Flags of the windows whose own stretch isn't one that is there once."""
    names, chosen = low_stretches(block, window)
    once = np.zeros(len(names) + 1, bool)
    once[unique] = True
    once[-1] = False  # what -1 finds
    return block.windows(window) & ~once[chosen]


def high_stretches(block: Block, window: int, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Begin, end and keys of all neighbouring high symbols, where they hold a
    window, in the words of the live windows."""
    begin, end = stretches(live)
    end = end + window - 1
    size = end - begin
    owner = np.repeat(np.arange(len(begin)), size)
    place = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    s = parsed(block.words[place], owner, HIGH_STEPS)
    first = place[s.begin]
    last = np.append(s.begin[1:], len(place)) - 1
    stop = place[last] + 1 if len(place) else last
    both = np.flatnonzero(s.owner[1:] == s.owner[:-1])
    alone = np.flatnonzero(np.bincount(s.owner, minlength=len(begin))[s.owner] == 1)
    a, b = np.concatenate([both, alone]), np.concatenate([both + 1, alone])
    a, b = (x[stop[b] - first[a] >= window] for x in (a, b))
    keys = mix(s.names[a] * _FIRST + s.names[b] * _SECOND), stretch_hashes(block.words, first[a], stop[b], 0)
    return first[a], stop[b], keys


def _folder(rows: DataFrame) -> str:
    folder = new_path(rows.sparkSession, "texts")
    files, path = pafs.FileSystem.from_uri(folder)
    files.create_dir(path)
    return folder


class _Writer:
    """The blocks of one task in a file, with their offsets at its end.

    A task that is run again writes the same bytes under a name of its own and
    moves them to the same place.
    """

    def __init__(self, folder: str, task: int, attempt: int):
        self.files, path = pafs.FileSystem.from_uri(folder)
        self.path, self.own = f"{path}/{task}", f"{path}/_{task}-{attempt}"
        self.out, self.at = self.files.open_output_stream(self.own), [0]

    def put(self, rows: pa.Table) -> None:
        blob = _packed(rows)
        self.out.write(blob)
        self.at.append(self.at[-1] + len(blob))

    def close(self) -> None:
        self.out.write(np.array([*self.at, len(self.at)], "<i8").tobytes())
        self.out.close()
        try:
            self.files.move(self.own, self.path)
        except OSError:  # a store that doesn't move onto what another attempt has left
            if self.files.get_file_info(self.path).type != pafs.FileType.File:
                raise
            self.files.delete_file(self.own)


def _read(folder: str, number: int) -> Block:
    """A block that some task has written."""
    files, path = pafs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{path}/{number >> 32}") as f:
        size = f.size()
        f.seek(size - 8)
        n = int(np.frombuffer(f.read(8), "<i8")[0])
        f.seek(size - 8 * (n + 1))
        at = np.frombuffer(f.read(8 * n), "<i8")
        k = number & 0xFFFFFFFF
        f.seek(int(at[k]))
        return Block(_unpacked(f.read(int(at[k + 1] - at[k]))))


_ASKED = {"a": pa.int64(), "b": pa.int64(), "id": pa.int64(), "block": pa.int64(), "at": pa.int64(), "state": pa.binary()}
_ASKED_SQL = "a long, b long, id long, block long, at long, state binary"


def _asked(block: Block, number: int, begin: np.ndarray, keys: tuple[np.ndarray, np.ndarray], at: np.ndarray, live: np.ndarray) -> pa.Table:
    """The earliest stretch of each key, and a row that carries the block's state."""
    chosen = block.earliest(begin, keys)
    n = len(chosen)
    own = mix(np.array([number], np.uint64) + _LEVEL)
    state = np.concatenate(stretches(live)).astype("<i8").tobytes()
    columns = (np.append(keys[0][chosen], own).view(np.int64), np.append(keys[1][chosen], _LEVEL).view(np.int64), np.append(block.ids[block.owner[begin[chosen]]], 0), np.full(n + 1, number), np.append(at[chosen], -1))
    return pa.table([*(pa.array(c, pa.int64()) for c in columns), pa.array([None] * n + [state], pa.binary())], list(_ASKED))


def _live(block: Block, answered: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The block's live windows, and what of its stretches came first in the corpus."""
    at = answered.column("at").to_numpy()
    state = answered.column("state").filter(pc.equal(answered.column("at"), -1))[0].as_py()
    begin, end = np.frombuffer(state, "<i8").reshape(2, -1)
    return flagged(len(block.words), begin, end), at[at >= 0]


def _firsts(asked: DataFrame) -> DataFrame:
    """(block, at, state) of the earliest stretch of each key; equal ids by block."""
    first = asked.groupBy("a", "b").agg(F.min(F.struct("id", "block", "at", "state")).alias("m"))
    return stored(first.select("m.block", "m.at", "m.state"), "firsts")


def repeats(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, spans, kept) of every row.

    spans: the stretches of words (from 0; start, stop) that are covered by a
    window of ``window`` consecutive words which also starts earlier, in a row of
    smaller key or before in the same; kept: the other words, joined by one space.
    A null key comes before all others; rows of one key, repeated rows too, count
    in the order of their blocks.  A null or empty text has no words; other
    columns are ignored; an empty table gives an empty one.  ``docs`` must be read
    from files, so that a task that is run again sees the same rows.
    """
    if not 0 < window < 1 << 10:
        raise ValueError("a window has fewer than 1024 words")
    rows = keyed_text(docs, key, text)
    folder = _folder(rows)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, number = _Writer(folder, task.partitionId(), task.taskAttemptId()), task.partitionId() << 32
        for block in _blocks(batches, 1):
            writer.put(block)
            names, where = asked_once(Block(block), window)
            own = mix(np.array([number], np.uint64) + _LEVEL)
            columns = np.append(names, own).view(np.int64), np.full(len(names) + 1, number), np.append(where, _WHOLE)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["name", "block", "at"])
            number += 1
            release()
        writer.close()

    def extend(answered: pa.Table) -> pa.Table:
        number = answered.column("block")[0].as_py()
        block = _read(folder, number)
        at = answered.column("at").to_numpy()
        live = still_open(block, window, at[at != _WHOLE])
        begin, _, keys = high_stretches(block, window, live)
        release()
        return _asked(block, number, begin, keys, np.arange(len(begin)), live)

    def verify(answered: pa.Table) -> pa.Table:
        number = answered.column("block")[0].as_py()
        block = _read(folder, number)
        live, first = _live(block, answered)
        begin, end, _ = high_stretches(block, window, live)
        before = np.ones(len(begin), bool)
        before[first] = False
        seen = flagged(len(block.words), begin[before], end[before] - window + 1)
        left = np.flatnonzero(live & ~seen)
        keys = tuple(stretch_hashes(block.words, left, left + window, k) for k in range(2))
        release()
        return _asked(block, number, left, keys, left, live)

    def finish(answered: pa.Table) -> pa.Table:
        block = _read(folder, answered.column("block")[0].as_py())
        live, first = _live(block, answered)
        live[first] = False
        begin = np.flatnonzero(live)
        release()
        return _kept(block, flagged(len(block.words), begin, begin + window), key)

    low = rows.mapInArrow(name, "name long, block long, at long").groupBy("name").agg(F.count("*").alias("n"), F.min("block").alias("block"), F.min("at").alias("at"))
    once = stored(low.where("n = 1 and at >= 0").select("block", "at"), "once")
    # answers are few bytes but make whole blocks be read again: tasks follow from the number of blocks
    blocks = once.where(F.col("at") == _WHOLE).count()
    tasks = max(1, min(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), blocks // TASK_BLOCKS)
    by_block = lambda df, fn, schema: df.repartition(tasks, "block").groupBy("block").applyInArrow(fn, schema)
    open_ = _firsts(by_block(once, extend, _ASKED_SQL))
    last = _firsts(by_block(open_, verify, _ASKED_SQL))
    return by_block(last, finish, f"`{key}` long, n_words long, spans array<struct<start:long,stop:long>>, kept string")


def _kept(block: Block, gone: np.ndarray, key: str) -> pa.Table:
    """Spans of words that go, and the words that stay, of every text."""
    n = len(block.count)
    stop = np.cumsum(block.count)
    start = stop - block.count
    # a text's own stretches: runs of flags, cut where a text begins
    edge = np.zeros(len(gone) + 1, bool)
    edge[start] = True
    run = gone & ~np.concatenate([[False], gone[:-1]]) | gone & edge[:-1]
    begin = np.flatnonzero(run)
    until = np.flatnonzero(gone & (np.append(~gone[1:], True) | edge[1:])) + 1
    owner = block.owner[begin]
    lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    pairs = pa.StructArray.from_arrays([pa.array(begin - start[owner]), pa.array(until - start[owner])], ["start", "stop"])
    spans = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pairs)
    # the bytes of words that stay, each with one blank after it
    raw, stays = block.raw.copy(), ~gone
    raw[block.end[stays]] = 0x20
    taken = flagged(len(raw), block.begin[stays], block.end[stays] + 1)
    sizes = np.bincount(block.owner[stays], (block.end - block.begin + 1)[stays], n).astype(np.int64)
    data = raw[taken]
    last = np.cumsum(sizes)[sizes > 0] - 1
    data = np.delete(data, last)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))])
    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())
    return pa.table([block.keys.combine_chunks(), pa.array(block.count.astype(np.int64)), spans, text], [key, "n_words", "spans", "kept"])


def removed(spans: Column) -> Column:
    """How many words the spans hold."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
