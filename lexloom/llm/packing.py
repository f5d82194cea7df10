"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, found
from .runtime import free_name, keyed_text, portions, release

#: Bins that are open at once in a task, and pieces of its look-ahead, of which
#: the longest go first.  On the given documents this makes 0.3 % more sequences
#: than there are tokens for; without look-ahead it is 0.9 %, with 32,768 of both,
#: which is no longer online, 0.1 %.
OPEN_BINS, LOOK_AHEAD = 256, 512


class OpenBins:
    """Online best-fit over a fixed number of open bins.

    ``sizes`` is a bitset: bit f is set while a bin with f free places is
    open.  The best fit for n is the lowest set bit at or above n; when a new
    bin is needed and all are in use, the fullest (the lowest bit) closes.
    """

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sizes = self.open = self.made = 0

    def place(self, n: int) -> tuple[int, int]:
        """Bin number and offset for ``n`` tokens, 0 < n <= capacity."""
        fitting = self.sizes >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.sizes & -self.sizes).bit_length() - 1)
            free, chosen = self.capacity, self.made
            self.made += 1
        left = free - n
        if left:
            self.by_free[left].append(chosen)
            self.sizes |= 1 << left
            self.open += 1
        return chosen, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        chosen = stack.pop()
        if not stack:
            self.sizes &= ~(1 << free)
        self.open -= 1
        return chosen


#: A run of white space on which the stack of tiktoken's splitter might overflow.
_LONG_BLANK = re.compile(r"\s{100000}")
_encoders: dict[str, tuple] = {}


def encoder(path: str):
    """ids(text) for a byte-level BPE file; special strings become their ids.

    A text that tiktoken can't split is encoded by ``tokenizers``.
    """
    if path not in _encoders:
        vocabulary = Vocabulary(path)
        made = vocabulary.encoder()
        specials = tuple(vocabulary.specials)
        library = []

        def slowly(text: str) -> list[int]:
            if not library:
                from tokenizers import Tokenizer

                library.append(Tokenizer.from_file(found(path)))
            return library[0].encode(text, add_special_tokens=False).ids

        def encode(text: str) -> list[int]:
            if len(text) >= 100000 and _LONG_BLANK.search(text):
                return slowly(text)
            try:
                return made.encode(text, allowed_special="all") if any(s in text for s in specials) else made.encode_ordinary(text)
            except BaseException as e:
                if type(e).__name__ != "PanicException":  # derives from BaseException alone
                    raise
                return slowly(text)

        _encoders[path] = (encode,)
    return _encoders[path][0]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenised documents, each closed by ``end_id``, cut to ``capacity``.

    Only longer documents are cut; the odd rest is the first piece.  A null or
    empty text is the end id alone; repeated rows give repeated pieces; other
    columns are ignored; an empty table gives an empty one.  One narrow pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for whole in batches:
            for batch in portions(whole, 1):
                out: list[tuple] = []
                for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(body), end_id], "<u4")
                    cut = len(ids) % capacity or capacity
                    start = 0
                    number = 0
                    while start < len(ids):
                        part = ids[start : start + cut]
                        out.append((doc, number, start, len(part), zlib.crc32(part.tobytes())))
                        start, cut, number = start + len(part), capacity, number + 1
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, [key, "piece", "start", "length", "ids_crc32"])
            release()

    return keyed_text(docs, key, text).mapInArrow(run, f"`{key}` long, piece int, start long, length long, ids_crc32 long")


def _windows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows``, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(map(len, held)) >= rows:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield whole.slice(0, rows)
            held = [whole.slice(rows)]
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def best_fit(items: DataFrame, capacity: int = 1024, open_bins: int = OPEN_BINS, look_ahead: int = LOOK_AHEAD, key: str = "doc_id", number: str = "piece", length: str = "length") -> DataFrame:
    """``items`` with the sequence and offset at which each is packed.

    Only these narrow rows are shuffled, by a hash, so that a task packs a
    random share of all lengths; adaptive execution sizes the tasks.  Within a
    task the rows come in the order of that hash, so a lost task packs them in
    the same way again, and are placed online, ``look_ahead`` rows at a time
    with the longest first: space and state stay bounded.  Lengths lie between
    1 and ``capacity``; ties and repeated rows are packed one by one; columns
    named sequence_id or offset are replaced; an empty table gives an empty one.
    """
    items = items.drop("sequence_id", "offset")
    names, salt = items.columns, free_name(items, "salt")
    order = F.xxhash64(*names)
    # equal rows, of which any number may be there, are dealt apart
    salted = items.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    dealt = salted.repartition(order, salt).sortWithinPartitions(order, key, number).drop(salt)
    at = names.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for window in _windows(batches, look_ahead):
            sizes = window.column(at).to_numpy()
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                sequence[i], offset[i] = bins.place(int(sizes[i]))
            yield pa.RecordBatch.from_arrays([*window.columns, pa.array(sequence + base), pa.array(offset)], [*window.schema.names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return dealt.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, open_bins: int = OPEN_BINS, look_ahead: int = LOOK_AHEAD) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``capacity``.

    A null or empty text is the end id alone, a null key is a key like others,
    and every repeated row has its own pieces; an empty table gives an empty one.
    """
    return best_fit(pieces(docs, vocabulary, capacity), capacity, open_bins, look_ahead)
