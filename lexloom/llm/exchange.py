"""Counts over the whole corpus, back where the texts are.

Rows are taken in blocks as they are read.  A block sends each range of the hash
that some of its n-grams lie in one compressed array of them with its own
counts, and leaves its rows, compressed, in a file of its task in the shared
folder; ranges add up and answer; where the answers meet, the block's rows are
read back.  So no count table is collected, broadcast or joined row by row, texts
are moved once, rows that are alike never share a key, and there are never more
messages than n-grams.  Every step is a shuffle of bounded groups; an attempt
that is lost leaves a file that no message names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard as zstd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import new_path, release

#: Bytes of text in a block, and of text for each range of the hash, about.
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 8 << 20
#: The kind of the message that says where the block is.
_ROWS = -1

Grams = list[tuple[np.ndarray, np.ndarray]]


def _put(values: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte of their width."""
    return zstd.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes())


def _get(blob: bytes, kind: str) -> np.ndarray:
    """Undo ``_put``."""
    data = np.frombuffer(zstd.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _put_ids(ids: np.ndarray) -> bytes:
    """Sorted hashes, as differences."""
    return _put(np.diff(ids, prepend=np.uint64(0)))


def _get_ids(blob: bytes) -> np.ndarray:
    return np.cumsum(_get(blob, "u8"), dtype=np.uint64)


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return zstd.ZstdCompressor(level=3).compress(sink.getvalue())


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstd.ZstdDecompressor().decompress(blob)).read_all()


def range_bits(size: int) -> int:
    """Leading bits of a hash that name its range, for so many bytes of text."""
    return min(28, max(5, (size // RANGE_BYTES).bit_length()))


def text_bytes(rows: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return rows.agg(F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0))).first()[0]


def _blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.Table]:
    """The rows in tables of about BLOCK_BYTES of text; a longer text is one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(text)).to_pylist()):
            if size and size + n > BLOCK_BYTES:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i
            size += n + 8
        held.append(batch.slice(start))
    if size:
        yield pa.Table.from_batches(held)


_NAMES, _KINDS = ["part", "block", "kind", "ids", "n"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
_MESSAGE = "part int, block long, kind int, ids binary, n binary"


def _messages(number: int, grams: Grams, bits: int) -> Iterator[pa.RecordBatch]:
    """One row for each kind and range that some of a block's hashes lie in."""
    for kind, (ids, own) in enumerate(grams):
        part = ids >> np.uint64(64 - bits)
        cuts = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
        if len(cuts):
            blobs = [[code(x) for x in np.split(values, cuts[1:])] for code, values in ((_put_ids, ids), (_put, own))]
            n = len(cuts)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((part[cuts].astype(np.int32), [number] * n, [kind] * n, *blobs), _KINDS, strict=True)], _NAMES)


def totals(rows: DataFrame, text: str, grams: Callable[[pa.Table], Grams], size: int) -> tuple[int, int]:
    """The sum of all corpus counts, and how many different hashes have one."""
    bits, at = range_bits(size), rows.columns.index(text)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, at):
            yield from _messages(0, grams(block), bits)
            release()

    def add(asked: pa.Table) -> pa.Table:
        ids = [_get_ids(b) for b in asked.column("ids").to_pylist()]
        own = np.concatenate([_get(b, "i8") for b in asked.column("n").to_pylist()])
        seen = np.unique(np.concatenate(ids)[own > 0])
        return pa.table({"n": pa.array([int(own.sum())]), "v": pa.array([len(seen)], pa.int64())})

    found = rows.mapInArrow(ask, _MESSAGE).groupBy("part").applyInArrow(add, "n long, v long")
    row = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    return int(row["n"]), int(row["v"])


def with_counts(rows: DataFrame, text: str, grams: Callable[[pa.Table], Grams], reply: Callable[[np.ndarray], np.ndarray], finish: Callable[[pa.Table, list[np.ndarray]], pa.Table], schema: str, size: int) -> DataFrame:
    """``finish(block, counts)`` of every block of ``rows``.

    grams: sorted distinct hashes of each kind with the block's own counts;
    reply: what is sent back of the corpus counts of some of them; finish gets
    that back for all hashes of each kind, in their order.  ``text`` has no
    nulls; ``size`` are its bytes, about.
    """
    bits, at = range_bits(size), rows.columns.index(text)

    folder = new_path(rows.sparkSession, "blocks")
    made, path = pafs.FileSystem.from_uri(folder)
    made.create_dir(path)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        first = task.partitionId() << 32
        files, path = pafs.FileSystem.from_uri(folder)
        name, offset = f"{path}/{task.partitionId():05d}-{task.taskAttemptId()}", 0
        with files.open_output_stream(name) as out:
            for k, block in enumerate(_blocks(batches, at)):
                blob = _packed(block)
                out.write(blob)
                where = f"{name}\n{offset}\n{len(blob)}".encode()
                offset += len(blob)
                number = first + k
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((number % (1 << bits), number, _ROWS, where, None), _KINDS, strict=True)], _NAMES)
                yield from _messages(number, grams(block), bits)
                release()

    def answer(asked: pa.Table) -> pa.Table:
        if asked.column("kind")[0].as_py() == _ROWS:
            return asked.select(["block", "part", "kind", "ids"])
        ids = [_get_ids(b) for b in asked.column("ids").to_pylist()]
        own = [_get(b, "i8") for b in asked.column("n").to_pylist()]
        every, place = np.unique(np.concatenate(ids), return_inverse=True)
        found = np.bincount(place, np.concatenate(own), len(every)).astype(np.int64)
        back = [_put(reply(found[p])) for p in np.split(place, np.cumsum([len(i) for i in ids])[:-1])]
        release()
        return pa.table([*(asked.column(c) for c in ("block", "part", "kind")), pa.array(back, pa.binary())], ["block", "part", "kind", "ids"])

    def meet(answered: pa.Table) -> pa.Table:
        held = sorted(zip(answered.column("kind").to_pylist(), answered.column("part").to_pylist(), answered.column("ids").to_pylist(), strict=True), key=lambda x: x[:2])
        name, offset, length = held[0][2].decode().split("\n")
        files, _ = pafs.FileSystem.from_uri(folder)
        with files.open_input_file(name) as f:
            f.seek(int(offset))
            block = _unpacked(f.read(int(length)))
        blobs: dict[int, list[np.ndarray]] = {}
        for kind, _, blob in held[1:]:
            blobs.setdefault(kind, []).append(_get(blob, reply(np.zeros(0, np.int64)).dtype.str))
        release()
        return finish(block, [np.concatenate(blobs[k]) if k in blobs else reply(np.zeros(0, np.int64)) for k in range(1 + max(blobs, default=-1))])

    asked = rows.mapInArrow(ask, _MESSAGE)
    answered = asked.groupBy("part", "kind").applyInArrow(answer, "block long, part int, kind int, ids binary")
    return answered.groupBy("block").applyInArrow(meet, schema)
