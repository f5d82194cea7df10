"""Importance resampling towards a target corpus.

Hashed word n-grams of every text are written once as packed uint16 streams with
the offsets of their documents.  Counts come from sorting the streams and
run-length encoding them; weights from gathering each bucket's gain and adding it
up between offsets.
"""

from __future__ import annotations

import binascii
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import keyed_text, portions, release, stored

#: Bytes of a word from which it is hashed by itself, not along with the others.
_LONG = 64


def _crc_table() -> np.ndarray:
    """The crc32 of a register that takes up one byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_TABLE = _crc_table()


class _Shifts:
    """What appending n zero bytes does to a crc32, for many values at once.

    It is linear over bits, so it is the exclusive or of what it does to each of
    the four bytes; a table holds that for every n below ``_LONG`` + 1, longer
    ones double.
    """

    def __init__(self):
        one = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
        steps = [one]
        for _ in range(_LONG):
            steps.append(self._zero(steps[-1]))
        self.tables = np.stack(steps)  # n, byte, value
        self.doubled = [self.tables[1]]  # of 1, 2, 4, 8 ... bytes

    @staticmethod
    def _zero(crc: np.ndarray) -> np.ndarray:
        return _TABLE[crc & 0xFF] ^ (crc >> 8)

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = np.minimum(n, _LONG)
        t = self.tables
        out = t[m, 0, crc & 0xFF] ^ t[m, 1, (crc >> 8) & 0xFF] ^ t[m, 2, (crc >> 16) & 0xFF] ^ t[m, 3, crc >> 24]
        far = np.flatnonzero(n > _LONG)
        if len(far):
            out[far] = self._far(crc[far], n[far])
        return out

    def _far(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        for bit in range(int(n.max()).bit_length()):
            if bit == len(self.doubled):
                self.doubled.append(self._apply(self.doubled[-1], self.doubled[-1]))
            there = (n >> bit & 1).astype(bool)
            crc = np.where(there, self._apply(self.doubled[bit], crc), crc)
        return crc


_shifts: list[_Shifts] = []


def _word_crcs(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of every span of bytes, one byte of all of them at a time."""
    size = end - begin
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, _LONG), kind="stable")
    left = np.searchsorted(-np.minimum(size, _LONG)[order], -np.arange(_LONG), side="left")
    for k in range(_LONG):
        now = order[: left[k]]
        if not len(now):
            break
        held = crc[now]
        crc[now] = _TABLE[(held ^ raw[begin[now] + k]) & 0xFF] ^ (held >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _LONG).tolist():
        crc[i] = binascii.crc32(raw[begin[i] : end[i]])
    return crc


def word_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, begin and end of each word, and words of each text.

    A-Z are lower-cased; a word is a run of digits, a-z and anything beyond ASCII.
    """
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw | 0x20, raw)
    solid = ((raw >= 0x30) & (raw <= 0x39)) | ((raw >= 0x61) & (raw <= 0x7A)) | (raw >= 0x80)
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    close = np.cumsum([len(d) + 1 for d in data], dtype=np.int64)
    return raw, begin, end, np.diff(np.searchsorted(begin, close), prepend=0)


def bucket_stream(texts: list[str], buckets: int, longest: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to ``longest`` words of each text, text by text,
    with the number of words and of features of each text.

    A run's bucket is the crc32 of its words, joined by one space, modulo
    ``buckets``.  Each length is made of the one before: a checksum of joined
    bytes follows from those of its parts.
    """
    if not _shifts:
        _shifts.append(_Shifts())
    raw, begin, end, words = word_spans(texts)
    size = end - begin
    word = _word_crcs(raw, begin, end)
    blank = np.uint32(binascii.crc32(b" "))
    spaced = _shifts[0](np.full(len(word), blank, np.uint32), size) ^ word  # of " word"
    first = np.cumsum(words) - words
    total = sum(np.maximum(words - k, 0) for k in range(longest))
    out = np.empty(int(total.sum()), np.uint16)
    at = np.cumsum(total) - total
    place = np.arange(len(word)) - np.repeat(first, words)
    crc = word
    for k in range(longest):
        if k:  # runs that start at each word but the last
            crc = _shifts[0](crc[:-1], size[k:] + 1) ^ spaced[k:]
        n = len(word) - k
        if n <= 0:
            break
        owner = np.repeat(np.arange(len(texts)), words)[:n]
        whole = place[:n] + k < words[owner]
        done = sum((np.maximum(words - j, 0) for j in range(k)), np.zeros(len(texts), np.int64))
        out[(at + done)[owner[whole]] + place[:n][whole]] = crc[whole] % np.uint32(buckets)
    return out, words, total


def streams(docs: DataFrame, buckets: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed bucket streams of all rows, written to the shared folder.

    row (the number of the first), keys, words, offsets (one more than keys) and stream (uint16, little
    endian), about 2 MB of text a row.  A null text has no words; a null key is a
    key like others; repeated rows stay; other columns are ignored.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket must fit 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in portions(whole, 1):
                stream, words, total = bucket_stream(batch.column(1).to_pylist(), buckets)
                lists = [[batch.column(0).to_pylist()], [words], [np.concatenate([[0], np.cumsum(total)])]]
                columns = [pa.array([row]), *(pa.array(x, pa.list_(pa.int64())) for x in lists), pa.array([stream.astype("<u2").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "keys", "words", "offsets", "stream"])
                row += len(batch)
            release()

    made = keyed_text(docs, key, text).mapInArrow(run, "row long, keys array<long>, words array<long>, offsets array<long>, stream binary")
    return stored(made, "streams")


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of a stream, sorted, with their counts."""
    stream = np.sort(stream)
    cut = np.flatnonzero(np.diff(stream, prepend=stream[:1] + np.uint16(1)))
    return stream[cut], np.diff(np.append(cut, len(stream)))


def bucket_counts(packed: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has in all streams.

    A task sorts and run-length encodes each of its streams and hands on one row
    for each bucket it has seen; no more than ``buckets`` rows reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                values, counts = run_lengths(np.frombuffer(blob.as_buffer(), "<u2"))
                own[values] += counts
        seen = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(own[seen])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in packed.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of how much more frequent each bucket
    is in the target, with one more count for every bucket."""
    buckets = len(source)
    t, s = target.astype(float), source.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(packed: DataFrame, gain: np.ndarray, key: str = "doc_id") -> DataFrame:
    """(key, row, n_words, n_features, weight) of every row of the streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                keys, words, offsets = (batch.column(c)[i].values for c in (1, 2, 3))
                got = gain[np.frombuffer(batch.column(4)[i].as_buffer(), "<u2")]
                at = offsets.to_numpy()
                size = np.diff(at)
                # reduceat takes one value for an empty stretch, and none may start at the end
                total = np.where(size > 0, np.add.reduceat(np.append(got, 0), at[:-1]), 0)
                row = batch.column(0)[i].as_py() + np.arange(len(size))
                yield pa.RecordBatch.from_arrays([keys, pa.array(row), words, pa.array(size), pa.array(total)], [key, "row", "n_words", "n_features", "weight"])

    return packed.mapInArrow(run, f"`{key}` long, row long, n_words long, n_features long, weight long")


def drawn(weighted: DataFrame, percent: int, least_words: int, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``weighted`` with a score, and a rank for the rows that are drawn.

    The score is the weight plus Gumbel noise that follows from the key (null: as
    an empty one).  Of the rows with ``least_words`` words, floor(percent * N /
    100) of the highest scores are drawn; ties go to the smaller key, equal rows
    count one by one.  Rows are dealt to ranges of that order and sorted there, so
    a rank is a range's start and a place in it; no task sees all of them.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighted.withColumn("score", F.col("weight") + noise).withColumn("drawable", F.col("n_words") >= least_words)
    order = [F.col("drawable").desc(), F.col("score").desc(), F.col(key).asc(), F.col("row").asc()]
    ranged = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "scores")
    part = F.shiftright("at", 33)
    sizes = {r["part"]: (r["n"], r["d"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("drawable").alias("d")).collect()}
    most = percent * sum(d for _, d in sizes.values()) // 100
    starts, before = [], 0
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p][0]
    base = placed.sparkSession.createDataFrame(starts, "part long, start long")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = placed.withColumn("part", part).join(F.broadcast(base), "part")
    return joined.withColumn("rank", F.when(F.col("drawable") & (rank <= most), rank)).drop("part", "start", "at", "drawable")


def resampled(docs: DataFrame, target: DataFrame, buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its weight, score and rank (null: not drawn).

    key, n_features, weight, score, rank.  ``target`` is a table with a column of
    the same name for texts.  Null and empty texts have no features and weight 0;
    an empty target or table works as no counts; other columns are ignored.
    """
    source = streams(docs, buckets, key, text)
    wanted = streams(target.select(F.lit(0).alias(key), F.col(text).alias(text)), buckets, key, text)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(source, buckets))
    return drawn(weights(source, gain, key), percent, least_words, seed, key).select(key, "n_features", "weight", "score", "rank")
