"""WARC archives of individually compressed records with an own dictionary.

Each archive starts with a skippable Zstandard frame that holds a dictionary
built from the archive's own first records; every record after it is one frame
compressed with that dictionary.  Equal large payloads are stored once: the
other records revisit the one that holds them.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import new_path, stored

#: Magic number of the skippable frame that holds the dictionary (a fixed value of the format).
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
#: Profile of a revisit of an equal payload (a fixed value of the format).
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records that the dictionary is built from, of the dictionary, and of an archive.
SAMPLE, DICTIONARY, ARCHIVE = 1 << 20, 32 << 10, 32 << 20
LEVEL = 3
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_headers(kind: str, record_id: str, date: str, length: int, more: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", *(f"{k}: {v}" for k, v in more), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def page_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or the revisit record of the page it refers to."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    more = [("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        more.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    more.append(("Content-Type", "application/http; msgtype=response"))
    if refers_to is not None:
        more += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        payload = b""
    body = head + payload
    return record_headers("response" if refers_to is None else "revisit", f"urn:page:{'' if page_id is None else page_id}", date, len(body), more) + body + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstd.ZstdCompressionDict:
    """A trained dictionary; the raw bytes themselves where they are too few."""
    try:
        return zstd.train_dictionary(DICTIONARY, samples, k=256, d=8)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[-DICTIONARY:], dict_type=zstd.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records into archives of bounded size under a folder."""

    def __init__(self, folder: str, name: str, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.name, self.date, self.made = name, date, 0
        self.held: list[bytes] = []
        self.size = 0
        self.out = self.compressor = None
        self.done: list[tuple[str, int, int]] = []
        self.count = self.written = 0

    def add(self, record: bytes) -> None:
        if self.compressor:
            self._put(record)
            return
        self.held.append(record)
        self.size += len(record)
        if self.size >= SAMPLE:
            self._open()

    def _open(self) -> None:
        dictionary = build_dictionary(self.held)
        raw = dictionary.as_bytes()
        self.compressor = zstd.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True)
        self.path = f"{self.folder}/{self.name}-{self.made:05d}.warc.zst"
        self.made += 1
        self.out = self.fs.open_output_stream(self.path, compression=None)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        self.written = 8 + len(raw)
        body = b"software: lexloom\r\nformat: WARC File Format 1.1\r\n"
        self._put(record_headers("warcinfo", f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.path)}", self.date, len(body), [("Content-Type", "application/warc-fields")]) + body + b"\r\n\r\n")
        self.count = 0
        held, self.held, self.size = self.held, [], 0
        for record in held:
            self._put(record)

    def _put(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.out.write(frame)
        self.written += len(frame)
        self.count += 1
        if self.written >= ARCHIVE and not self.held:
            self._end()

    def _end(self) -> None:
        self.out.close()
        self.done.append((self.path, self.count, self.written))
        self.out = self.compressor = None

    def close(self) -> list[tuple[str, int, int]]:
        if self.held:
            self._open()
        if self.out:
            self._end()
        return self.done


def frames(data: memoryview) -> Iterator[tuple[int, int]]:
    """Start and end of each frame, found from its header and block sizes."""
    at = 0
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME:
            head = bytes(data[at : at + 18])
            end = at + zstd.frame_header_size(head)
            final = False
            while not final:
                word = int.from_bytes(data[end : end + 3], "little")
                final = bool(word & 1)
                end += 3 + (1 if word >> 1 & 3 == 1 else word >> 3)
            end += 4 * zstd.get_frame_parameters(head).has_checksum
        else:
            raise ValueError(f"no frame at byte {at}")
        yield at, end
        at = end


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    view = memoryview(data)
    plain = zstd.ZstdDecompressor()
    reader = plain
    for start, end in frames(view):
        if struct.unpack_from("<I", view, start)[0] == DICTIONARY_FRAME:
            raw = bytes(view[start + 8 : end])
            if raw[:4] == struct.pack("<I", FRAME):
                raw = plain.decompress(raw)
            reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw))
            continue
        if struct.unpack_from("<I", view, start)[0] != FRAME:
            continue
        record = reader.decompress(view[start:end])
        head, _, rest = record.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield headers, rest[: int(headers["Content-Length"])]


def _page_number(uri: str) -> int | None:
    digits = uri.strip("<>").removeprefix("urn:page:")
    return int(digits) if digits else None


def page_row(headers: dict[str, str], block: bytes) -> tuple | None:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a page's record."""
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = None
    if kind == "revisit":
        refers = _page_number(headers["WARC-Refers-To"])
    elif len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    return _page_number(headers["WARC-Record-ID"]), size, digest, kind, refers


#: Repeated digests that are sent to every task, at most (40 MB); more are joined
#: by a shuffle.
SENT_DIGESTS = 1 << 19


def with_revisits(pages: DataFrame, key: str, url: str, page: str, least: int, sent: int = SENT_DIGESTS) -> DataFrame:
    """Pages with size, digest and, for repeats of a payload of ``least`` bytes
    or more, the page that holds it: the largest key of the equal ones.

    Repeated digests are found on keys, sizes and digests alone.  Where they are
    few they are sent to the tasks, and no page is moved; else pages are joined
    to them by digest, those too small to match by a key of their own, and
    adaptive execution splits a digest that many pages share.  Without a key a
    page can hold others' payload only if no equal one has a key.
    """
    base = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    base = base.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    narrow = base.where(F.col("size") >= least).select("page_id", "digest")
    held = stored(narrow.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "holder"), "repeated-digests")
    if held.count() <= sent:
        joined = base.join(F.broadcast(held), (base.digest == held.d) & (base["size"] >= least), "left")
    else:
        own = F.when(F.col("size") >= least, F.col("digest")).otherwise(F.concat(F.lit("small "), F.monotonically_increasing_id().cast("string")))
        joined = base.withColumn("own", own).join(held.hint("merge"), F.col("own") == held.d, "left")
    refers = F.when(F.col("holder") != F.coalesce("page_id", F.lit(-1) + F.col("holder")), F.col("holder"))
    joined = joined.withColumn("refers_to", refers)
    return joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("").alias("html"), "size", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", page: str = "html", least: int = 1000, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write every page into archives under ``folder``; one row per archive.

    The rows name only archives of tasks that ended well, once the result is
    stored: an attempt that is lost leaves files that no row names.  Null or
    empty payloads and null urls are written as they are; of repeated rows
    with one key each is a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = ArchiveWriter(folder, f"pages-{task.partitionId():05d}-{task.taskAttemptId()}", date)
        for batch in batches:
            for page_id, link, body, size, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer.add(page_record(page_id, link, body.encode(), size, digest, refers, date))
        if done := writer.close():
            paths, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    pafs_, path = pafs.FileSystem.from_uri(folder)
    pafs_.create_dir(path)
    return with_revisits(pages, key, url, page, least).mapInArrow(run, "path string, records long, bytes long")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The page rows of all archives that ``manifest`` names, payloads verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_stream(path, compression=None) as f:
                    data = f.read()
                rows = [r for headers, block in read_archive(data) if (r := page_row(headers, block))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return manifest.select("path").repartition("path").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared folder and read the archives back.

    One row a page: null and empty payloads are responses of no bytes, each of
    repeated rows is a record, an empty table gives an empty one, other columns
    are ignored.
    """
    folder = new_path(spark, "warc")
    listed = f"{folder}-manifest"
    write_archives(pages, folder).write.parquet(listed)
    return read_archives(spark.read.schema("path string, records long, bytes long").parquet(listed), folder)
