"""Files as Python data sources: folders of PDFs to read, document records to write.

``spark.read.format("pdf_folder")`` lists subtrees in tasks; the driver sees the
names of the folders right below the root and no path of a file.
``df.write.format("document_records")`` writes one JSON file for each document and
the manifest in one transaction.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Tasks that share a subtree's files, by their names.
SHARES = 4
#: Marks that a download leaves beside files.
MARK = "Zone.Identifier"
#: What a manifest says of a document.
ENTRY = ("doc_id", "source_pdf", "batch", "n_pages", "methods", "classifications", "counts", "error")


def _opened(folder: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path and what stands before a path in a URI."""
    if "://" in folder or folder.startswith("file:"):
        files, path = fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
        scheme, _, rest = folder.partition(":")
        host = rest[2:].split("/", 1)[0] if rest.startswith("//") else ""
        return files, path.rstrip("/"), "file:" if scheme == "file" else f"{scheme}://{host}" if host and not path.startswith(host) else f"{scheme}://"
    return fs.LocalFileSystem(), os.path.abspath(folder), "file:"


@dataclass
class Subtree(InputPartition):
    """A folder, with all below it or only its own files, and one share of them."""

    path: str
    deep: bool
    share: int


class PdfReader(DataSourceReader):
    def __init__(self, folder: str, content: bool):
        self.folder, self.content = folder, content

    def partitions(self) -> list[Subtree]:
        files, path, _ = _opened(self.folder)
        below = [f.path for f in files.get_file_info(fs.FileSelector(path, recursive=False)) if f.type == fs.FileType.Directory]
        return [Subtree(p, deep, k) for p, deep in ((path, False), *((b, True) for b in sorted(below))) for k in range(SHARES)]

    def read(self, part: Subtree) -> Iterator[tuple]:
        files, _, prefix = _opened(self.folder)
        for f in files.get_file_info(fs.FileSelector(part.path, recursive=part.deep)):
            name = f.base_name
            if f.type != fs.FileType.File or not name.lower().endswith(".pdf") or MARK in name or zlib.crc32(f.path.encode()) % SHARES != part.share:
                continue
            content = None
            if self.content:
                with files.open_input_file(f.path) as opened:
                    content = opened.read()
            yield (prefix + f.path, f.size, content)


class PdfFolder(DataSource):
    """(path, length, content) of the PDF files below a folder, empty ones too;
    ``content`` is null with option content = false."""

    @classmethod
    def name(cls) -> str:
        return "pdf_folder"

    def schema(self) -> str:
        return "path string, length long, content binary"

    def reader(self, schema) -> PdfReader:
        return PdfReader(self.options["path"], self.options.get("content", "true").lower() != "false")


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its hidden folder, and its part of the manifest."""

    folder: str
    entries: list[dict] = field(default_factory=list)


class RecordWriter(DataSourceWriter):
    """Tasks write into hidden folders of their own; the commit moves their files
    to ``<doc_id>.json`` and then writes the manifest, whose name it replaces
    last.  A task that fails, or a job that does, leaves nothing that shows."""

    def __init__(self, folder: str):
        self.folder, self.run = folder, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Written:
        files, path, _ = _opened(self.folder)
        own = f"{path}/_{self.run}/{TaskContext.get().taskAttemptId()}"
        files.create_dir(own)
        done = Written(own)
        for row in rows:
            record = row.asDict(recursive=True)
            error = record.pop("error", None)
            if error is None:
                with files.open_output_stream(f"{own}/{record['doc_id']}.json") as out:
                    out.write(json.dumps(record, ensure_ascii=False, default=str).encode())
            done.entries.append({k: v for k, v in {**record, "error": error}.items() if k in ENTRY and v is not None})
        return done

    def commit(self, messages: list[Written | None]) -> None:
        files, path, _ = _opened(self.folder)
        entries = []
        for m in messages:
            if m is not None:
                entries += m.entries
                for f in files.get_file_info(fs.FileSelector(m.folder)):
                    files.move(f.path, f"{path}/{f.base_name}")
        entries.sort(key=lambda e: (e.get("doc_id") or "", e.get("error") or ""))
        files.create_dir(f"{path}/_{self.run}")
        with files.open_output_stream(f"{path}/_{self.run}/manifest.json") as out:
            out.write(json.dumps({"documents": entries}, ensure_ascii=False).encode())
        files.move(f"{path}/_{self.run}/manifest.json", f"{path}/manifest.json")
        files.delete_dir(f"{path}/_{self.run}")

    def abort(self, messages: list[Written | None]) -> None:
        files, path, _ = _opened(self.folder)
        if files.get_file_info(f"{path}/_{self.run}").type == fs.FileType.Directory:
            files.delete_dir(f"{path}/_{self.run}")


class DocumentRecords(DataSource):
    """One JSON file for each row, named by its doc_id, and a manifest of all; a
    row with an error is in the manifest alone."""

    @classmethod
    def name(cls) -> str:
        return "document_records"

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"])


def registered(spark: SparkSession) -> SparkSession:
    """``spark``, which knows both formats."""
    spark.dataSource.register(PdfFolder)
    spark.dataSource.register(DocumentRecords)
    return spark
