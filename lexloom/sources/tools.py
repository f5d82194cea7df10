"""Readers that call a PDF or OCR tool on an executor.

No tool is bundled.  Each call has a time limit and its own scratch folder on
the machine that makes it, which is gone when the call returns; a tool that is
missing, fails or runs out of time raises ``ToolError``, which ``files.provided``
turns into a row of the manifest.
"""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame

#: Seconds that a call may take; dots an inch and languages that OCR reads with.
SECONDS, DPI, LANGUAGES = 300, 300, "ind+eng"


class ToolError(RuntimeError):
    """A tool is missing, failed, or took too long."""


def run(command: list[str], seconds: float = SECONDS) -> bytes:
    """What a command prints."""
    if not shutil.which(command[0]):
        raise ToolError(f"{command[0]} is not installed")
    try:
        done = subprocess.run(command, capture_output=True, timeout=seconds, check=False)
    except subprocess.TimeoutExpired as e:
        raise ToolError(f"{command[0]} took more than {seconds} s") from e
    if done.returncode:
        raise ToolError(f"{command[0]} failed: {done.stderr.decode(errors='replace').strip()[:200]}")
    return done.stdout


def versions(commands: dict[str, list[str]] | None = None) -> dict[str, str]:
    """First line that each tool says of its version, or ``unknown``."""
    asked = commands or {"pdftotext": ["pdftotext", "-v"], "pdftoppm": ["pdftoppm", "-v"], "tesseract": ["tesseract", "--version"]}
    out = {}
    for name, command in asked.items():
        try:
            done = subprocess.run(command, capture_output=True, timeout=SECONDS, check=False)
            said = (done.stdout or done.stderr).decode(errors="replace").splitlines()
        except (OSError, subprocess.TimeoutExpired):
            said = []
        out[name] = said[0].strip() if said else "unknown"
    return out


def pages_of_layer(text: str) -> list[str]:
    """A whole text layer cut at form feeds, without one blank page at its end."""
    pages = text.split("\f")
    return pages[:-1] if not pages[-1].strip() else pages


def text_layer(content: bytes, command: tuple[str, ...] = ("pdftotext", "-layout")) -> list[str]:
    """The pages of a PDF file's text layer."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "in.pdf"
        path.write_bytes(content)
        return pages_of_layer(run([*command, str(path), "-"]).decode(errors="replace"))


def ocr_page(content: bytes, page: int, render: tuple[str, ...] = ("pdftoppm", "-gray", "-png", "-r", str(DPI)), read: tuple[str, ...] = ("tesseract",)) -> str:
    """The text that OCR reads on one page of a PDF file."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "in.pdf"
        path.write_bytes(content)
        run([*render, "-f", str(page), "-l", str(page), str(path), str(Path(folder) / "p")])
        images = sorted(Path(folder).glob("p*.png"))
        if not images:
            raise ToolError(f"page {page} was not rendered")
        return run([*read, str(images[0]), "-", "-l", LANGUAGES]).decode(errors="replace")


def ocr_pages(wanted: DataFrame, reader: Callable[[bytes, int], str] = ocr_page) -> DataFrame:
    """(doc_id, page, text, error): OCR readings of ``wanted`` (doc_id, page,
    content); a page that fails has an error and no text."""

    def read(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for doc, page, content in zip(batch["doc_id"], batch["page"], batch["content"], strict=True):
                try:
                    rows.append((doc, page, reader(bytes(content), int(page)), None))
                except Exception as e:  # one page's failure is a row
                    rows.append((doc, page, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "page", "text", "error"])

    return wanted.select("doc_id", "page", "content").mapInPandas(read, "doc_id string, page int, text string, error string")
