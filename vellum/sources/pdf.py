"""PDF files through external programs, where they are installed: text layer first, optical recognition after it.

Pages come out as rows (doc_id, page_no, text), read from the text layer alone, so that a file can be refused before its
text is extracted. Recognition, which takes seconds a page, is dealt out by runs of pages, not by files. Without the
programs a file becomes a reject with the reason.
"""

from __future__ import annotations

import hashlib
import os
import re
import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import trim

MIN_TEXT, DPI, LANGUAGE, SEGMENTATION = 80, 300, "por", 1
RUN = 8


class MissingProgram(RuntimeError):
    """A program that a step needs isn't installed, or failed."""


#: Where programs are looked for after a worker's own PATH: that of the driver.
also = ""


def look_in(path: str) -> None:
    global also
    also = path


def run(*command: str) -> str:
    program = shutil.which(command[0]) or shutil.which(command[0], path=also)
    if program is None:
        raise MissingProgram(f"{command[0]} is not installed")
    done = subprocess.run((program, *command[1:]), capture_output=True, text=True, errors="replace", check=False)
    if done.returncode:
        raise MissingProgram(f"{command[0]} failed: {done.stderr.strip()[:200]}")
    return done.stdout


def normalized(text: Column) -> Column:
    """Line feeds only, form feeds as paragraph breaks, trimmed."""
    return trim(F.replace(F.regexp_replace(text, "\r\n?", "\n"), F.lit("\f"), F.lit("\n\n")))


def meaningful(text: Column) -> Column:
    return F.length(trim(F.replace(text, F.lit("\n"), F.lit(" ")))) >= MIN_TEXT


def split_pages(texts: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(doc_id, page_no, text) of text layers whose pages end in form feeds; one empty page at the end is none."""
    parts = F.split("text", "\f", -1)
    parts = F.when((F.size(parts) > 0) & (trim(F.element_at(parts, -1)) == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    out = texts.select("doc_id", F.posexplode(parts).alias("page_no", "text"))
    return out if max_pages is None else out.where(F.col("page_no") < max_pages)


def page_count(path: str) -> int:
    found = re.search(r"^Pages:\s+(\d+)", run("pdfinfo", path), re.M)
    if not found:
        raise MissingProgram("pdfinfo gives no number of pages")
    return int(found[1])


def has_text_layer(path: str) -> bool:
    return sum(1 for line in run("pdffonts", path).splitlines() if line.strip()) > 2


def recognized_page(path: str, page: int) -> str:
    with tempfile.TemporaryDirectory() as folder:  # a task's own scratch space, gone when it ends
        run("pdftoppm", "-r", str(DPI), "-gray", "-f", str(page), "-l", str(page), "-singlefile", "-png", path, f"{folder}/page")
        return run("tesseract", f"{folder}/page.png", "stdout", "-l", LANGUAGE, "--psm", str(SEGMENTATION))


@contextmanager
def _file(data: bytes) -> Iterator[str]:
    with tempfile.TemporaryDirectory() as folder:  # a task's own scratch space
        path = Path(folder) / "input.pdf"
        path.write_bytes(data)
        yield str(path)


def page_texts(path: str, max_pages: int | None = None) -> list[str]:
    """The text layer page by page, without recognition."""
    some = ("-l", str(max_pages)) if max_pages is not None else ()
    pages = run("pdftotext", "-layout", *some, path, "-").split("\f")
    return pages[:-1] if pages[-1] == "" else pages


def layer_text(path: str) -> str | None:
    """The text of the layer, if there is one that holds enough."""
    if not has_text_layer(path):
        return None
    text = re.sub("\r\n?", "\n", run("pdftotext", "-layout", path, "-")).replace("\f", "\n\n").strip()
    return text if len(text.replace("\n", " ").strip()) >= MIN_TEXT else None


def read_pages(raw: DataFrame, max_pages: int | None = None) -> DataFrame:
    """raw (path, content) -> (doc_id, raw_hash, total_pages, error, page_no, text): a row for each page, or one with the error.
    raw_hash is that of the file read as text."""

    programs = os.environ.get("PATH", "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look_in(programs)
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                data = bytes(data)
                plain = re.sub("\r\n?", "\n", data.decode("utf-8", "replace"))
                row = {"doc_id": path, "raw_hash": hashlib.sha256(plain.encode()).hexdigest(), "total_pages": None, "error": None, "page_no": None, "text": None}
                try:
                    with _file(data) as file:
                        texts, total = page_texts(file, max_pages), page_count(file)
                    rows = [row | {"total_pages": total, "page_no": k, "text": t} for k, t in enumerate(texts)] or [row | {"total_pages": total, "page_no": 0, "text": ""}]
                except (MissingProgram, OSError) as e:
                    rows = [row | {"error": f"{type(e).__name__}: {e}"[:500]}]
                yield pd.DataFrame(rows).astype({"total_pages": "Int64", "page_no": "Int32"})

    return raw.select("path", "content").mapInPandas(read, "doc_id string, raw_hash string, total_pages long, error string, page_no int, text string")


def recognized(raw: DataFrame) -> DataFrame:
    """raw (path, content, pages: to be recognised) -> (path, text, error). Runs of RUN pages are tasks' rows of their own."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("pages")), F.lit(RUN))
    runs = raw.select("path", "content", "pages", F.explode(starts).alias("first")).repartition(F.col("path"), F.col("first"))

    programs = os.environ.get("PATH", "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look_in(programs)
        for batch in batches:
            out = []
            for r in batch.itertuples():
                try:
                    with _file(bytes(r.content)) as file:
                        texts = [recognized_page(file, p).strip() for p in range(r.first, min(r.pages, r.first + RUN - 1) + 1)]
                    out.append((r.path, r.first, "\n\n".join(texts), None))
                except (MissingProgram, OSError) as e:
                    out.append((r.path, r.first, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["path", "first", "text", "error"])

    rows = runs.mapInPandas(read, "path string, first int, text string, error string")
    parts = F.array_sort(F.collect_list(F.struct("first", "text")))
    joined = rows.groupBy("path").agg(trim(F.array_join(F.transform(parts, lambda x: x["text"]), "\n\n")).alias("text"), F.max("error").alias("error"))
    none = F.when(F.col("error").isNull() & (F.col("text") == ""), "MissingProgram: recognition found no text").otherwise(F.col("error"))
    return joined.select("path", F.when(none.isNull(), F.col("text")).alias("text"), none.alias("error"))
