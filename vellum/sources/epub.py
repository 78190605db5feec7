"""EPUB containers to marked text: the spine's documents in order."""

from __future__ import annotations

import io
import posixpath
import zipfile
from xml.etree import ElementTree

from .html import html_text

MARKUP = (".xhtml", ".html", ".htm")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def spine(archive: zipfile.ZipFile) -> list[str]:
    """Names of the spine's documents; empty without a readable container or package."""
    try:
        container = ElementTree.fromstring(archive.read("META-INF/container.xml"))
        package = next(e.attrib["full-path"] for e in container.iter() if _local(e.tag) == "rootfile")
        tree = ElementTree.fromstring(archive.read(package))
    except (KeyError, StopIteration, ElementTree.ParseError):
        return []
    folder = posixpath.dirname(package)
    hrefs = {e.attrib.get("id"): e.attrib.get("href", "") for e in tree.iter() if _local(e.tag) == "item"}
    order = [hrefs.get(e.attrib.get("idref")) for e in tree.iter() if _local(e.tag) == "itemref"]
    return [f"{folder}/{href}" if folder else href for href in order if href]


def epub_text(data: bytes) -> str:
    """The texts of the spine's documents that are in the archive, else of all its markup by name; empty ones are left out."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        names = set(archive.namelist())
        chosen = [n for n in spine(archive) if n in names] or sorted(n for n in names if n.lower().endswith(MARKUP))
        texts = (html_text(archive.read(n).decode("utf-8", "replace")) for n in chosen)
        return "\n\n".join(t for t in texts if t.strip())
