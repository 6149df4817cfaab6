"""Feeds: bytes to items, in Arrow batches."""

from __future__ import annotations

import codecs
import re
import xml.etree.ElementTree as ET
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.text import plain

MAX_TEXT = 400
ITEM = "title string, url string, description string, published_raw string, updated_raw string, source string"
_BOMS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
_DECLARED = re.compile(rb"""<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)["']""")


def decode(content: bytes) -> str:
    """By byte order mark, declared encoding, UTF-8, then Western ones; never fails."""
    tries = [e for mark, e in _BOMS if content.startswith(mark)]
    if (m := _DECLARED.search(content[:200])) is not None:
        tries.append(m[1].decode("ascii"))
    for e in [*tries, "utf-8", "cp1252", "latin-1"]:
        try:
            return content.decode(e)
        except (UnicodeDecodeError, LookupError):
            continue
    return content.decode("utf-8", "replace")


def local(tag) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def first(element: ET.Element, *names: str) -> str:
    """The text of the first child with text, in the document's order, that has one of the names."""
    return next((c.text.strip() for c in element if local(c.tag) in names and c.text and c.text.strip()), "")


def root_of(content: bytes) -> ET.Element | None:
    text = decode(content)
    for x in (text, re.sub(r"^\s*<\?xml[^>]*\?>", "", text)):
        try:
            return ET.fromstring(x.encode("utf-8") if "<?xml" not in x[:100] else re.sub(r"<\?xml[^>]*\?>", "", x, count=1).encode("utf-8"))
        except ET.ParseError:
            continue
    return None


def sniff(content: bytes) -> str:
    root = root_of(content)
    return {"rss": "rss", "rdf": "rss", "RDF": "rss", "feed": "atom"}.get("" if root is None else local(root.tag), "unknown")


def _rss(item: ET.Element) -> tuple[str, str, str, str, str]:
    link = first(item, "link") or next((g.text.strip() for g in item if local(g.tag) == "guid" and (g.text or "").strip().startswith("http")), "")
    return first(item, "title"), link, first(item, "description", "summary", "encoded"), first(item, "pubDate", "date", "published"), first(item, "updated", "modified")


def _atom(entry: ET.Element) -> tuple[str, str, str, str, str]:
    links = [c for c in entry if local(c.tag) == "link" and c.get("href")]
    best = next((c for c in links if c.get("rel", "alternate") == "alternate"), links[0] if links else None)
    return first(entry, "title"), "" if best is None else best.get("href"), first(entry, "summary", "content", "subtitle"), first(entry, "published", "issued"), first(entry, "updated")


def items(content: bytes, base: str = "", max_items: int = 200) -> list[tuple]:
    """RSS 2.0, RSS 1.0 and Atom items as in ITEM; none for anything else. An item without title and link is dropped
    and doesn't count against the limit."""
    root = root_of(content or b"")
    if root is None:
        return []
    kind = {"feed": ("entry", _atom), "rss": ("item", _rss), "rdf": ("item", _rss), "RDF": ("item", _rss)}.get(local(root.tag))
    if kind is None:
        return []
    channel = next((c for c in root.iter() if local(c.tag) == "channel"), root)
    source, out = plain(first(channel, "title")), []
    for e in root.iter():
        if local(e.tag) == kind[0]:
            title, link, text, published, updated = kind[1](e)
            if title or link:
                out.append((plain(title), urljoin(base, link) if link else "", plain(text)[:MAX_TEXT], published or updated, updated, source))
                if len(out) >= max_items:
                    break
    return out


def parse(payloads: DataFrame, max_items: int = 200) -> DataFrame:
    """payloads (url, content) to items; unreadable payloads give none."""

    def run(batches):
        for b in batches:
            rows = [(u, *i) for u, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for i in items(c or b"", u or "", max_items)]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["feed", "title", "url", "description", "published_raw", "updated_raw", "source"])

    return payloads.select("url", "content").mapInArrow(run, "feed string, " + ITEM)


def read_files(spark, path: str, max_items: int = 200) -> DataFrame:
    """Feeds kept as files, for example file:// sources."""
    return parse(spark.read.format("binaryFile").load(path).selectExpr("path as url", "content"), max_items)
