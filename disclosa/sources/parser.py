"""Bytes of filings to flat events: the one place where documents pass through Python.

A file becomes one row: what it is, how it was decoded, and its titles, paragraphs and tables in order. A file that fails
is a row with ok = false and the error, never a failed job.
"""

from __future__ import annotations

import hashlib
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from disclosa.functions.text import BARE_AMP, CLOSING_TAG, SCHEMA_NAME
from disclosa.sources.schemas import PARSED

#: Tags that are cells of a filing's table.
CELL_TAGS = frozenset(("TD", "TE", "TU", "TH"))
#: HTML elements without an end.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


def sniff(raw: bytes) -> str:
    near = raw[:512]
    if re.match(rb"\s*%PDF", near):
        return "pdf"
    if re.match(rb"(?i)\s*<(?:!doctype\s+html|html\b)", near):
        return "kind_html"
    return "dart_xml" if re.match(rb"(?i)\s*<\?xml\b", near) or re.search(rb"(?i)<DOCUMENT\b", raw[:2000]) else "unknown"


def decode(raw: bytes) -> tuple[str, str | None, str]:
    """(text, declared encoding, encoding used): UTF-8 first, then what the file declares, then UTF-8 with replacements."""
    near = raw[:512]
    said = re.search(rb'(?i)<\?xml[^>]*\bencoding="([^"]+)"', near) or re.search(rb"""(?i)charset=["']?([\w-]+)""", near)
    declared = said[1].decode("ascii", "replace").lower() if said else None
    for name in ("utf-8", declared):
        if name:
            try:
                return raw.decode(name), declared, name
            except (UnicodeDecodeError, LookupError):
                continue
    return raw.decode("utf-8", "replace"), declared, "utf-8(replace)"


def differs(declared: str | None, used: str) -> bool:
    plain = lambda s: s.lower().replace("_", "-").removesuffix("(replace)")
    return bool(declared) and plain(declared) != plain(used)


def sanitize(text: str) -> tuple[str, int, int]:
    """(well-formed text, bare ampersands, bare '<'): '<' is markup only before a tag that the text also closes."""
    tags = sorted(set(re.findall(CLOSING_TAG, text)), key=lambda t: (-len(t), t))
    bare = rf"<(?!/|!|\?|(?:{'|'.join(map(re.escape, tags))})(?=[\s>/]))" if tags else r"<(?![A-Za-z/!?])"
    out, amps = re.subn(BARE_AMP, "&amp;", text)
    n_lt = len(re.findall(bare, text))
    return re.sub(bare, "&lt;", out), amps, n_lt


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _whole(e: ET.Element) -> str:
    return "".join(e.itertext()).strip()


def _span(held: str | None) -> int:
    return int(held or "1")


def xml_cells(table: ET.Element) -> list[dict]:
    out = []
    for r, tr in enumerate(table.iterfind(".//TR")):
        cells = [c for c in tr if _local(c.tag) in CELL_TAGS]
        out += [
            {"row": r, "col": k, "text": _whole(c), "rowspan": _span(c.get("ROWSPAN")), "colspan": _span(c.get("COLSPAN")), "tag": _local(c.tag)}
            for k, c in enumerate(cells)
        ]
    return out


def xml_events(root: ET.Element) -> Iterator[dict]:
    """Titles, paragraphs and tables in document order; nothing below them is visited again."""
    todo = [root]
    while todo:
        e = todo.pop()
        tag = _local(e.tag)
        if tag == "TITLE":
            yield {"kind": "section", "text": _whole(e)}
        elif tag == "P":
            if text := _whole(e):
                yield {"kind": "paragraph", "text": text}
        elif tag in ("TABLE", "TABLE-GROUP"):
            head = next((c for c in e if _local(c.tag) == "TITLE"), None) if tag == "TABLE-GROUP" else None
            caption = (_whole(head) or None) if head is not None else None
            if caption and head.get("ATOC") != "N":
                yield {"kind": "section", "text": caption}
            if cells := xml_cells(e):
                yield {"kind": "table", "caption": caption, "cells": cells}
        else:
            todo.extend(reversed(e))


class TableReader(HTMLParser):
    """The td cells of every table; a row belongs to the table it stands in, a cell to the row right above it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[list[dict]]] = []
        self.stack: list[tuple[str, object]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        held: object = None
        if tag == "table":
            held = []
            self.found.append(held)
        elif tag == "tr":
            table = next((x for t, x in reversed(self.stack) if t == "table"), None)
            if table is not None:
                held = []
                table.append(held)
        elif tag == "td" and self.stack and self.stack[-1][0] == "tr" and self.stack[-1][1] is not None:
            a = dict(attrs)
            held = {"parts": [], "rowspan": _span(a.get("rowspan")), "colspan": _span(a.get("colspan"))}
            self.stack[-1][1].append(held)
        if tag not in VOID:
            self.stack.append((tag, held))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if data.strip():
            for tag, held in self.stack:
                if tag == "td" and held:
                    held["parts"].append(data.strip())


def html_events(text: str) -> tuple[list[dict], int]:
    """(table events, tables)."""
    reader = TableReader()
    reader.feed(text)
    reader.close()
    out = []
    for table in reader.found:
        cells = [
            {"row": r, "col": k, "text": "".join(c["parts"]), "rowspan": c["rowspan"], "colspan": c["colspan"], "tag": "td"}
            for r, row in enumerate(table)
            for k, c in enumerate(row)
        ]
        if cells:
            out.append({"kind": "table", "cells": cells})
    return out, len(reader.found)


def parse_file(doc_id: str, rel_path: str, raw: bytes, expected: str | None = None) -> dict:
    """One PARSED row. expected: the kind that the manifest lets one expect; None: not known (viewers of PDF filings)."""
    kind = sniff(raw)
    row = {"doc_id": doc_id, "rel_path": rel_path, "content_format": kind, "content_sha256": hashlib.sha256(raw).hexdigest(), "ok": True, "error": None, "notes": [], "events": []}
    note = lambda code, severity, message: row["notes"].append({"code": code, "severity": severity, "message": message})
    if kind == "pdf":
        return row | {"actual_encoding_used": "n/a(binary)", "raw_chars": 0}
    text, declared, used = decode(raw)
    row |= {"declared_encoding": declared, "actual_encoding_used": used, "raw_chars": len(re.sub(r"\s+", "", re.sub(r"<[^>]+>", "", raw.decode("utf-8", "replace"))))}
    if differs(declared, used):
        note("encoding_declaration_mismatch", "warning", f"declared={declared} actual={used}")
    if expected and kind != expected:
        note("content_type_mismatch", "warning", f"expected {expected} but sniffed {kind}")
    events: list[dict] | None = None
    if kind == "dart_xml":
        name = re.search(SCHEMA_NAME, text[:400])
        row["schema_version"] = name[1] if name else "unknown"
        clean, amps, lts = sanitize(text)
        if amps or lts:
            note("sanitized_entity", "info", f"sanitized {amps} bare '&' and {lts} bare '<' before XML parse")
        try:
            events = list(xml_events(ET.fromstring(clean.encode())))
        except ET.ParseError as e:
            note("parse_failed", "error", f"XML still not well-formed after sanitization: {e}")
    elif kind == "kind_html":
        events, tables = html_events(text)
        if not tables:
            note("parse_failed", "warning", "no <table> found in KIND HTML document")
    else:
        note("parse_failed", "error", f"unrecognized content type (sniff={kind})")
    if events is None:
        plain = " ".join(re.sub(r"<[^>]+>", " ", text).split())[:20000]
        row["ok"], events = False, [{"kind": "fallback", "text": plain}]
    row["events"] = [{"seq": k} | e for k, e in enumerate(events)]
    return row


def parse_files(files: DataFrame) -> DataFrame:
    """PARSED rows of files(doc_id, rel_path, content binary, expected). Errors are rows with ok = false."""
    arrow = to_arrow_schema(_parse_datatype_string(PARSED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, rel_path, raw, expected in zip(*(batch.column(k) for k in range(4)), strict=True):
                try:
                    row = parse_file(doc_id.as_py(), rel_path.as_py(), raw.as_py() or b"", expected.as_py())
                except Exception as e:  # noqa: BLE001  one file's failure is that file's row
                    row = {"doc_id": doc_id.as_py(), "rel_path": rel_path.as_py(), "ok": False, "error": f"{type(e).__name__}: {e}", "notes": [], "events": []}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return files.select("doc_id", "rel_path", "content", "expected").mapInArrow(run, PARSED)
