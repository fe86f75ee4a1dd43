"""Text of documents: charsets of plain texts and the text layer of PDF files."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decoded(content: Column) -> Column:
    """Bytes of a plain text as text: by a byte order mark, else UTF-8 where it is valid, else Latin-1, which cannot fail."""
    marked8, le, be = (F.startswith(F.hex(content), F.lit(m)) for m in ("EFBBBF", "FFFE", "FEFF"))
    utf16 = F.when(le, F.decode(F.substring(content, 3, 1 << 30), "UTF-16LE")).when(be, F.decode(F.substring(content, 3, 1 << 30), "UTF-16BE"))
    utf8 = F.decode(F.when(marked8, F.substring(content, 4, 1 << 30)).otherwise(content), "UTF-8")
    return F.when(le | be, utf16).when(F.is_valid_utf8(content.cast("string")), utf8).otherwise(F.decode(content, "ISO-8859-1"))


# --- text layers ---------------------------------------------------------------------------------

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.DOTALL)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOWN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\bT[jJ*dDm]\b|['\"](?=\s)", re.DOTALL)
_ESCAPE = re.compile(rb"\\(\d{1,3}|\r\n|.)", re.DOTALL)
_NAMED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r\n": b""}


def _string(token: bytes) -> str:
    """A PDF string as text: UTF-16 where marked so, else byte by byte."""
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _NAMED.get(m[1], m[1]), token[1:-1])
    return raw[2:].decode("utf-16-be", "replace") if raw.startswith(b"\xfe\xff") else raw.decode("cp1252", "replace")


def _shown(content: bytes) -> str:
    """Strings that a content stream shows, a line a text-positioning operator."""
    lines: list[list[str]] = [[]]
    held: list[str] = []
    for m in _SHOWN.finditer(content):
        token = m[0]
        if token[:1] in b"(<":
            held.append(_string(token))
            continue
        if token in (b"Tj", b"TJ"):
            lines[-1] += held
        else:
            lines.append(held if token in (b"'", b'"') else [])
        held = []
    return "\n".join("".join(x) for x in lines if x).strip()


def pages_of(pdf: bytes) -> list[str]:
    """Text of each page of an unencrypted PDF, in the order of its page objects; ValueError if it is none."""
    if not pdf.startswith(b"%PDF-"):
        raise ValueError("not a PDF file")
    objects = {int(m[1]): m[2] for m in _OBJECT.finditer(pdf)}
    pages = []
    for body in objects.values():
        if re.search(rb"/Type\s*/Page\b(?!s)", body):
            where = re.search(rb"/Contents\s*(?:\[([^\]]*)\]|(\d+\s+\d+\s+R))", body)
            numbers = [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", where[1] or where[2])] if where else []
            pages.append(_shown(b"\n".join(_content(objects.get(n, b"")) for n in numbers)))
    return pages


def _content(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if not m:
        return b""
    return zlib.decompress(m[1]) if b"/FlateDecode" in body[: m.start()] else m[1]


def _layer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for content in b.column(1).to_pylist():
            try:
                pages = pages_of(content or b"")
                rows.append(("\n\n".join(p for p in pages if p), len(pages), None))
            except (ValueError, zlib.error) as e:
                rows.append((None, None, str(e)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.string()), strict=True))], ["id", "text", "page_count", "error"])


def text_layer(files: DataFrame, key: str, content: str) -> DataFrame:
    """id, text (pages joined by an empty line, empty ones left out), page_count and error of PDF files."""
    kind = files.schema[key].dataType.simpleString()
    return files.select(F.col(key).alias("id"), F.col(content).alias("content")).mapInArrow(_layer, f"id {kind}, text string, page_count int, error string")
