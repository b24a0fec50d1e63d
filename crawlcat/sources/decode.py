"""HTML bytes to text, by the first of: byte-order mark, transport, document, strict UTF-8, windows-1252."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from crawlcat.functions.http import ENCODINGS

PRESCAN = 4_096
# Where a document names its encoding.
_NAMED = (
    re.compile(rb"(?is)<meta[^>]+charset\s*=\s*[\"']?\s*([a-zA-Z0-9_\-]+)"),
    re.compile(rb"(?is)<meta[^>]+http-equiv\s*=\s*[\"']?content-type[\"']?[^>]+content\s*=\s*[\"'][^\"']*charset\s*=\s*([a-zA-Z0-9_\-]+)"),
)


def label(name: str | None) -> str | None:
    return ENCODINGS.get(name.strip().lower().replace("_", "-")) if name else None


def decode(body: bytes, transport: str | None = None) -> tuple[str, str, str, bool, int]:
    """(text, encoding, source, had a mark, replacement characters)."""
    if body[:3] == b"\xef\xbb\xbf":
        text = body[3:].decode("utf-8", "replace")
        return text, "utf-8", "bom", True, text.count("\ufffd")
    inside = next((m[1].decode("ascii") for p in _NAMED if (m := p.search(body[:PRESCAN]))), None)
    for source, name in (("transport", label(transport)), ("meta", label(inside)), ("utf8_strict", "utf-8")):
        if name:
            try:
                text = body.decode(name)
            except UnicodeDecodeError:
                continue
            return text, name, source, False, text.count("\ufffd")
    text = body.decode("windows-1252", "replace")
    return text, "windows-1252", "windows_1252_fallback", False, text.count("\ufffd")


def decoded(rows: DataFrame, key: str, body: str = "body", charset: str = "transport_charset") -> DataFrame:
    """(key, text, encoding, source, had_bom, replacement_count)."""

    def each(batches):
        for batch in batches:
            out = [decode(b or b"", c) for b, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32())))], [key, "text", "encoding", "source", "had_bom", "replacement_count"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, body, charset).mapInArrow(each, f"{key} {kind}, text string, encoding string, source string, had_bom boolean, replacement_count int")
