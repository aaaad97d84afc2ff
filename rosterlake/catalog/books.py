"""Writes small workbooks inside Spark tasks, as input for the workbook scan."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping
from datetime import datetime
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame

from rosterlake.sources.workbook import bounded_batches

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def _cell(value: str | None, kind: str) -> str:
    if value is None:
        return "<c/>"
    if kind == "number":
        return f"<c><v>{value}</v></c>"
    if kind == "date":
        days = (datetime.fromisoformat(value) - datetime(1899, 12, 30)).total_seconds() / 86_400
        return f'<c s="1"><v>{days!r}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def encode_workbook(sheets, kinds: Mapping[str, str]) -> bytes:
    """Bytes of a workbook; ``sheets`` are ``(headers, rows)``, ``kinds`` types columns by header."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(
            f'<sheet name="s{i}" sheetId="{i}" r:id="r{i}"/>' for i in range(1, len(sheets) + 1)
        )
        links = "".join(
            f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
        )
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}">{links}</Relationships>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{NS}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        for i, (headers, rows) in enumerate(sheets, 1):
            lines = ["<row>" + "".join(_cell(h, "text") for h in headers) + "</row>"]
            typed = [kinds.get(h, "text") for h in headers]
            for row in rows:
                lines.append("<row>" + "".join(map(_cell, row, typed)) + "</row>")
            book.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
            )
    return out.getvalue()


def encode_workbooks(books: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``(file, sheets array<struct<headers, rows>>)`` to ``(file, content)``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # cells become Python objects for one workbook at a time
                sheets = batch.column("sheets")[at].as_py()
                content = encode_workbook([(s["headers"], s["rows"]) for s in sheets], kinds)
                yield pa.RecordBatch.from_arrays([batch.column("file").slice(at, 1), pa.array([content])], ["file", "content"])

    bounded_batches(books.sparkSession)
    return books.select("file", "sheets").mapInArrow(encode, "file string, content binary")
