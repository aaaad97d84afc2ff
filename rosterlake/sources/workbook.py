"""Workbook scan.

``decode_workbooks`` turns ``(file, content)`` into chunks of sheet rows:

    file, sheet, book_headers, headers, first_row, is_last, rows, error

``rows`` holds up to ``CHUNK_ROWS`` rows of cell texts. Header work (routing, finding columns) is
done once per chunk, before the chunk is exploded into rows, and needs no shuffle. ``book_headers``
is the header of the workbook's first sheet. A file that cannot be read to its end gives one chunk without
a sheet, which says why in ``error``, and no other; ``landing_status`` lists what became of each file.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Mapping
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK_ROWS = 1000
SCHEMA = (
    "file string, sheet int, book_headers array<string>, headers array<string>, "
    "first_row int, is_last boolean, rows array<array<string>>, error string"
)
_TEXTS = pa.list_(pa.string())
_ARROW = pa.schema([
    ("file", pa.string()), ("sheet", pa.int32()), ("book_headers", _TEXTS), ("headers", _TEXTS), ("first_row", pa.int32()),
    ("is_last", pa.bool_()), ("rows", pa.list_(_TEXTS)), ("error", pa.string()),
])
#: Bounds on an Arrow batch of files, so that a Python worker's memory does not depend on their number and size.
BATCH_FILES, BATCH_BYTES = 1000, 8 << 20

# Texts that count as an empty cell.
EMPTY_TEXTS = frozenset(
    ["", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
     "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)
# Built-in number formats of the file format that show dates or times.
DATE_FORMATS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47])

WHOLE = re.compile(r"-?[0-9]+")

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if node.tag == MAIN + "si":
                # phonetic hints (rPh) repeat the text and are not part of it
                runs = [node.find(MAIN + "t"), *[r.find(MAIN + "t") for r in node.findall(MAIN + "r")]]
                texts.append("".join(t.text or "" for t in runs if t is not None))
                node.clear()
    return texts


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dated = set(DATE_FORMATS)
    for fmt in root.iter(MAIN + "numFmt"):
        shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", ""))
        if re.search(r"[ymdhs]", shown, re.IGNORECASE) and "general" not in shown.lower():
            dated.add(int(fmt.get("numFmtId")))
    formats = root.find(MAIN + "cellXfs")
    if formats is None:
        return set()
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in dated}


def _sheet_parts(book: zipfile.ZipFile) -> tuple[list[str], datetime]:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {link.get("Id"): link.get("Target") for link in links}
    parts = []
    for sheet in root.iter(MAIN + "sheet"):
        path = target[sheet.get(REL_ID)]
        parts.append(path.lstrip("/") if path.startswith("/") else "xl/" + path)
    props = root.find(MAIN + "workbookPr")
    from_1904 = props is not None and props.get("date1904") in ("1", "true")
    return parts, datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)


def _column(ref: str) -> int:
    """0-based column of a cell reference such as ``AB12``."""
    index = 0
    for letter in ref:
        if letter < "A":
            break
        index = index * 26 + ord(letter) - 64
    return index - 1


def _number(text: str) -> str:
    if WHOLE.fullmatch(text):  # digits stay as they are, however many
        return text
    number = float(text)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


class _Sheet:
    """Collects the finished rows of a sheet, as ``(row number, cells)``, while it is fed."""

    def __init__(self, texts: list[str], dated: set[int], epoch: datetime):
        self.texts, self.dated, self.epoch = texts, dated, epoch
        self.rows: list[tuple[int, list[str | None]]] = []
        self.number, self.cells = 0, []
        self.cell: dict[str, str] = {}
        self.text: str | None = None
        self.reading = False
        self.names: dict[str, str] = {}
        self.parser = expat.ParserCreate()
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self.start
        self.parser.EndElementHandler = self.end
        self.parser.CharacterDataHandler = self.data

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if not self.names:  # the root tells the prefix of all names
            prefix = tag.rpartition(":")[0]
            names = ("row", "c", "v", "t")
            self.names = {f"{prefix}:{n}" if prefix else n: n for n in names}
            return
        name = self.names.get(tag)
        if name == "c":
            self.cell, self.text = attributes, None
        elif name == "row":
            self.number = int(attributes.get("r", self.number + 1))
            self.cells = []
        elif name:
            self.text = self.text or ""
            self.reading = True

    def data(self, text: str) -> None:
        if self.reading:
            self.text += text

    def end(self, tag: str) -> None:
        name = self.names.get(tag)
        if name == "c":
            ref = self.cell.get("r")
            at = _column(ref) if ref else len(self.cells)
            if at > len(self.cells):
                self.cells.extend([None] * (at - len(self.cells)))
            self.cells.append(None if self.text is None else self.value(self.text))
        elif name == "row":
            self.rows.append((self.number, self.cells))
        elif name:
            self.reading = False

    def value(self, text: str) -> str | None:
        kind = self.cell.get("t", "n")
        if kind == "n":
            if int(self.cell.get("s", 0)) not in self.dated:
                return _number(text)
            moment = self.epoch + timedelta(milliseconds=round(float(text) * 86_400_000))
            return moment.strftime("%Y-%m-%d %H:%M:%S")
        if kind == "s":
            text = self.texts[int(text)]
        elif kind == "b":
            return "True" if text == "1" else "False"
        elif kind == "d":
            return datetime.fromisoformat(text).strftime("%Y-%m-%d %H:%M:%S")
        return None if kind == "e" or text in EMPTY_TEXTS else text


def _sheet_rows(book: zipfile.ZipFile, part: str, texts, dated, epoch) -> Iterator[list[str | None]]:
    """Rows of one sheet in order; empty rows at the end are left out."""
    sheet = _Sheet(texts, dated, epoch)
    shown = 0
    with book.open(part) as stream:
        for block in iter(lambda: stream.read(1 << 16), b""):
            sheet.parser.Parse(block, False)
            for number, row in sheet.rows:
                if any(v is not None for v in row):
                    for _ in range(shown + 1, number):
                        yield []
                    yield row
                    shown = number
            sheet.rows.clear()
    sheet.parser.Parse(b"", True)  # a part that stops half way is an error


def _names(row: Iterable[str | None]) -> list[str]:
    """Header names: an empty one becomes ``Unnamed: i``, a repeated one gets a number."""
    seen: dict[str, int] = {}
    names = []
    for i, text in enumerate(row):
        name = f"Unnamed: {i}" if text is None else text
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def _chunks(file: str, content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        if book.testzip():  # a damaged file is left out whole
            raise zipfile.BadZipFile(file)
        texts, dated = _shared_texts(book), _date_styles(book)
        parts, epoch = _sheet_parts(book)
        first: list[str] | None = None
        for sheet, part in enumerate(parts):
            rows = _sheet_rows(book, part, texts, dated, epoch)
            headers = _names(next(rows, []))
            first = headers if first is None else first
            held: list = []
            start = 1
            for row in rows:
                if len(held) == CHUNK_ROWS:
                    yield file, sheet, first, headers, start, False, held, None
                    start, held = start + len(held), []
                held.append(row + [None] * (len(headers) - len(row)))
            yield file, sheet, first, headers, start, True, held, None


def _batch(chunk: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(chunk, _ARROW)], schema=_ARROW)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            file, content = (batch.column(c)[at].as_py() for c in ("file", "content"))
            try:
                # nothing of a file counts before all of it is read; till then its chunks wait as Arrow, not as Python objects
                chunks = [_batch(chunk) for chunk in _chunks(file, content)]
            except Exception as err:  # whatever is wrong with one file, the others are read
                chunks = [_batch((file, None, None, None, None, True, [], f"{type(err).__name__}: {err}"[:500]))]
            yield from chunks


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers are given, by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_FILES))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def row_by_row(spark: SparkSession) -> None:
    """Have Spark read tables of chunks by rows: a batch of its column reader would hold 4,096 chunks of up to ``CHUNK_ROWS`` rows.

    It concerns tables with nested columns only.
    """
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")


def decode_workbooks(files: DataFrame) -> DataFrame:
    """Chunks of sheet rows of every workbook in ``(file, content)``; see the module for unreadable ones."""
    bounded_batches(files.sparkSession)
    return files.select("file", "content").mapInArrow(_decode, SCHEMA)


def landing_status(chunks: DataFrame) -> DataFrame:
    """One row per file: ``file``, ``status`` (read or unreadable), ``error``, ``sheets`` and ``rows``."""
    row_by_row(chunks.sparkSession)
    return chunks.groupBy("file").agg(
        F.max("error").alias("error"), F.count_distinct("sheet").alias("sheets"),
        F.sum(F.when(F.col("error").isNull(), F.size("rows")).otherwise(0)).alias("rows"),
    ).select(
        "file", F.when(F.col("error").isNull(), "read").otherwise("unreadable").alias("status"), "error", "sheets", "rows"
    )


def trim_sheet(chunks: DataFrame) -> DataFrame:
    """Drop the first and the last data row of each sheet (sub-header and total)."""
    head = F.when(F.col("first_row") == 1, 1).otherwise(0)
    tail = F.when(F.col("is_last"), 1).otherwise(0)
    kept = F.greatest(F.size("rows") - head - tail, F.lit(0))
    return chunks.withColumns({"rows": F.slice("rows", head + 1, kept), "first_row": F.col("first_row") + head})


def sheet_rows(chunks: DataFrame, *keep: str) -> DataFrame:
    """One row per sheet row: ``file, sheet, row_no, <keep…>, cells``."""
    row_by_row(chunks.sparkSession)
    return chunks.select(
        "file", "sheet", *keep, "first_row", F.posexplode("rows").alias("_at", "cells")
    ).select("file", "sheet", (F.col("first_row") + F.col("_at")).alias("row_no"), *keep, "cells")


def cell_at(position: int | Column) -> Column:
    """Cell by 0-based position; null beyond the row."""
    return F.get(F.col("cells"), F.lit(position) if isinstance(position, int) else position)


def named_cells(headers: Iterable[str], wanted: Mapping[str, str]) -> list[Column]:
    """Cells ``{target: header}`` of a report whose header order is fixed."""
    order = list(headers)
    return [cell_at(order.index(header)).alias(target) for target, header in wanted.items()]
