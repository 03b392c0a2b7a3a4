"""Workbook reader: every sheet of every workbook as one grid.

Spark lists, reads and distributes the files; a task decodes one workbook at a time
with the standard library. A workbook is bounded by its format (1,048,576 rows by
16,384 columns per sheet), so no task can meet an unbounded one.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import NamedTuple
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstar.schemas import GRID
from cellstar.sources.csv_sheets import NULL_TEXTS
from cellstar.sources.files import WORKBOOKS

READ_SCHEMA = T.StructType([*GRID.fields, T.StructField("error", T.StringType(), True)])
ROWS_PER_BATCH = 10_000

# Parts and names of the workbook format.
_WORKBOOK = "xl/workbook.xml"
_RELATIONS = "xl/_rels/workbook.xml.rels"
_SHARED = "xl/sharedStrings.xml"
_STYLES = "xl/styles.xml"
_RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or a time, by id.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
# What a number format shows as it stands: quoted texts, escaped characters, colours and conditions.
_SHOWN_AS_IS = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)
_NO_VALUE = frozenset(NULL_TEXTS)


class Parts(NamedTuple):
    """What cells refer to: shared texts, styles that show dates, and day 0 of the workbook."""

    shared: list[str]
    dated: frozenset[int]
    epoch: datetime


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _text(element: ElementTree.Element) -> str:
    """All text runs below an element, phonetic hints left out."""
    if _tag(element) == "t":
        return element.text or ""
    return "".join(_text(child) for child in element if _tag(child) in ("t", "r", "is", "si"))


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]*", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if _SHARED not in book.namelist():
        return []
    with book.open(_SHARED) as part:
        root = ElementTree.parse(part).getroot()
    return [_text(item) for item in root]


def _dated_styles(book: zipfile.ZipFile) -> frozenset[int]:
    """Positions of the cell styles whose number format shows a date or a time."""
    if _STYLES not in book.namelist():
        return frozenset()
    root = ElementTree.fromstring(book.read(_STYLES))
    dated = set(_DATE_FORMATS)
    for form in (e for e in root.iter() if _tag(e) == "numFmt"):
        code = _SHOWN_AS_IS.sub("", form.get("formatCode", "")).split(";")[0].lower()
        number = int(form.get("numFmtId"))
        (dated.add if re.search("[dmyhs]", code) and "general" not in code else dated.discard)(number)
    styles = next((e for e in root if _tag(e) == "cellXfs"), ())
    return frozenset(i for i, style in enumerate(styles) if int(style.get("numFmtId", 0)) in dated)


def _epoch(book: zipfile.ZipFile) -> datetime:
    """Day 0 of the workbook's dates: it counts from 1900 (with a leap day too many) or from 1904."""
    settings = (e for e in ElementTree.fromstring(book.read(_WORKBOOK)) if _tag(e) == "workbookPr")
    later = any(e.get("date1904") in ("1", "true") for e in settings)
    return datetime(1904, 1, 1) if later else datetime(1899, 12, 30)


def _date(raw: str, epoch: datetime) -> str:
    """A day count as date and time; a count below one day as a time."""
    try:
        days = float(raw)
        at = epoch + timedelta(seconds=round(days * 86_400))
    except (ValueError, OverflowError):
        return raw
    return at.strftime("%H:%M:%S" if 0 <= days < 1 else "%Y-%m-%d %H:%M:%S")


def _number(raw: str) -> str:
    """Whole numbers are stored as floats now and then; show them as written."""
    try:
        value = float(raw)
    except ValueError:
        return raw
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else raw


def _cell(cell: ElementTree.Element, parts: Parts) -> str | None:
    text = _cell_text(cell, parts)
    return None if text is None or text.strip() in _NO_VALUE else text


def _cell_text(cell: ElementTree.Element, parts: Parts) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_text(c) for c in cell if _tag(c) == "is")
    raw = next((c.text for c in cell if _tag(c) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return parts.shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind != "n":
        return raw
    return _date(raw, parts.epoch) if int(cell.get("s", 0)) in parts.dated else _number(raw)


def _sheet_rows(part, parts: Parts) -> Iterator[tuple[int, list[str | None]]]:
    position = -1
    for _, row in ElementTree.iterparse(part):
        if _tag(row) != "row":
            continue
        position = int(row.get("r", position + 2)) - 1
        cells: list[str | None] = []
        for cell in row:
            if _tag(cell) != "c":
                continue
            column = _column(cell.get("r", "")) if cell.get("r") else len(cells)
            cells += [None] * (column + 1 - len(cells))
            cells[column] = _cell(cell, parts)
        yield position, cells
        row.clear()


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part name) in workbook order."""
    relations = ElementTree.fromstring(book.read(_RELATIONS))
    targets = {r.get("Id"): r.get("Target") for r in relations}
    sheets = [e for e in ElementTree.fromstring(book.read(_WORKBOOK)).iter() if _tag(e) == "sheet"]

    def part(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")

    return [(s.get("name"), part(targets[s.get(_RELATION_ID)])) for s in sheets]


def decode(path: str, content: bytes) -> Iterator[tuple]:
    """Grid records of one workbook; a sheet or file that fails yields an error record."""
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        parts = Parts(_shared_strings(book), _dated_styles(book), _epoch(book))
        named = sheet_parts(book)
    except Exception as problem:
        yield path, None, None, None, f"{type(problem).__name__}: {problem}"
        return
    for sheet, name in named:
        try:
            with book.open(name) as part:
                for position, cells in _sheet_rows(part, parts):
                    yield path, sheet, position, cells, None
        except Exception as problem:
            yield path, sheet, None, None, f"{type(problem).__name__}: {problem}"


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            for record in decode(path, content):
                held.append(record)
                if len(held) >= ROWS_PER_BATCH:
                    yield pd.DataFrame(held, columns=READ_SCHEMA.names)
                    held = []
    if held:
        yield pd.DataFrame(held, columns=READ_SCHEMA.names)


def decode_files(files: DataFrame) -> DataFrame:
    """Grid plus an ``error`` column from ``path, content`` rows."""
    return files.select("path", "content").mapInPandas(_decode_batches, READ_SCHEMA)


def read_workbooks(spark: SparkSession, folder: str, pattern: str = WORKBOOKS) -> DataFrame:
    return decode_files(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder))


def errors_of(read: DataFrame) -> DataFrame:
    """One row per file or sheet that could not be decoded."""
    return read.where(F.col("error").isNotNull()).select("source_file", "sheet", "error")


def without_errors(read: DataFrame, errors: DataFrame) -> DataFrame:
    """The grid. A sheet that failed halfway keeps none of its rows."""
    good = read.where(F.col("error").isNull()).drop("error")
    return good.join(errors.select("source_file", "sheet"), ["source_file", "sheet"], "left_anti")
