"""Expense workbooks: one ``Despesas_SIT_{number}.xlsx`` per contract.

Spark lists the files and spreads them over tasks; a task decodes one file at a time into
Arrow batches. A file counts only if it can be read to its end, so it is gone through twice, once
to see that and once to hand out its rows; a task holds the file, its shared strings and one batch.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree.ElementTree import iterparse, parse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import settings as S

HEADERS = (
    S.H_CODE,
    S.H_TYPE,
    S.H_TAX_ID,
    S.H_PAYEE,
    S.H_EXPENSE_DOC,
    S.H_DESCRIPTION,
    S.H_PAYMENT_DOC,
    S.H_PAID_ON,
    *S.H_DEBITED_ON,
    S.H_AMOUNT,
)
OK, UNREADABLE = "ok", "unreadable"
BATCH_ROWS = 8192
_BROKEN = (zipfile.BadZipFile, KeyError, ValueError, SyntaxError, IndexError, EOFError)

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# built-in number formats of the workbook standard that show a date or a time
_DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])


def read_workbooks(
    spark: SparkSession,
    path: str | Sequence[str],
    headers: Sequence[str] = HEADERS,
    glob: str = "Despesas_SIT_*.xlsx",
) -> DataFrame:
    """All rows of all workbooks as text; see ``decode_workbooks`` for the columns."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load([path] if isinstance(path, str) else list(path))
    )
    return decode_workbooks(files, headers)


def decode_workbooks(files: DataFrame, headers: Sequence[str] = HEADERS) -> DataFrame:
    """``source_file, modified, row_no, file_status, absent`` and one text column per header.

    ``absent`` lists the wanted headers the file lacks. Every file also yields one row with
    ``row_no = 0`` and no cells, so an empty or broken file is still accounted for.
    """
    wanted = list(headers)
    schema = T.StructType(
        [
            T.StructField("source_file", T.StringType()),
            T.StructField("modified", T.TimestampType()),
            T.StructField("row_no", T.LongType()),
            T.StructField("file_status", T.StringType()),
            T.StructField("absent", T.ArrayType(T.StringType())),
            *[T.StructField(h, T.StringType()) for h in wanted],
        ]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stamps = batch.column("modificationTime")
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py()

                def pack(absent: list[str], status: str, rows: list, first: int) -> pa.RecordBatch:
                    n = len(rows)
                    return pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * n, pa.string()),
                            pa.array([stamps[i]] * n, stamps.type),
                            pa.array(range(first, first + n), pa.int64()),
                            pa.array([status] * n, pa.string()),
                            pa.array([absent] * n, pa.list_(pa.string())),
                            *[pa.array([row[j] for row in rows], pa.string()) for j in range(len(wanted))],
                        ],
                        names=schema.fieldNames(),
                    )

                for part in decoded(batch.column("content")[i].as_py(), wanted):
                    yield pack(*part)

    return files.select("path", "modificationTime", "content").mapInArrow(decode, schema)


def decoded(content: bytes, wanted: list[str]) -> Iterator[tuple[list[str], str, list[list[str | None]], int]]:
    """The parts of a file, or one that says it cannot be read to its end."""
    try:
        for _ in _file_parts(content, wanted):
            pass
    except _BROKEN:
        yield [], UNREADABLE, [[None] * len(wanted)], 0
        return
    yield from _file_parts(content, wanted)


def _file_parts(content: bytes, wanted: list[str]) -> Iterator[tuple[list[str], str, list[list[str | None]], int]]:
    """``(absent headers, status, rows, first row number)`` per batch; the first is row 0 alone."""
    rows = sheet_rows(content)
    place: dict[str, int] = {}
    for column, title in next(rows, {}).items():
        place.setdefault(title, column)
    absent = [h for h in wanted if h not in place]
    columns = [place.get(h, -1) for h in wanted]
    yield absent, OK, [[None] * len(wanted)], 0
    first, held = 1, []
    for cells in rows:
        held.append([cells.get(c) for c in columns])
        if len(held) == BATCH_ROWS:
            yield absent, OK, held, first
            first, held = first + len(held), []
    if held:
        yield absent, OK, held, first


def sheet_rows(content: bytes) -> Iterator[dict[int, str]]:
    """Rows of the first worksheet, each a map from column index to cell text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        strings = _shared_strings(book) if "xl/sharedStrings.xml" in names else []
        dated = _date_styles(book) if "xl/styles.xml" in names else []
        with book.open(_first_sheet(book)) as sheet:
            table = None
            for event, element in iterparse(sheet, events=("start", "end")):
                if event == "start":
                    table = element if element.tag == f"{_MAIN}sheetData" else table
                elif element.tag == f"{_MAIN}row":
                    cells: dict[int, str] = {}
                    for at, cell in enumerate(element.iter(f"{_MAIN}c")):
                        ref = cell.get("r")
                        text = _cell_text(cell, strings, dated)
                        if text is not None:
                            cells[_column_index(ref) if ref else at] = text
                    table.clear()
                    yield cells


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = parse(book.open("xl/workbook.xml")).getroot().find(f"{_MAIN}sheets")[0]
    for rel in parse(book.open("xl/_rels/workbook.xml.rels")).getroot():
        if rel.get("Id") == sheet.get(_REL):
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise KeyError("first sheet")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = parse(book.open("xl/sharedStrings.xml")).getroot()
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.iter(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    """Whether each cell style shows a date."""
    root = parse(book.open("xl/styles.xml")).getroot()
    custom = {
        int(f.get("numFmtId")): re.search(r"[dmyh]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")), re.I)
        for f in root.iter(f"{_MAIN}numFmt")
    }
    styles = root.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in styles] if styles is not None else []
    return [i in _DATE_FORMATS or bool(custom.get(i)) for i in ids]


def _column_index(ref: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", ref).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _cell_text(cell, strings: list[str], dated: list[bool]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind != "n":
        return value
    style = int(cell.get("s", 0))
    if style < len(dated) and dated[style]:
        # day 0 of the workbook calendar
        moment = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=round(float(value) * 86400))
        return moment.strftime("%Y-%m-%d %H:%M:%S")
    number = float(value)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
