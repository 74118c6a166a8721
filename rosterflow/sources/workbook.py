"""Workbook scan: ``.xlsx`` files to rows of text cells.

A workbook is a zip and cannot be split, but a sheet has at most 1,048,576 rows,
so one file is a bounded unit of work; files are spread over tasks by their
size.  The reader streams the sheet and hands rows to Spark in small batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from functools import lru_cache
from itertools import islice
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.periods import extension
from rosterflow.sources.files import latest_file

SCHEMA = "_file string, _sheet string, _row bigint, cells array<string>"
BATCH_ROWS = 5000
BLOCK_BYTES = 1 << 18
# Number formats that show a date, and cell texts read as missing.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
MISSING_TEXTS = frozenset(
    ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
     "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)
_OFFICE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_key(name: str) -> str:
    """Sheet names compare with spaces collapsed and in lower case."""
    return " ".join(name.split()).lower()


def choose_sheet(names: Sequence[str], preferred: Sequence[str], fallback: int) -> int:
    """Index of the first sheet with a preferred name, else ``fallback``."""
    wanted = {sheet_key(p) for p in preferred}
    for i, name in enumerate(names):
        if sheet_key(name) in wanted:
            return i
    return fallback


@lru_cache(maxsize=1000)
def _without_namespace(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _local(element) -> str:
    return _without_namespace(element.tag)


def _children(book: zipfile.ZipFile, part: str, tag: str) -> list:
    if part not in book.namelist():
        return []
    return [e for e in ElementTree.fromstring(book.read(part)).iter() if _local(e) == tag]


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    """The string items, straight from the parser: a sheet may have millions, and their elements weigh far more than their texts.

    An item's text is what stands in its ``t``, its runs' ones included; phonetic hints are not part of it.
    """
    part = "xl/sharedStrings.xml"
    if part not in book.namelist():
        return []
    texts: list[str] = []
    value, reading, hints = [], False, 0

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal reading, hints
        if ":" in name:
            name = name.rpartition(":")[2]
        if name == "t":
            reading = not hints
        elif name == "si":
            value.clear()
        elif name == "rPh":
            hints += 1

    def end(name: str) -> None:
        nonlocal reading, hints
        if ":" in name:
            name = name.rpartition(":")[2]
        if name == "t":
            reading = False
        elif name == "si":
            texts.append("".join(value))
        elif name == "rPh":
            hints -= 1

    def characters(text: str) -> None:
        if reading:
            value.append(text)

    with book.open(part) as stream:
        for _ in _parsed(stream, start, end, characters):
            pass
    return texts


def _parsed(stream, start, end, characters) -> Iterator[None]:
    """Feed a part to the parser block by block; yields after each."""
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, characters
    while block := stream.read(BLOCK_BYTES):
        parser.Parse(block, False)
        yield
    parser.Parse(b"", True)
    yield


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show dates."""
    custom = {
        int(e.get("numFmtId"))
        for e in _children(book, "xl/styles.xml", "numFmt")
        if re.search("[dmyhs]", re.sub(r'\[[^\]]*\]|"[^"]*"|\\.', "", e.get("formatCode", "")), re.I)
    }
    blocks = _children(book, "xl/styles.xml", "cellXfs")
    formats = [int(x.get("numFmtId", 0)) for x in blocks[0]] if blocks else []
    return {i for i, f in enumerate(formats) if f in DATE_FORMATS or f in custom}


# Day 0 of the two calendars a workbook may use.
EPOCH = datetime(1899, 12, 30)
EPOCH_1904 = datetime(1904, 1, 1)


def _number_text(raw: str, is_date: bool, epoch: datetime = EPOCH) -> str | None:
    try:
        value = float(raw)
    except ValueError:
        return raw
    if is_date:
        try:
            moment = epoch + timedelta(days=value)
        except OverflowError:
            return None
        return str((moment + timedelta(milliseconds=0.5)).replace(microsecond=0))
    return str(int(value)) if value == int(value) else repr(value)


@lru_cache(maxsize=20_000)
def _column(letters: str) -> int:
    index = 0
    for ch in letters:
        if not ch.isalpha():
            break
        index = index * 26 + ord(ch.upper()) - 64
    return index - 1


def sheet_rows(content: bytes, preferred: Sequence[str], fallback: int) -> Iterator[tuple[str, int, list[str | None]]]:
    """``(sheet, row number from 0, cells)`` of the chosen sheet; skipped rows come out empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets = _children(book, "xl/workbook.xml", "sheet")
        chosen = sheets[choose_sheet([s.get("name") for s in sheets], preferred, fallback)]
        targets = {r.get("Id"): r.get("Target") for r in _children(book, "xl/_rels/workbook.xml.rels", "Relationship")}
        target = targets[chosen.get(_OFFICE)]
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        shared = _shared_texts(book)
        dated = _date_styles(book)
        late = any(e.get("date1904") in ("1", "true") for e in _children(book, "xl/workbook.xml", "workbookPr"))
        epoch = EPOCH_1904 if late else EPOCH
        expected = 0
        with book.open(part) as stream:
            for number, cells in _parsed_rows(stream, shared, dated, epoch):
                while cells and cells[-1] is None:
                    cells.pop()
                if not cells:
                    continue  # counted only when a later row has data
                number = expected if number is None else number
                for blank in range(expected, number):
                    yield chosen.get("name"), blank, []
                yield chosen.get("name"), number, cells
                expected = number + 1


def _parsed_rows(stream, shared: Sequence[str], dated: set[int], epoch: datetime) -> Iterator[tuple[int | None, list[str | None]]]:
    """Row number from 0 (null if the row does not tell) and cells, straight from the parser: no elements are built."""
    done: list[tuple[int | None, list[str | None]]] = []
    number, cells, kind, style, at = None, [], "n", 0, 0
    # The value of a cell is its first ``v`` or ``is``; of the latter, what stands in ``t`` outside phonetic hints.
    value, taken, inline, reading, hints = [], None, False, False, 0

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal number, cells, kind, style, at, value, taken, inline, reading, hints
        if ":" in name:
            name = name.rpartition(":")[2]
        if name == "c":
            place = attributes.get("r")
            at = _column(place.rstrip("0123456789")) if place else len(cells)
            kind, taken, inline, reading, hints = attributes.get("t", "n"), None, False, False, 0
            style = int(attributes["s"]) if "s" in attributes else 0
            value.clear()
        elif name in ("v", "is"):
            if taken is None:
                taken, inline, reading = name, name == "is", name == "v"
        elif name == "t":
            reading = inline and not hints
        elif name == "rPh":
            hints += 1
        elif name == "row":
            place, cells = attributes.get("r"), []
            number = int(place) - 1 if place else None

    def end(name: str) -> None:
        nonlocal reading, inline, hints
        if ":" in name:
            name = name.rpartition(":")[2]
        if name == "c":
            if len(cells) < at:
                cells.extend([None] * (at - len(cells)))
            cells.append(None if taken is None else _cell_text(kind, "".join(value), style in dated, shared, epoch))
        elif name in ("v", "t"):
            reading = False
        elif name == "is":
            inline = False
        elif name == "rPh":
            hints -= 1
        elif name == "row":
            done.append((number, cells))

    def characters(text: str) -> None:
        if reading:
            value.append(text)

    for _ in _parsed(stream, start, end, characters):
        yield from done
        done.clear()


def _cell_text(kind: str, value: str, is_date: bool, shared: Sequence[str], epoch: datetime = EPOCH) -> str | None:
    if kind == "s":
        text = shared[int(value)]
    elif kind == "b":
        text = str(value == "1")
    elif kind == "n":
        text = _number_text(value, is_date, epoch) if value else None
    else:
        text = value
    return None if text is None or text in MISSING_TEXTS else text


def parse_workbooks(files: DataFrame, *, preferred: Sequence[str] = (), fallback: int = 0) -> DataFrame:
    """``path, content`` of workbooks to ``_file, _sheet, _row, cells``.

    ``_row`` counts from the sheet's first row, so it orders a file without any
    shuffle.  The header, where the sheet has one, is row 0 like any other row.
    """
    names, index = tuple(preferred), fallback
    fields = pa.schema([("_file", pa.string()), ("_sheet", pa.string()), ("_row", pa.int64()), ("cells", pa.list_(pa.string()))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, path in enumerate(batch.column("path").to_pylist()):
                rows = ((path, *row) for row in sheet_rows(batch.column("content")[at].as_py(), names, index))
                while waiting := list(islice(rows, BATCH_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), fields)], schema=fields)

    return files.select("path", "content").mapInArrow(parse, SCHEMA)


def read_workbooks(
    spark: SparkSession,
    paths: str | list[str],
    *,
    preferred: Sequence[str] = (),
    fallback: int = 0,
    pattern: str | None = None,
    extensions: Sequence[str] = (".xlsx",),
    recursive: bool = False,
) -> DataFrame:
    """All workbooks at ``paths`` in one job, see :func:`parse_workbooks`.

    Files are taken by ``extensions`` (any case; an empty one takes files without
    any) or, when given, by ``pattern``.
    """
    reader = spark.read.format("binaryFile")
    if pattern is None and not any(e == "" for e in extensions):
        pattern = "{" + ",".join("*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions) + "}"
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(paths)
    if pattern is None:
        files = files.where(F.lower(extension(F.col("path"))).isin(*(e.lower() for e in extensions)))
    return parse_workbooks(files, preferred=preferred, fallback=fallback)


def read_latest_workbook(
    spark: SparkSession,
    folder: str,
    extensions: Sequence[str] = (".xlsx",),
    *,
    preferred: Sequence[str] = (),
    fallback: int = 0,
    recursive: bool = False,
) -> DataFrame:
    """The newest workbook of a folder."""
    newest = latest_file(spark, folder, extensions, recursive=recursive)
    return read_workbooks(spark, newest, preferred=preferred, fallback=fallback, pattern="*")
