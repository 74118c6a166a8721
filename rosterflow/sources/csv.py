"""CSV scan that finds each file's encoding, separator and header by itself, and splits large files.

Spark's text source cuts files into byte ranges at line ends.  Whether a line end
also ends a record depends on what stands before it: it may lie in a quoted cell.
A first pass therefore tells for every range what comes out of it under both
states it can start in (outside or inside quotes) and for every separator; put
together in the order of a file, which needs a few numbers per range, they give
each range its true state and the number of its first record.  A second pass
parses every range from there.  A record that lies across a border leaves its
pieces, which are joined afterwards.  No task holds more than a batch of lines.
"""

from __future__ import annotations

import csv as parser
import io
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import text_date
from rosterflow.functions.numbers import local_number
from rosterflow.functions.text import header_name
from rosterflow.operators.headers import make_unique, unquote_text
from rosterflow.session import scratch, settle

# Separators in order of preference, and the encoding of files that are not UTF-8.
SEPARATORS = (";", ",", "\t")
OTHER_ENCODING = "ISO-8859-1"

BATCH_ROWS = 5000
# Lines after which the states that the two starts of a range lead to are compared, first and then again.
FEW_LINES, MANY_LINES = 16, 512
# Ranges up to this many (some 50 MB) are sent to the tasks; beyond, lines are brought to their range by a sort.
BROADCAST_RANGES = 500_000
# Tasks per core where the size of ranges is given.
RANGE_TASKS = 4
MARK = b"\xef\xbb\xbf"

_FACTS = "file string, start long, head binary, utf8 boolean, outside array<struct<state:int,records:long>>, inside array<struct<state:int,records:long>>"
_RANGES = "file string, start long, state int, ends int, record long, separator string, utf8 boolean, width int, records long, names array<string>"
_PARSED = "range long, _row long, cells array<string>, extra array<string>, open boolean"
_PARSED_FIELDS = pa.schema(
    [("range", pa.int64()), ("_row", pa.int64()), ("cells", pa.list_(pa.string())), ("extra", pa.list_(pa.string())), ("open", pa.bool_())]
)
OUTSIDE, INSIDE = 0, 1


def _pieces(line: str) -> Iterator[str]:
    """A line as the parser takes it: a carriage return alone ends a record, too."""
    return io.StringIO(line + "\n", newline="") if "\r" in line else iter((line + "\n",))


def _cells(line: str, separator: str) -> list[str]:
    return next(parser.reader([line], delimiter=separator), [])


def choose_separator(head: str, separators: Sequence[str]) -> int:
    """Index of the separator that yields most columns; the earlier one on a tie."""
    return max(range(len(separators)), key=lambda i: len(_cells(head, separators[i])))


def after_lines(lines: list[str], separator: str, state: int) -> tuple[int, int]:
    """The state behind lines of which the first one starts in ``state``, and how many records start in them (blank ones are none)."""
    whole = "\n".join(lines)
    if '"' not in whole:
        plain = [line.rstrip("\r") for line in lines] if "\r" in whole else lines
        if plain is lines or not any("\r" in line for line in plain):
            return state, sum(map(bool, plain)) if state == OUTSIDE else 0
    pieces = chain.from_iterable(map(_pieces, lines)) if "\r" in whole else (line + "\n" for line in lines)
    if state == INSIDE:
        pieces = chain(('"' + next(pieces),), pieces)
    records, last = 0, []
    # What follows the lines is a record of its own unless they end inside quotes.
    for row in parser.reader(chain(pieces, ("x",)), delimiter=separator):
        records += bool(last)
        last = row
    ends = OUTSIDE if last == ["x"] else INSIDE
    return ends, records + (ends == INSIDE) - (state == INSIDE)


def after_line(line: str, separator: str, state: int) -> tuple[int, int]:
    return after_lines([line], separator, state)


class Facts:
    """What a byte range does to the state and to the count of records, under every start and separator."""

    def __init__(self, file: str, start: int, separators: Sequence[str]):
        self.file, self.start, self.separators = file, start, separators
        self.utf8, self.head, self.head_open, self.first = True, b"", start == 0, start == 0
        self.tracks = [[[OUTSIDE, 0] for _ in separators], [[INSIDE, 0] for _ in separators]]

    def take(self, lines: list[bytes]) -> None:
        if self.utf8:
            try:
                b"\n".join(lines).decode("utf-8")
            except UnicodeDecodeError:
                self.utf8 = False
        if self.first:
            lines, self.first = [lines[0].removeprefix(MARK), *lines[1:]], False
        for line in lines:
            if not self.head_open:
                break
            self._head(line)
        texts = [line.decode("latin-1") for line in lines]
        # The two starts mostly come to one state within a record or two; from there on lines are parsed once for both.
        ends = [*range(FEW_LINES, len(texts), MANY_LINES), len(texts)]
        for s, separator in enumerate(self.separators):
            for a, b in zip([0, *ends], ends):
                known = {}
                for track in (self.tracks[0][s], self.tracks[1][s]):
                    if track[0] not in known:
                        known[track[0]] = after_lines(texts[a:b], separator, track[0])
                    track[0], more = known[track[0]]
                    track[1] += more

    def _head(self, line: bytes) -> None:
        """Lines are the header's until its record ends; blank ones before it are none."""
        if not self.head:
            if not line.strip(b"\r"):
                return
            self.separator = self.separators[choose_separator(line.decode("latin-1").rstrip("\r"), self.separators)]
            self.state = OUTSIDE
        self.head += line + b"\n"
        self.state, _ = after_line(line.decode("latin-1"), self.separator, self.state)
        self.head_open = self.state == INSIDE

    def row(self) -> tuple:
        outside, inside = ([{"state": a, "records": n} for a, n in tracks] for tracks in self.tracks)
        # A header that is still open at the range's end is none that can be read.
        return self.file, self.start, None if self.head_open or not self.head else self.head, self.utf8, outside, inside


def _runs(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[tuple, list[bytes]]]:
    """The lines of a batch by consecutive values of the columns ``names``."""
    values, columns = batch.column("value").to_pylist(), [batch.column(n) for n in names]
    changes = np.zeros(max(0, len(values) - 1), bool)
    for column in columns:
        changes |= np.diff(np.asarray(column.dictionary_encode(null_encoding="encode").indices)) != 0
    bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), len(values)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield tuple(c[a].as_py() for c in columns), values[a:b]


def _facts(lines: DataFrame, separators: Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser.field_size_limit((1 << 31) - 1)
        facts = None
        columns = [n.split(" ")[0] for n in ("file", "start", "head", "utf8", "outside", "inside")]

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(columns, facts.row()))], schema=kinds)

        pair = pa.list_(pa.struct([("state", pa.int32()), ("records", pa.int64())]))
        kinds = pa.schema([("file", pa.string()), ("start", pa.int64()), ("head", pa.binary()), ("utf8", pa.bool_()), ("outside", pair), ("inside", pair)])
        for batch in batches:
            for key, values in _runs(batch, ("file", "start")):
                if facts is None or (facts.file, facts.start) != key:
                    if facts is not None:
                        yield told()
                    facts = Facts(*key, separators)
                facts.take(values)
        if facts is not None:
            yield told()

    return lines.select("value", "file", "start").mapInArrow(run, _FACTS)


def compose(facts: pd.DataFrame, separators: Sequence[str]) -> pd.DataFrame:
    """The ranges of a file in order: state, number of the first record, and what the header says."""
    facts = facts.sort_values("start")
    names = [c.split(" ")[0] for c in _RANGES.split(", ")]
    head, utf8 = facts["head"].iloc[0], bool(facts["utf8"].all())
    if head is None:
        if facts["outside"].map(lambda x: max(y["records"] for y in x)).sum():
            raise ValueError(f"the header of {facts['file'].iloc[0]} does not end within its first range")
        return pd.DataFrame([], columns=names)
    parser.field_size_limit((1 << 31) - 1)
    text = head.decode("utf-8" if utf8 else OTHER_ENCODING)
    at = choose_separator(text.split("\n", 1)[0].rstrip("\r"), separators)
    columns = make_unique(header_name(c.strip().strip('"')) for c in next(parser.reader(io.StringIO(text, newline=""), delimiter=separators[at])))
    rows, state, record = [], OUTSIDE, 0
    for file, start, outside, inside in zip(facts["file"], facts["start"], facts["outside"], facts["inside"]):
        told = (inside if state == INSIDE else outside)[at]
        rows.append([file, start, state, told["state"], record, separators[at], utf8, len(columns), 0, columns])
        state, record = told["state"], record + told["records"]
    for row in rows:
        row[8] = record - 1
    return pd.DataFrame(rows, columns=names)


class Range:
    """Parses the lines of one range: whole records, and the raw pieces of those that lie across its borders."""

    def __init__(self, key: tuple, strict: bool):
        self.number, self.state, self.ends, self.record, self.separator, self.utf8, self.width, self.start = key
        self.strict, self.raw = strict, []

    def _fed(self, lines: Iterator[bytes]) -> Iterator[str]:
        encoding, first = "utf-8" if self.utf8 else OTHER_ENCODING, self.start == 0
        opening = '"' if self.state == INSIDE else ""
        for line in lines:
            text = (line.removeprefix(MARK) if first else line).decode(encoding)
            first = False
            for piece in _pieces(text):
                self.raw.append(piece)
                yield opening + piece
                opening = ""

    def rows(self, lines: Iterator[bytes]) -> Iterator[tuple]:
        """``(range, row, cells, extra, open)``; of an open row ``cells`` holds raw text."""
        number = self.record - (self.state == INSIDE)
        waiting = None
        for cells in parser.reader(self._fed(lines), delimiter=self.separator):
            raw, self.raw = self.raw, []
            if waiting is not None:
                yield from self._row(*waiting, last=False)
            waiting = None
            if cells:
                waiting = number, cells, raw, number < self.record
                number += 1
        if waiting is not None:
            yield from self._row(*waiting, last=True)

    def _row(self, number: int, cells: list[str], raw: list[str], before: bool, last: bool) -> Iterator[tuple]:
        if before or (last and self.ends == INSIDE):
            yield self.number, number, ["".join(raw)], None, True
        elif number:
            yield (self.number, *cut(number, cells, self.width, self.strict), False)


def cut(number: int, cells: list[str], width: int, strict: bool) -> tuple[int, list[str], list[str] | None]:
    """A record's number, its cells, and those beyond the header if one of them is not blank."""
    extra = cells[width:] if any(c.strip() for c in cells[width:]) else None
    if extra and strict:
        raise ValueError(f"more cells than columns in row {number}: {cells}")
    return number, cells[:width], extra


_KEY = ("range", "state", "ends", "record", "separator", "utf8", "width", "start")


def _parsed(lines: DataFrame, strict: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser.field_size_limit((1 << 31) - 1)
        source = (item for batch in batches for item in _runs(batch, _KEY))
        ahead = next(source, None)
        waiting = []

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), _PARSED_FIELDS)], schema=_PARSED_FIELDS)

        while ahead is not None:
            key = ahead[0]
            if key[0] is None:
                raise RuntimeError("a file has changed, or was cut in another way, between the two passes over it")

            def own() -> Iterator[bytes]:
                nonlocal ahead
                while ahead is not None and ahead[0] == key:
                    yield from ahead[1]
                    ahead = next(source, None)

            for row in Range(key, strict).rows(own()):
                waiting.append(row)
                if len(waiting) == BATCH_ROWS:
                    yield table()
                    waiting = []
        if waiting:
            yield table()

    return lines.select("value", *_KEY).mapInArrow(run, _PARSED)


def _joined(pieces: DataFrame, strict: bool) -> DataFrame:
    """Rows from the pieces of records across borders, in the order of the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser.field_size_limit((1 << 31) - 1)
        for batch in batches:
            rows = []
            for number, row, text, separator, width in zip(*[c.to_pylist() for c in batch.columns]):
                cells = next(parser.reader(io.StringIO(text, newline=""), delimiter=separator))
                rows.append((number, *cut(row, cells, width, strict), False))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _PARSED_FIELDS)], schema=_PARSED_FIELDS)

    ordered = F.array_sort(F.collect_list(F.struct("start", F.col("cells")[0].alias("text"))))
    whole = pieces.groupBy("file", "_row", "separator", "width").agg(
        F.min("range").alias("range"), F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text")
    )
    return whole.where("_row > 0").select("range", "_row", "text", "separator", "width").mapInArrow(run, _PARSED)


@contextmanager
def _cut_alike(spark: SparkSession, range_bytes: int | None) -> Iterator[None]:
    """Both passes see the same ranges, whatever executors come and go between them."""
    conf = {"spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism)}
    if range_bytes:
        conf |= {"spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.openCostInBytes": str(range_bytes)}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plain_path(path: str) -> Column:
    """A path as it is, from the escaped form of file metadata."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _scan(spark: SparkSession, paths: str | list[str], separators: Sequence[str], recursive: bool, strict: bool, range_bytes: int | None):
    """The parsed rows by range, and the ranges."""
    known = tuple(separators)
    reader = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").option("recursiveFileLookup", str(recursive).lower()).option("lineSep", "\n")
    lines = reader.text(paths).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    if range_bytes:
        # Small ranges share tasks; a task takes them one after the other.
        lines = lines.coalesce(RANGE_TASKS * spark.sparkContext.defaultParallelism)
    with scratch():
        with _cut_alike(spark, range_bytes):
            facts = settle(_facts(lines, known), "csv-facts")
            ranges = facts.groupBy("file").applyInPandas(lambda x: compose(x, known), _RANGES)
            ranges = settle(ranges.withColumn("range", F.monotonically_increasing_id()), "csv-ranges", outlives=True)
            told = ranges.select("file", *_KEY)
            if ranges.count() <= BROADCAST_RANGES:
                placed = lines.join(F.broadcast(told), ["file", "start"], "left")
            else:
                numbered = lines.withColumn("_at", F.monotonically_increasing_id())
                placed = numbered.join(told, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "_at")
            # A file without a header has no ranges; its lines are blank.
            placed = placed.where(F.col("range").isNotNull() | (F.length(F.trim(F.translate(F.col("value").cast("string"), "\r", ""))) > 0))
            rows = settle(_parsed(placed, strict), "csv", outlives=True)
        # Settled rows are read in splits of the usual size, whatever the ranges of the lines.
        pieces = rows.where("open").drop("open").join(ranges.select("file", "start", "range", "separator", "width"), "range")
        joined = settle(_joined(pieces, strict), "csv-joined", outlives=True)
    return rows.where("not open").unionByName(joined).drop("open"), ranges


def scan_csv(
    spark: SparkSession, paths: str | list[str], *, separators: Sequence[str] = SEPARATORS, recursive: bool = True, strict: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Every row of the ``.csv`` files at ``paths``: ``_file, _row, names, cells, extra``.

    ``_file`` is the path as it is, with nothing escaped; ``_row`` counts a file's
    records from 1, blank lines are none.  ``extra`` holds cells beyond the header,
    null where there are none or only blank ones; with ``strict`` such a row stops
    the scan.  ``range_bytes`` is the size of the byte ranges, without it Spark's own.
    """
    rows, ranges = _scan(spark, paths, separators, recursive, strict, range_bytes)
    return _with_names(rows, ranges)


def _with_names(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    return rows.join(ranges.select("range", _plain_path("file").alias("_file"), "names"), "range").select("_file", "_row", "names", "cells", "extra")


def overlong_rows(scanned: DataFrame) -> DataFrame:
    """The rows of a scan with more cells than their header: ``_file, _row, extra``."""
    return scanned.where(F.size("extra") > 0).select("_file", "_row", "extra")


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    *,
    separators: Sequence[str] = SEPARATORS,
    dates: Iterable[str] = (),
    numbers: Iterable[str] = (),
    wholes: Iterable[str] = (),
    dayfirst: bool = True,
    strict: bool = True,
    range_bytes: int | None = None,
) -> DataFrame:
    """All CSV files at ``paths`` as text columns with technical names, ``_file`` and ``_row``.

    Blank cells are empty strings; a column that a file lacks is null in its rows.
    Columns listed in ``dates``, ``numbers`` (local number format) and ``wholes`` are
    converted.  A row with more cells than its header stops the scan; without
    ``strict`` they stand in ``_extra``.  The rows are settled: ``_row`` means the same
    in every later pass.
    """
    rows, ranges = _scan(spark, paths, separators, True, strict, range_bytes)
    layouts = [r["names"] for r in ranges.where("records > 0").select("names").distinct().collect()]
    if not layouts:
        raise FileNotFoundError("no CSV file with a header and rows")
    # Names in the order in which they stand in the headers.
    names = sorted({n for layout in layouts for n in layout}, key=lambda n: (min(x.index(n) for x in layouts if n in x), n))

    def cell(name: str) -> Column:
        if len(layouts) == 1:
            return F.coalesce(F.get("cells", F.lit(names.index(name))), F.lit(""))
        at = F.array_position("names", name).cast("int")
        return F.when(at > 0, F.coalesce(F.get("cells", at - 1), F.lit("")))

    placed = _with_names(rows, ranges).select("_file", "_row", *[cell(n).alias(n) for n in names], *([] if strict else [F.col("extra").alias("_extra")]))
    df = unquote_text(placed)
    changes = {c: text_date(F.col(c), dayfirst=dayfirst) for c in dates if c in names}
    changes |= {c: local_number(F.col(c)) for c in numbers if c in names}
    changes |= {c: F.col(c).try_cast("bigint") for c in wholes if c in names}
    return df.withColumns(changes) if changes else df
