"""Tolerant dates.

A value is first rewritten to ``yyyy-m-d`` by a regular expression and then
cast, so the hot path never throws and catches a parser exception per row.
Text is read by an explicit, ordered list of layouts; nothing is guessed from
neighbouring rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.numbers import to_number
from rosterflow.functions.text import bind, strip

# The two workbook calendars and the serial ranges read as dates.
CALENDAR_1900 = "1899-12-30"
CALENDAR_1904 = "1904-01-01"
MAX_SERIAL = 60000
MAX_LONG_SERIAL = 600000
# The range a SQL date column accepts.
FIRST_DATE = "1753-01-01"
LAST_DATE = "9999-12-31"

_TIME = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?"
_YEAR_FIRST = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}$"
_YEAR_LAST = rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}){_TIME}$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"


def _rebuilt(text: Column, pattern: str, order: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order)).try_cast("date")


def year_first(text: Column) -> Column:
    return _rebuilt(text, _YEAR_FIRST, "$1-$2-$3")


def day_first(text: Column) -> Column:
    return _rebuilt(text, _YEAR_LAST, "$3-$2-$1")


def month_first(text: Column) -> Column:
    return _rebuilt(text, _YEAR_LAST, "$3-$1-$2")


def compact(text: Column) -> Column:
    return _rebuilt(text, _COMPACT, "$1-$2-$3")


def text_date(c: Column, *, dayfirst: bool = False) -> Column:
    """Year-first, then day- or month-first (the other order if that is no date), then compact."""
    orders = (day_first, month_first) if dayfirst else (month_first, day_first)
    readers = (year_first, *orders, compact)
    return bind(strip(c.cast("string")), lambda text: F.coalesce(*[read(text) for read in readers]))


def from_serial(days: Column, base: str = CALENDAR_1900) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def serial_date(c: Column, low: int = 1, high: int = MAX_SERIAL) -> Column:
    """Workbook serial (fraction cut) as a date; other values give null."""

    def read(x: Column) -> Column:
        inside = (x >= low) & (x <= high)
        return F.when(inside, from_serial(F.when(inside, x)))

    return bind(to_number(c), read)


def as_int(d: Column) -> Column:
    """Date as a ``YYYYMMDD`` number."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_number(c: Column) -> Column:
    """Serial, else month-first text, as ``YYYYMMDD``; unreadable is null."""
    return as_int(F.coalesce(serial_date(c), text_date(c)))


def mixed_date(c: Column, *, base: str = CALENDAR_1900, high: int = MAX_SERIAL) -> Column:
    """Day-first text, then ``YYYYMMDD`` or ``YYYYMMDD.0``, then a rounded serial from zero."""

    def serial(number: Column) -> Column:
        inside = (number >= 0) & (number <= high)
        return F.when(inside, from_serial(F.bround(F.when(inside, number), 0), base))

    return bind(strip(c.cast("string")), lambda text: F.coalesce(
        text_date(text, dayfirst=True),
        compact(F.regexp_replace(text, r"\.0$", "")),
        bind(to_number(F.replace(text, F.lit(","), F.lit("."))), serial),
    ))


def mixed_date_failed(c: Column, **options) -> Column:
    """True where a non-blank value is no date."""
    return F.coalesce(F.length(strip(c.cast("string"))) > 0, F.lit(False)) & mixed_date(c, **options).isNull()


def listed_date(c: Column) -> Column:
    """``Y-m-d``, ``d-m-Y``, ``d/m/Y``, ``Y/m/d``, then a long serial, then month-first text."""
    text = strip(c.cast("string"))
    number = to_number(text)
    inside = (number > 1) & (number < MAX_LONG_SERIAL)
    # Whole-string layouts only: no time part here.
    in_list = F.coalesce(
        _rebuilt(text, r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4"),
        _rebuilt(text, r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$", "$4-$3-$1"),
    )
    serial = F.when(inside, from_serial(F.floor(F.when(inside, number))))
    return F.coalesce(in_list, serial, text_date(text))


def compact_text(c: Column) -> Column:
    """``YYYYMMDD`` text from dashes, slashes or a fractional serial; else null."""
    text = F.regexp_replace(strip(c.cast("string")), "[-/]", "")
    number = F.when(~text.rlike(r"^\d+$"), to_number(text))
    inside = (number > 1) & (number < MAX_LONG_SERIAL)
    serial = F.date_format(from_serial(F.floor(F.when(inside, number))), "yyyyMMdd")
    return F.when(text.rlike(r"^\d{8}$"), text).when(inside, serial)


def strict_timestamp_number(c: Column) -> Column:
    """Only ``yyyy-m-d h:m:s``; any other layout is null. Result ``YYYYMMDD``."""
    text = c.cast("string")
    exact = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"), text)
    return as_int(exact.try_cast("timestamp_ntz"))


def clamp_date(d: Column, low: str = FIRST_DATE, high: str = LAST_DATE) -> Column:
    """Dates outside the accepted range become null."""
    return F.when(d.between(F.lit(low).cast("date"), F.lit(high).cast("date")), d.cast("date"))


def next_day(d: Column) -> Column:
    return F.date_add(d, 1)
