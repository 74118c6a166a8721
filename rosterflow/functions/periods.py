"""Periods and file names. Every function gives null, never an error, when no period is found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.text import bind, match_form

# Spanish month words and abbreviations.
MONTHS = {
    "ENERO": "01", "ENE": "01",
    "FEBRERO": "02", "FEB": "02",
    "MARZO": "03", "MAR": "03",
    "ABRIL": "04", "ABR": "04",
    "MAYO": "05", "MAY": "05",
    "JUNIO": "06", "JUN": "06",
    "JULIO": "07", "JUL": "07",
    "AGOSTO": "08", "AGO": "08",
    "SEPTIEMBRE": "09", "SETIEMBRE": "09", "SEP": "09", "SET": "09",
    "OCTUBRE": "10", "OCT": "10",
    "NOVIEMBRE": "11", "NOV": "11",
    "DICIEMBRE": "12", "DIC": "12",
}
# Extra abbreviations that some senders use.
EXTRA_MONTHS = {"SEPT": "09"}
# The year and month layouts looked for, in this order.
YEAR = r"(20\d{2})"
MONTH = r"(0[1-9]|1[0-2])"
SEPARATOR = r"[-_/.\s]?"
# Canonical file names by source; {p} is the period.
NAME_TEMPLATES = {
    "planes": "Facturacion_Cesantia_{p}.xlsx",
    "ripley_fraud": "Base Fraude RIPLEY {p}.xlsx",
    "itau_fraud": "Bases Fraude {p}.xlsx",
    "servihabit": "{p} Nomina Cesantia.xlsx",
    "concreces": "{p} CONCRECES Nominas cesantia.xlsx",
    "colmena": "{p} Cesantia Plus.xlsx",
    "unidad_leasing": "UNIDAD LEASING - Cesantia - {p}.xlsx",
    "marsh_legacy": "SC_MARSH{p}.xlsx",
    "planes_legacy": "SURA Planes {p}.xlsx",
}
# Fixed value: what a leasing file name carries when its period is unknown.
UNKNOWN_PERIOD = "000000"


def _found(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)[/\\]*$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"(?<=.)(\.[^.]+)$", 1)


def plain_period(name: Column) -> Column:
    """First ``20YYMM`` in the text, as text."""
    return _found(F.regexp_extract(name, f"{YEAR}{MONTH}", 0))


def _month_from_words(text: Column, words: dict[str, str]) -> Column:
    # Word order in the table is calendar order, so "first word of the table that
    # occurs" is the smallest month among all the words that occur.
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    pattern = "(?<![A-Z0-9])(" + "|".join(words) + ")(?![A-Z0-9])"
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_min(F.transform(hits, lambda w: F.element_at(table, w)))


def period_from_name(name: Column, *, extra_words: bool = False) -> Column:
    """``YYYYMM`` from a file name: digits together, year-month, month-year, year with a month word."""
    month_first = MONTH + SEPARATOR + YEAR
    words = {**MONTHS, **EXTRA_MONTHS} if extra_words else MONTHS
    return bind(match_form(stem(name)), lambda text: F.coalesce(
        plain_period(text),
        _found(F.regexp_replace(F.regexp_extract(text, YEAR + SEPARATOR + MONTH, 0), r"\D", "")),
        _found(F.concat(F.regexp_extract(text, month_first, 2), F.regexp_extract(text, month_first, 1))),
        F.concat(_found(F.regexp_extract(text, YEAR, 1)), _month_from_words(text, words)),
    ))


def canonical_name(period: Column, source: str) -> Column:
    """The source's canonical file name; null for an unknown period unless the source names one."""
    if source == "unidad_leasing":
        period = F.coalesce(period, F.lit(UNKNOWN_PERIOD))
    before, after = NAME_TEMPLATES[source].split("{p}")
    return F.concat(F.lit(before), period, F.lit(after))


def canonical_in_place(name: Column) -> Column:
    """Put ``YYYYMM`` where "month year" stands, or append it; names that have it stay as they are."""
    # Here a month counts even inside a longer word, so the abbreviations suffice; the
    # look-ahead lets neighbouring hits overlap.
    short = {word: number for word, number in MONTHS.items() if len(word) == 3}
    table = F.create_map(*[F.lit(x) for pair in short.items() for x in pair])
    spoken = "(?i)(" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")\s*[-_/.,]*\s*(20\d{2})"

    def spoken_period(text: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit("(?=(" + "|".join(short) + "))"), F.lit(1))
        month = F.array_min(F.transform(hits, lambda w: F.element_at(table, w)))
        return F.concat(_found(F.regexp_extract(text, YEAR, 1)), month)

    def rewrite(original: Column) -> Column:
        period = bind(match_form(original), spoken_period)
        return F.when(plain_period(original).isNotNull(), original).otherwise(
            bind(period, lambda p: F.when(p.isNull(), original)
                 .when(original.rlike(spoken), F.regexp_replace(original, F.lit(spoken), p))
                 .otherwise(F.concat_ws(" ", original, p)))
        )

    return F.concat(bind(stem(name), rewrite), extension(name))


def policy_from_name(name: Column) -> Column:
    """The seven digits that end the stem; one other character may follow them."""
    return _found(F.regexp_extract(stem(name), r"(\d{7})(?=\D?$)", 1))


def trailing_period(name: Column) -> Column:
    """The six characters before the last dot; null where there are fewer, or no dot."""
    before = F.length(name) - F.length(F.substring_index(name, ".", -1)) - 1
    return F.when(before >= 6, F.substring(name, before - 5, F.lit(6)))


def valid_period(text: Column) -> Column:
    """A period as an integer; null unless it reads 20YYMM with a real month."""
    text = text.cast("string")
    # Six characters that make so large a number are six digits: no pattern is needed.
    number = F.when(F.length(text) == 6, text.try_cast("int"))
    return F.when(number.between(200001, 209912) & (number % 100).between(1, 12), number)


def prior_period(period: Column) -> Column:
    """The month before, on ``YYYYMM`` integers."""
    return F.when(period % 100 == 1, period - 89).otherwise(period - 1)


def period_of(year: Column, month: Column) -> Column:
    return year * 100 + month


def remittance_name(name: Column) -> Column:
    """``remesa_<month before the date in the name>.csv``."""
    day = F.regexp_extract(base_name(name), r"(\d{8})", 1)
    when = F.try_to_date(day, "yyyyMMdd")
    return F.concat(F.lit("remesa_"), F.date_format(F.add_months(when, -1), "yyyyMM"), F.lit(".csv"))
