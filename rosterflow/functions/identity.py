"""National identifiers: number, check digit, shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.numbers import to_number
from rosterflow.functions.text import strip

# An identifier with a hyphen, and the digits a valid number has.
HYPHENATED = r"^\s*(\d+)-([\dK])\s*$"
VALID_NUMBER = r"^[0-9]{6,8}$"


def check_digit(c: Column) -> Column:
    """First character, upper case; blank is null."""
    return F.nullif(F.substring(F.upper(strip(c.cast("string"))), 1, 1), F.lit(""))


def _hyphen_part(c: Column, group: int) -> Column:
    text = F.replace(F.upper(c.cast("string")), F.lit("."), F.lit(""))
    return F.nullif(F.regexp_extract(text, HYPHENATED, group), F.lit(""))


def hyphen_number(c: Column) -> Column:
    """``12.345.678-K`` -> ``12345678``; anything else is null."""
    return _hyphen_part(c, 1)


def hyphen_digit(c: Column) -> Column:
    return _hyphen_part(c, 2)


def _kept(c: Column) -> Column:
    return F.regexp_replace(F.upper(c.cast("string")), "[^0-9K]", "")


def joined_number(c: Column) -> Column:
    """All but the last of the kept characters (digits and K), as a number."""
    kept = _kept(c)
    return to_number(F.substring(kept, F.lit(1), F.length(kept) - 1)).try_cast("bigint")


def joined_digit(c: Column) -> Column:
    """The last kept character."""
    return F.nullif(F.right(_kept(c), F.lit(1)), F.lit(""))


def digits_only(c: Column) -> Column:
    """Digits of the text, as text; none is null."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"\D+", ""), F.lit(""))


def has_valid_shape(c: Column) -> Column:
    """Six to eight digits once dots and hyphens are gone. Never null."""
    plain = F.regexp_replace(strip(c.cast("string")), "[.-]", "")
    return F.coalesce(plain.rlike(VALID_NUMBER), F.lit(False))
