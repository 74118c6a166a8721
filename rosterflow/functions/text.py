"""Text cleaning: blanks, accents, technical names, limits, bytes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that mean "no value" once trimmed and lowered.
NULL_WORDS = ("", "none", "nan")
# Cell texts that a text column turns into an empty string.
BLANKED_CELLS = ("None", "none", "nan", "NaN")

# Characters that Python's str.strip() removes; Spark's trim() alone knows only the space.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


_ASCII_WHITESPACE = "".join(ch for ch in WHITESPACE if ch.isascii())


def is_ascii(c: Column) -> Column:
    """One byte per character."""
    return F.octet_length(c) == F.char_length(c)


def strip(c: Column) -> Column:
    """Trimming costs by the size of the set, so plain ASCII text gets the short one."""
    return F.when(is_ascii(c), F.trim(c, F.lit(_ASCII_WHITESPACE))).otherwise(F.trim(c, F.lit(WHITESPACE)))


def is_nullish(c: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    """True for null and for text that trims and lowers to one of ``words``. Never null."""
    # Anchored at both ends: a real value fails at its first character, untrimmed.
    spelled = "|".join(w for w in words if w)
    return c.isNull() | c.cast("string").rlike(f"(?i)^[{WHITESPACE}]*(?:{spelled})?[{WHITESPACE}]*\\z")


def null_if_nullish(c: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    return F.when(~is_nullish(c, words), c)


def clean_cell(c: Column) -> Column:
    """Trimmed text; null and the spelled-out nulls become the empty string."""
    trimmed = strip(c.cast("string"))
    return F.when(trimmed.isNull() | trimmed.isin(*BLANKED_CELLS), "").otherwise(trimmed)


def strip_quotes(c: Column) -> Column:
    """Trim, then remove double quotes at both ends."""
    return F.trim(strip(c), F.lit('"'))


def limit_text(c: Column, size: int, *, trim: bool = True) -> Column:
    text = c.cast("string")
    return F.substring(strip(text) if trim else text, 1, size)


def readable_text(c: Column) -> Column:
    """Bytes (or text holding bad bytes) as valid UTF-8, bad sequences replaced."""
    return F.make_valid_utf8(c.cast("string"))


# --------------------------------------------------------------------- accents


def fold(text: str) -> str:
    """NFKD form without combining marks."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, str, str]:
    """Fold rules of all planes, computed from Unicode data.

    Characters that fold to one and what they fold to, the marks that go last among
    the former; then those that fold to several, and all of these joined.
    """
    kept, dropped, several = {}, [], {}
    for code in range(0xA0, 0x110000):
        ch = chr(code)
        if not (unicodedata.decomposition(ch) or unicodedata.combining(ch) or 0xAC00 <= code <= 0xD7A3):
            continue
        folded = fold(ch)
        if not folded:
            dropped.append(ch)
        elif len(folded) > 1:
            several[ch] = folded
        elif folded != ch:
            kept[ch] = folded
    return "".join(kept) + "".join(dropped), "".join(kept.values()), "".join(several), _PART.join(several.values())


# Between the expansions in their literal; no text folds to it.
_PART = "\x01"


def strip_accents(c: Column) -> Column:
    """Accent folding inside the JVM, for every script.

    One ``translate`` covers every character that folds to a single one or to none;
    those that expand (fractions, ligatures, Hangul syllables) are looked up one by
    one in rows that hold one.
    """
    source, target, several, parts = _fold_tables()
    expansions = F.split(F.lit(parts), _PART)

    def expand(ch: Column) -> Column:
        return F.when(is_ascii(ch), ch).otherwise(F.coalesce(F.get(expansions, F.position(ch, F.lit(several)) - 1), ch))

    expanded = F.array_join(F.transform(F.split(c, ""), expand), "")
    folded = F.translate(F.when(F.translate(c, several, "") != c, expanded).otherwise(c), source, target)
    return F.when(is_ascii(c), c).otherwise(folded)


@F.pandas_udf(T.StringType())
def strip_accents_unicode(s: pd.Series) -> pd.Series:
    """Exact NFKD folding for every script (Arrow batches)."""
    return s.map(fold, na_action="ignore")


# ------------------------------------------------------------- technical names


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def match_form(c: Column) -> Column:
    """Upper case without accents, one character for one, for pattern matching in short names."""
    source, target, *_ = _fold_tables()
    return F.upper(F.when(is_ascii(c), c).otherwise(F.translate(c, source, target)))


def normalize_name(c: Column) -> Column:
    """Technical name: folded, lower case, ``°`` dropped, anything else non-word as single ``_``."""
    lowered = F.replace(F.lower(strip_accents(c)), F.lit("°"), F.lit(""))
    # The ASCII pattern is several times faster than the Unicode one and equal on ASCII text.
    return bind(lowered, lambda text: F.trim(
        F.when(is_ascii(text), F.regexp_replace(text, "[^a-z0-9]+", "_")).otherwise(
            F.regexp_replace(text, r"(?U)[\W_]+", "_")
        ), F.lit("_"),
    ))


def header_name(text: object) -> str:
    """:func:`normalize_name` for one header, on the driver or in a header-sized UDF."""
    lowered = fold(str(text)).lower().replace("°", "")
    return re.sub(r"[\W_]+", "_", lowered).strip("_")
