"""Header names, column resolution and projections.

Two forms of the same rules: on a DataFrame with named columns they act on its
schema; on a scan of many workbooks, whose headers differ, they act on a header
table of one row per file, so no file's header ever reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.text import clean_cell, header_name, is_nullish, limit_text, readable_text, strip_quotes
from rosterflow.session import settle


# ------------------------------------------------------------------ name lists


def make_unique(names: Iterable[str | None], blank: str = "col") -> list[str]:
    """Blank names become ``col``; repeats get ``_2``, ``_3``..., skipping names already taken."""
    originals = [name or blank for name in names]
    taken, result = set(), []
    for name in originals:
        candidate, n = name, 1
        while candidate in taken or (n > 1 and candidate in originals):
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate)
        result.append(candidate)
    return result


def promoted_names(cells: Sequence[str | None]) -> list[str]:
    """A data row as header: technical names, ``col_<position>`` for blanks, all unique."""
    named = [header_name(c) if c is not None else "" for c in cells]
    return make_unique(n or f"col_{i}" for i, n in enumerate(named, 1))


def sheet_names(cells: Sequence[str | None]) -> list[str]:
    """A sheet's own header row: blanks are ``unnamed_<position from 0>``, repeats are numbered from 1."""
    seen: dict[str, int] = {}
    result = []
    for i, cell in enumerate(cells):
        raw = f"Unnamed: {i}" if cell is None or cell == "" else str(cell)
        again = seen.get(raw, 0)
        seen[raw] = again + 1
        result.append(header_name(f"{raw}.{again}" if again else raw))
    return result


# ------------------------------------------------------------- named DataFrames


def normalize_columns(df: DataFrame) -> DataFrame:
    """All column names technical and unique."""
    return df.toDF(*make_unique(header_name(c) for c in df.columns))


def pick(
    df: DataFrame,
    *names: str,
    required: bool = False,
    default: object = None,
) -> Column:
    """The first of ``names`` that is a column, else ``default`` (null) for every row.

    Of repeated columns :func:`normalize_columns` lets the first keep the name.
    """
    for name in names:
        if name in df.columns:
            return df[name]
    if required:
        raise KeyError(f"none of these columns exists: {', '.join(names)}")
    return F.lit(default).cast("string") if default is None else F.lit(default)


def pick_filled(df: DataFrame, *names: str, blank_as_null: bool = False) -> Column:
    """Row by row, the first non-null among the columns that exist, in the order given.

    After :func:`clean_text` a blank is an empty string and wins over later columns;
    ``blank_as_null`` lets them fill it.
    """
    found = [df[n] for n in names if n in df.columns]
    if not found:
        return F.lit(None).cast("string")
    if blank_as_null:
        found = [F.when(~is_nullish(c), c) for c in found]
    return F.coalesce(*found)


def twin_columns(names: Sequence[str], base: str) -> tuple[str, str]:
    """The first two columns named ``base`` or ``base`` with a number; an error when there are fewer."""
    pattern = re.compile(rf"{re.escape(base)}(?:[_. -]\d+)?")
    hits = [n for n in names if pattern.fullmatch(n)]
    if len(hits) < 2:
        raise ValueError(f"two {base!r} columns expected, found {len(hits)}")
    return hits[0], hits[1]


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[n for n in names if n in df.columns])


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_text(df: DataFrame) -> DataFrame:
    """Trim every text column; spelled-out nulls and nulls become empty strings."""
    return df.withColumns({n: clean_cell(F.col(n)) for n in _text_columns(df)})


def unquote_text(df: DataFrame) -> DataFrame:
    return df.withColumns({n: strip_quotes(F.col(n)) for n in _text_columns(df)})


def limit_columns(df: DataFrame, limits: Mapping[str, int], *, trim: bool = True) -> DataFrame:
    """Trim and cut the listed columns that exist."""
    return df.withColumns({n: limit_text(F.col(n), size, trim=trim) for n, size in limits.items() if n in df.columns})


def exportable_text(df: DataFrame) -> DataFrame:
    """Binary and text columns as valid UTF-8 text."""
    unsafe = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.BinaryType, T.StringType))]
    return df.withColumns({n: readable_text(F.col(n)) for n in unsafe})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add or replace columns by constants or expressions."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def fill_if_all_blank(df: DataFrame, name: str, value: Column, per: str | None = None) -> DataFrame:
    """Set ``name`` to ``value`` where the whole column (of the file ``per``) holds no text.

    The test is one map-side aggregate; the rows are not shuffled for it as long
    as the flag table is small enough to broadcast.
    """
    if name not in df.columns:
        return df.withColumn(name, value)
    has_text = F.max(F.when(~is_nullish(F.col(name)), 1).otherwise(0)) == 1
    if per is None:
        filled = bool(df.agg(has_text.alias("f")).first()["f"])
        return df if filled else df.withColumn(name, value)
    flags = settle(df.groupBy(per).agg(has_text.alias("_has_text")), "filled")
    joined = df.join(flags.withColumnRenamed(per, "_per"), F.col(per).eqNullSafe(F.col("_per")), "left")
    return joined.withColumn(name, F.when(F.col("_has_text"), F.col(name)).otherwise(value)).drop("_has_text", "_per")


# ---------------------------------------------------------- workbook row arrays


@F.pandas_udf(T.ArrayType(T.StringType()))
def _sheet_header(cells: pd.Series) -> pd.Series:
    return cells.map(sheet_names)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _promoted_header(cells: pd.Series) -> pd.Series:
    return cells.map(promoted_names)


def header_table(rows: DataFrame, *, promoted: bool = False) -> DataFrame:
    """``_file, _header_row, names``: the first remaining row of every file as technical names.

    Its number is a map-side minimum over two narrow columns and its cells are
    then looked up, so the cells are never sorted or shuffled; the naming UDF
    sees one row per file.
    """
    numbers = settle(
        rows.groupBy("_file").agg(F.min("_row").alias("_header_row"), F.max(F.size("cells")).alias("_widest")), "first-rows"
    )
    first = rows.join(numbers, "_file").where(F.col("_row") == F.col("_header_row"))
    naming = _promoted_header if promoted else _sheet_header
    # Blank cells at a row's end are not stored; a column without a header has a name all the same.
    missing = F.array_repeat(F.lit(None).cast("string"), F.greatest(F.col("_widest") - F.size("cells"), F.lit(0)))
    return first.select("_file", "_header_row", naming(F.concat("cells", missing)).alias("names"))


def position(names: Column, *synonyms: str) -> Column:
    """Position (from 1) of the first synonym that is among ``names``; null when none is."""
    return F.coalesce(*[F.nullif(F.array_position(names, s), F.lit(0)) for s in synonyms])


def twin_position(names: Column, base: str, which: int) -> Column:
    """Position of the ``which``-th (from 0) column named ``base`` or numbered ``base``."""
    pattern = rf"^{base}([_. -]\d+)?$"
    at = F.filter(
        F.transform(names, lambda n, i: F.when(n.rlike(pattern), i + 1)), lambda p: p.isNotNull()
    )
    return F.get(at, F.lit(which))


def cell(cells: Column, at: Column) -> Column:
    return F.get(cells, at - 1)


def named_rows(
    rows: DataFrame,
    header: DataFrame,
    positions: Mapping[str, Column],
    *,
    per_file: Mapping[str, Column] = {},
    per_row: Mapping[str, Column] = {},
) -> DataFrame:
    """Rows below each file's header as named text columns.

    ``positions`` and ``per_file`` are expressions over ``_file`` and ``names``,
    evaluated once per file; ``per_row`` are further columns, which may use the
    file's ``_width`` and ``_at_<name>``.  The header table is settled, so it is
    broadcast only at its true size.
    """
    table = settle(
        header.select(
            "_file", "_header_row", F.size("names").alias("_width"),
            *[c.alias(n) for n, c in per_file.items()],
            *[p.alias(f"_at_{n}") for n, p in positions.items()],
        ),
        "headers",
    )
    below = rows.join(table, "_file").where(F.col("_row") > F.col("_header_row"))
    values = {n: cell(F.col("cells"), F.col(f"_at_{n}")) for n in positions}
    return below.select("_file", "_row", *per_file, *[c.alias(n) for n, c in {**per_row, **values}.items()])
