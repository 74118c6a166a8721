"""Data-quality summaries, each returned as a small DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.numbers import has_fraction
from rosterflow.functions.text import strip


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each listed column that exists, in one aggregate."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "columna string, nulos bigint")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("nulos")) for c in present])
    return counts.select(F.inline(pairs))


def fraction_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each whole-number column carry a fraction (and get rounded)."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count_if(has_fraction(F.col(c))).alias(c) for c in present])
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("con_decimales")) for c in present])
    return counts.select(F.inline(pairs))


def conversion_report(df: DataFrame, pairs: Sequence[tuple[str, Column]]) -> DataFrame:
    """Per column: rows, values before, values after a conversion, and values lost by it."""
    parts = []
    for name, converted in pairs:
        had = F.coalesce(F.length(strip(F.col(name).cast("string"))) > 0, F.lit(False))
        parts.append(
            F.struct(
                F.lit(name).alias("columna"),
                F.count("*").alias("filas"),
                F.count_if(had).alias("con_valor"),
                F.count_if(converted.isNotNull()).alias("convertidas"),
                F.count_if(had & converted.isNull()).alias("fallidas"),
            )
        )
    return df.agg(F.array(*parts).alias("r")).select(F.inline("r"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("filas")).orderBy(F.desc("filas"), F.asc_nulls_last(column))


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("filas"))


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct trimmed, non-blank keys; an error when there is none."""
    if key not in df.columns:
        raise ValueError(f"the key column {key!r} is missing")
    text = strip(F.col(key).cast("string"))
    keys = df.select(text.alias(key)).where(F.length(key) > 0).distinct()
    if keys.isEmpty():
        raise ValueError(f"no valid value in {key!r}")
    return keys


def changed_count(df: DataFrame, pairs: Iterable[tuple[Column, Column, str]]) -> DataFrame:
    """Rows where a cleaned column differs from its original text."""
    return df.agg(*[F.count_if(~before.cast("string").eqNullSafe(after)).alias(name) for before, after, name in pairs])


def preview(df: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """The first rows, and a table of column, type and total row count."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    shape = df.agg(F.count("*").alias("filas")).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.lit(t).alias("tipo")) for c, t in fields])).alias("c"),
        "filas",
    )
    return df.limit(n), shape.select("c.columna", "c.tipo", "filas")


def suspects(df: DataFrame, column: str, valid: Callable[[Column], Column]) -> DataFrame:
    """Texts of a column that are not blank and not valid, with their rows: ``columna, valor, filas``."""
    text = strip(F.col(column).cast("string"))
    wrong = df.select(text.alias("valor")).where((F.length("valor") > 0) & ~F.coalesce(valid(F.col("valor")), F.lit(False)))
    return wrong.groupBy("valor").agg(F.count("*").alias("filas")).select(F.lit(column).alias("columna"), "valor", "filas")
