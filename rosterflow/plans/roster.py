"""A source's scanned rows to its load frame: map, clean, name, type.

The scan is written once, with facts of its files; everything behind it is one
lazy plan per source.  Files are never looped over.  Every file resolves its own
header, so layouts may differ between the files of one load.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rosterflow.functions.identity import has_valid_shape
from rosterflow.functions.numbers import has_fraction, to_whole
from rosterflow.functions.text import clean_cell
from rosterflow.operators import facts, headers, rows
from rosterflow.operators.quality import null_report, suspects
from rosterflow.operators.relational import join_dimension, unmapped_counts
from rosterflow.session import compile_split_code, settle
from rosterflow.sinks.versioned import History
from rosterflow.sources.contracts import WHOLE, Contract, Field, operation_digits, rounded

_RAW, _OF_FILE = "_raw_", "_of_file_"
# Amounts that a footer may sum, besides the whole-number columns.
_AMOUNTS = ("Prima_Ces", "Prima_Bruta_PPI", "Monto_Asegurado")
# Rows of a file of the settled scan: a compressed scan is small, and one file of it is one task of the typing.
SCANNED_ROWS = 1 << 16


@dataclass
class RosterLoad:
    """The typed rows, and what cleaning took out (by rule)."""

    contract: Contract
    rows: DataFrame
    removed: Mapping[str, DataFrame] = field(default_factory=dict)
    audit: DataFrame | None = None
    # The rows beside the texts they were made of (``_raw_<column>``).
    sources: DataFrame | None = None

    def nulls(self) -> DataFrame:
        """Null counts of the critical columns."""
        return null_report(self.rows, self.contract.critical)

    def suspects(self, column: str) -> DataFrame:
        """Identifiers without the shape of one, with their rows."""
        return suspects(self.rows, column, has_valid_shape)

    def unmapped(self, key: str, target: str) -> DataFrame:
        """Keys that the contract's table does not know, with their rows."""
        return unmapped_counts(self.rows, key, target)


# ------------------------------------------------------------------- extraction


def _field_position(f: Field) -> Column | None:
    names = F.col("names")
    if f.twin is not None:
        at = headers.twin_position(names, *f.twin)
        return F.coalesce(at, F.raise_error(F.lit(f"two {f.twin[0]!r} columns expected")).cast("int"))
    return headers.position(names, *f.synonyms) if f.synonyms else None


def _per_file(contract: Contract) -> dict[str, Column]:
    """What depends on the file alone, its key above all: computed once per file, not per row."""
    columns = {f"_path_{n}": of_path(F.col("_file")) for n, of_path in contract.extra.items()}
    if contract.canonical is not None:
        columns["_name"] = contract.canonical(F.col("_file"))
    return columns | {f"{_OF_FILE}{f.name}": f.of_file(F.col("_file")) for f in contract.fields if f.of_file is not None}


def extract_cells(told: DataFrame, contract: Contract) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Settled rows with the facts of their files to named text columns, one per contract field.

    What a rule needs of a file (header, positions, last row that stays) is on one
    row per file, settled, and joined at its true size.
    """
    removed: dict[str, DataFrame] = {}
    positions = {f.name: p for f in contract.fields if (p := _field_position(f)) is not None}
    money = {f"_money_{c}": headers.position(F.col("names"), c) for c in contract.total_decimals}
    per_file = _per_file(contract)
    files = facts.file_facts(told, drop_leading=contract.drop_leading, promoted=contract.promoted_header)
    files = files.select(
        "_file", "_header_row", "_width", "_end", "_end_filled", "_lead", "_shapes",
        *[c.alias(n) for n, c in per_file.items()], *[p.alias(f"_at_{n}") for n, p in {**positions, **money}.items()],
    )
    if contract.drop_trailing:
        if contract.drop_trailing == "raw":
            ratio_of = lambda shape: rows.width_ratio(facts.filled_count(shape), F.col("_width"))
        else:
            counted = [f.name for f in contract.fields if f.name in positions and f.name not in contract.money and f.name != contract.key]
            ratio_of = facts.share_of([F.col(f"_at_{n}") for n in counted])
        files = files.withColumn("_last_kept", facts.last_row(ratio_of))
    files = settle(files.drop("_shapes"), "files")
    placed = facts.rows_of(told).join(files, "_file")
    if contract.drop_leading:
        removed["leading"] = placed.where(F.array_contains("_lead", F.col("_row"))).select("_file", "_row", "cells")
    below = placed.where(F.col("_row") > F.col("_header_row"))
    # A missing column stays null; a blank cell of a present column becomes "".
    at = {n: F.col(f"_at_{n}") for n in positions}
    texts = {n: F.when(a.isNotNull(), clean_cell(headers.cell(F.col("cells"), a))) for n, a in at.items()}
    for n in contract.extra:
        texts[next(f.name for f in contract.fields if n in f.synonyms)] = F.col(f"_path_{n}")
    helpers = {}
    if contract.total_decimals:
        helpers = {"_filled": facts.filled_count(F.col("_shape")), "_width": F.col("_width"), "_end": F.col("_end")}
        helpers |= {m: headers.cell(F.col("cells"), F.col(f"_at_{m}")) for m in money}
    if contract.footer:
        helpers |= {"_filled": facts.filled_count(F.col("_shape")), "_spoken": F.col("_spoken"), "_end_filled": F.col("_end_filled")}
    if contract.drop_trailing:
        helpers["_trailing"] = F.col("_last_kept").isNull() | (F.col("_row") > F.col("_last_kept"))
    named = below.select(
        "_file", "_row", *[n for n in per_file if n == "_name" or n.startswith(_OF_FILE)], *[c.alias(n) for n, c in {**helpers, **texts}.items()]
    )
    if contract.drop_trailing:
        removed["trailing"] = named.where("_trailing").drop("_trailing")
        named = named.where("not _trailing").drop("_trailing")
    return named, removed


def extract_named(scanned: DataFrame, contract: Contract) -> DataFrame:
    """A frame with technical column names, ``_file`` and ``_row`` to the contract's text columns."""
    picked = {f.name: headers.pick(scanned, *f.synonyms).cast("string") for f in contract.fields if f.synonyms}
    df = scanned.select("_file", "_row", *[c.alias(n) for n, c in picked.items()])
    per_file = _per_file(contract)
    if not per_file:
        return df
    files = scanned.select("_file").distinct().select("_file", *[c.alias(n) for n, c in per_file.items()])
    return join_dimension(df, files, "_file")


# --------------------------------------------------------------------- cleaning


def _clean(df: DataFrame, contract: Contract, removed: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    audit = None
    own = [f.name for f in contract.fields if f.name in df.columns]
    if contract.total_decimals and "_filled" in df.columns:
        money = [f"_money_{c}" for c in contract.total_decimals]
        full = sum(((~rows.is_nullish(F.col(m), rows.STRICT_NULL_WORDS)).cast("int") for m in money), F.lit(0))
        ratio = rows.width_ratio(F.col("_filled") - full, F.col("_width") - len(money))
        digits = {f"_money_{c}": d for c, d in contract.total_decimals.items()}
        df, removed["total"] = rows.split_total(df, digits, ratio=ratio, last=F.col("_end"))
    if contract.footer:
        numeric = [f.name for f in contract.fields if f.convert == WHOLE or f.name in _AMOUNTS]
        df, removed["footer"], audit = rows.split_footer(
            df.where(F.col("_filled") > 0), {n: rows.to_number(F.col(n)) for n in numeric if n in own},
            spoken=F.col("_spoken"), last=F.col("_end_filled"),
        )
    return df, audit


# ----------------------------------------------------------------------- typing


def _typed(df: DataFrame, contract: Contract, strict: bool) -> DataFrame:
    """The load columns, and the texts of those that are converted to something else than text."""
    columns: dict[str, Column] = {}
    for f in contract.fields:
        if f.derive is not None:
            continue
        raw = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        if f.of_file is not None:
            raw = F.col(f"{_OF_FILE}{f.name}")
        if f.name in df.columns and f.convert is not None:
            columns[f"{_RAW}{f.name}"] = raw
        if f.convert == WHOLE:
            raw = to_whole(raw, "fail" if strict else "null")
        elif f.convert is not None:
            raw = f.convert(raw)
        columns[f.name] = raw
    typed = df.select("_file", *[c.alias(n) for n, c in columns.items()])
    derived = {f.name: f.derive() for f in contract.fields if f.derive is not None}
    typed = typed.withColumns(derived) if derived else typed
    converted = [c for c in columns if c.startswith(_RAW) and dict(typed.dtypes)[c.removeprefix(_RAW)] != "string"]
    return typed.select(*contract.load_columns, *converted)


def _named(df: DataFrame, contract: Contract) -> DataFrame:
    """The load key from the file name, unless the file itself carries it."""
    if contract.canonical is None:
        return df
    if not contract.fill_blank:
        return df.withColumn(contract.key, F.col("_name"))
    for name, value in contract.fill_blank.items():
        df = headers.fill_if_all_blank(df, name, value(), per="_file")
    return df


def load_roster(scanned: DataFrame, contract: Contract, *, strict: bool = True) -> RosterLoad:
    """Scanned rows to the contract's load columns.

    ``scanned`` has ``_file``, ``_row`` and either ``cells`` (workbooks) or named
    columns (CSV).  It is written once (files parsed once), with the facts of each
    file beside its rows; one small row per file is made of these, and the typed
    rows are then a lazy plan over both.  Only a total or a footer needs another
    pass, for its sums.  ``strict`` stops the job at an identifier with a fraction;
    otherwise it becomes null.
    """
    removed: dict[str, DataFrame] = {}
    compile_split_code(scanned.sparkSession)
    if "cells" in scanned.columns:
        words = rows.FOOTER_WORDS if contract.footer else ()
        df, removed = extract_cells(settle(facts.told_rows(scanned, contract.columns, words), "scanned", rows_per_file=SCANNED_ROWS), contract)
    else:
        df = extract_named(settle(scanned, "scanned", rows_per_file=SCANNED_ROWS), contract)
    df, audit = _clean(df, contract, removed)
    sources = _typed(_named(df, contract), contract, strict)
    return RosterLoad(contract, sources.select(*contract.load_columns), removed, audit, sources)


def load_into_history(load: RosterLoad, path: str) -> DataFrame:
    """Replace each file's rows in the versioned history at ``path``; returns the load summary.

    The rows are written once and take effect in one step; the summary comes from
    the table's manifests (see :mod:`rosterflow.sinks.versioned`).
    """
    return History(load.rows.sparkSession, path, load.contract.key).replace(load.rows)


# ------------------------------------------------------------------------ audit

# What a load's audit counts.
UNREAD, FRACTION, CHANGED, NULL = "sin_convertir", "con_decimales", "cambiado", "nulo"
EXAMPLES = 5


def _facts_counted(load: RosterLoad) -> dict[tuple[str, str], tuple[Column, Column | None]]:
    """Per column and fact: which rows have it, and the text they show for it."""
    counted: dict[tuple[str, str], tuple[Column, Column | None]] = {}
    known = {f.name: f for f in load.contract.fields}
    for column in load.sources.columns:
        if not column.startswith(_RAW):
            continue
        name, raw = column.removeprefix(_RAW), F.col(column)
        convert = known[name].convert
        counted[name, UNREAD] = ~rows.is_nullish(raw) & F.col(name).isNull(), raw
        if convert in (WHOLE, rounded):
            counted[name, FRACTION] = has_fraction(raw), raw
        if convert is operation_digits:
            counted[name, CHANGED] = F.coalesce(raw != F.col(name).cast("string"), F.lit(False)), raw
    for name in load.contract.critical:
        if name in load.rows.columns:
            counted[name, NULL] = F.col(name).isNull(), None
    return counted


def load_with_audit(load: RosterLoad, path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`load_into_history` and what the load's own write has seen: ``(summary, audit)``.

    The audit has a row per column and fact with ``filas`` and ``ejemplos``, the texts
    that have it most often: values that no conversion could read (failed dates among
    them), values with a fraction that is rounded away, operation numbers changed to
    their digits, and nulls of the critical columns.  Counts and examples (a sketch of
    bounded size) are observed while the rows are written: no other job is run for
    them.  Should the cluster compute some rows twice, they are counted twice.
    """
    spark = load.rows.sparkSession
    counted, seen = _facts_counted(load), Observation()
    metrics = [F.count("*").alias("rows")]
    flags = {f"_has_{i}": which for i, (which, _) in enumerate(counted.values())}
    for i, (_, text) in enumerate(counted.values()):
        has = F.col(f"_has_{i}")
        metrics.append(F.count_if(has).alias(f"n{i}"))
        if text is not None:
            # Rows without the fact are one item of the sketch: null.
            top = F.call_function("approx_top_k", F.when(has, text), F.lit(EXAMPLES + 1), F.lit(64 * (EXAMPLES + 1)))
            metrics.append(F.to_json(top).alias(f"e{i}"))
    observed = load.sources.withColumns(flags).observe(seen, *metrics).select(*load.rows.columns)
    summary = History(spark, path, load.contract.key).replace(observed)
    told, found = seen.get, []
    for i, (name, fact) in enumerate(counted):
        examples = [e["item"] for e in json.loads(told.get(f"e{i}") or "[]") if e.get("item") is not None]
        found.append((name, fact, told[f"n{i}"], examples[:EXAMPLES]))
    return summary, spark.createDataFrame(found, "columna string, hecho string, filas long, ejemplos array<string>")
