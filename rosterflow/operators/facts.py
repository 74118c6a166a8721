"""Facts of files, told by the pass that writes their rows.

Header, leading, trailing and closing rows are rules about whole files.  While
rows are written, each task notes which cells of a row hold something (its
shape), and leaves two kinds of facts about each file beside them: its first
rows, and the last row of every shape.  Facts of several tasks merge, whatever
way a file was dealt, and the rules are then settled on one small row per file:
no further pass looks at the rows to find a cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import NULL_WORDS, WHITESPACE
from rosterflow.operators.headers import promoted_names, sheet_names

HEAD, SHAPE = "head", "shape"
# Facts a task holds at most before it writes them.
HELD_FACTS = 50_000
# At most two leading rows may go, so the third may be the header.
FIRST_ROWS, CHECKED, EMPTY_FROM = 3, 2, 0.8

_TOLD = pa.schema(
    [("_file", pa.string()), ("_row", pa.int64()), ("cells", pa.list_(pa.string())), ("_shape", pa.string()), ("_spoken", pa.bool_()), ("_fact", pa.string())]
)
_TOLD_SQL = "_file string, _row long, cells array<string>, _shape string, _spoken boolean, _fact string"
_FILES = "_file string, _header_row long, _width int, _end long, _end_filled long, names array<string>, _lead array<long>, _shapes array<struct<shape:string,last:long>>"
_NULLISH = f"(?i)^[{WHITESPACE}]*(?:{'|'.join(w for w in NULL_WORDS if w)})?[{WHITESPACE}]*$"


def _filled(cells: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Which cells hold something, and where the rows' cells begin and end."""
    values = cells.flatten()
    blank = pc.match_substring_regex(pc.fill_null(values, ""), _NULLISH)
    bounds = np.concatenate([[0], np.cumsum(np.asarray(cells.value_lengths(), np.int64))])
    return ~np.asarray(blank, bool), bounds


def _shapes(filled: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
    """One text per row: 1 for a cell that holds something, 0 for another."""
    marks = np.where(filled, np.uint8(ord("1")), np.uint8(ord("0")))
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(marks))


class _Facts:
    def __init__(self):
        self.first: dict[str, list] = {}
        self.last: dict[tuple[str, str], int] = {}

    def take(self, batch: pa.RecordBatch) -> None:
        names = batch.column("_file").dictionary_encode()
        files, codes = names.dictionary.to_pylist(), np.asarray(names.indices)
        rows = np.asarray(batch.column("_row"))
        order = np.lexsort((rows, codes))
        ranked = np.arange(len(order)) - np.searchsorted(codes[order], codes[order])
        for i in order[ranked < FIRST_ROWS].tolist():
            mine = self.first.setdefault(files[codes[i]], [])
            mine.append((int(rows[i]), batch.column("cells")[i].as_py(), batch.column("_shape")[i].as_py()))
            mine.sort(key=lambda x: x[0])
            del mine[FIRST_ROWS:]
        groups = pa.table({"f": batch.column("_file"), "s": batch.column("_shape"), "r": batch.column("_row")}).group_by(["f", "s"]).aggregate([("r", "max")])
        for file, shape, row in zip(*[groups.column(c).to_pylist() for c in ("f", "s", "r_max")]):
            self.last[file, shape] = max(row, self.last.get((file, shape), row))

    def told(self) -> pa.RecordBatch:
        rows = [(file, row, cells, shape, None, HEAD) for file, first in self.first.items() for row, cells, shape in first]
        rows += [(file, row, None, shape, None, SHAPE) for (file, shape), row in self.last.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TOLD)], schema=_TOLD)


def told_rows(scanned: DataFrame, columns: int | None = None, words: Sequence[str] = ()) -> DataFrame:
    """``_file, _row, cells, _shape, _spoken, _fact``: the rows (no fact), cut to ``columns`` cells, and the facts of their files.

    ``_spoken`` says whether a cell reads one of ``words``, in any case.
    """
    pattern = "|".join(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = _Facts()
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cells")
            filled, bounds = _filled(cells)
            spoken = np.zeros(batch.num_rows, bool)
            if pattern:
                hits = np.asarray(pc.match_substring_regex(pc.fill_null(cells.flatten(), ""), pattern, ignore_case=True), bool)
                spoken = np.diff(np.concatenate([[0], np.cumsum(hits)])[bounds]) > 0
            batch = pa.RecordBatch.from_arrays(
                [batch.column("_file"), batch.column("_row"), cells, _shapes(filled, bounds), pa.array(spoken), pa.nulls(batch.num_rows, pa.string())],
                schema=_TOLD,
            )
            facts.take(batch)
            yield batch
            if len(facts.first) + len(facts.last) > HELD_FACTS:
                yield facts.told()
                facts = _Facts()
        if facts.last:
            yield facts.told()

    cells = F.coalesce("cells", F.array().cast("array<string>"))
    cells = F.slice(cells, 1, columns) if columns else cells
    rows = scanned.select(F.col("_file").cast("string").alias("_file"), F.col("_row").cast("long").alias("_row"), cells.alias("cells"))
    return rows.mapInArrow(run, _TOLD_SQL)


def _blank_share(shape: str, width: int) -> float:
    return (width - shape.count("1")) / width if width > 0 else 1.0


def merged_facts(facts: pd.DataFrame, drop_leading: bool, promoted: bool) -> pd.DataFrame:
    """One row for a file: leading rows that go, header, width, last rows, and the last row of every shape."""
    heads = facts[facts["_fact"] == HEAD].sort_values("_row").drop_duplicates("_row").head(FIRST_ROWS)
    last = facts[facts["_fact"] == SHAPE].groupby("_shape")["_row"].max()
    width, lead = max(map(len, last.index)), []
    for row, shape in list(zip(heads["_row"], heads["_shape"]))[:CHECKED if drop_leading else 0]:
        if _blank_share(shape, width) <= EMPTY_FROM:
            break
        lead.append(int(row))
    columns = [c.split(" ")[0] for c in _FILES.split(", ")]
    if len(heads) <= len(lead):
        return pd.DataFrame([], columns=columns)
    # A shape whose last row is a leading one has no other rows.
    last = last[~last.isin(lead)]
    header, width = heads.iloc[len(lead)], max(map(len, last.index))
    cells = list(header["cells"]) + [None] * (width - len(header["cells"]))
    names = promoted_names(cells) if promoted else sheet_names(cells)
    filled = [int(r) for s, r in last.items() if "1" in s]
    shapes = [{"shape": s, "last": int(r)} for s, r in last.items()]
    return pd.DataFrame(
        [[header["_file"], int(header["_row"]), len(names), int(last.max()), max(filled, default=None), names, lead, shapes]], columns=columns
    )


def file_facts(told: DataFrame, *, drop_leading: bool = False, promoted: bool = False) -> DataFrame:
    """One row per file, from the facts beside settled rows.

    ``_header_row`` is the first row that stays and ``names`` are its technical names,
    ``_lead`` the leading rows that go, ``_end`` and ``_end_filled`` the last row and the
    last one that holds something, ``_shapes`` the last row of every shape.
    """
    facts = told.where("_fact is not null").select("_file", "_row", "cells", "_shape", "_fact")
    return facts.groupBy("_file").applyInPandas(lambda x: merged_facts(x, drop_leading, promoted), _FILES)


def rows_of(told: DataFrame) -> DataFrame:
    return told.where("_fact is null").drop("_fact")


def filled_count(shape: Column) -> Column:
    return F.length(F.replace(shape, F.lit("0"), F.lit("")))


def last_row(ratio_of, threshold: float = 0.8) -> Column:
    """The last row of a file whose share of blank cells, told by its shape, is below ``threshold``; null without one."""
    kept = F.filter("_shapes", lambda s: ratio_of(s["shape"]) < threshold)
    return F.array_max(F.transform(kept, lambda s: s["last"]))


def share_of(positions: Sequence[Column]):
    """Share of blank cells at ``positions`` (from 1; a null one is blank in every row)."""

    def ratio(shape: Column) -> Column:
        if not positions:
            return F.lit(1.0)
        filled = sum((F.coalesce((F.substring(shape, p, 1) == "1").cast("int"), F.lit(0)) for p in positions), F.lit(0))
        return (F.lit(len(positions)) - filled) / F.lit(float(len(positions)))

    return ratio
