"""Order-dependent row cleaning, per file.

``_file`` names the group and ``_row`` orders it; any orderable type will do.
Nothing here gathers a file: each rule is a map-side aggregate (or a pruned
top-k) that leaves one small row per file, settled, and joined back.  A file
holding a third of all rows therefore costs no more than its share of the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions.numbers import round_half_even, to_number
from rosterflow.functions.text import NULL_WORDS, is_nullish, strip
from rosterflow.session import settle

FILE, ROW = "_file", "_row"
# Nullish words of the strict total rule, and the words of a footer.
STRICT_NULL_WORDS = ("", "none")
FOOTER_WORDS = ("total", "suma")


def _data_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    left_out = {FILE, ROW, *exclude}
    return [c for c in df.columns if c not in left_out]


def nullish_ratio(columns: Sequence[str | Column], words: Iterable[str] = NULL_WORDS) -> Column:
    """Share of nullish cells among ``columns``; 1.0 without columns."""
    if not columns:
        return F.lit(1.0)
    cells = [F.col(c) if isinstance(c, str) else c for c in columns]
    count = sum((is_nullish(c, words).cast("int") for c in cells[1:]), is_nullish(cells[0], words).cast("int"))
    return count / F.lit(float(len(cells)))


def row_ratio(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """:func:`nullish_ratio` over the data columns of ``df``."""
    return nullish_ratio(_data_columns(df, exclude))


def filled_cells(cells: Column) -> Column:
    """How many cells of an array hold something."""
    return F.coalesce(F.size(F.filter(cells, lambda c: ~is_nullish(c))), F.lit(0))


def has_footer_word(cells: Column) -> Column:
    """Does any cell of an array read total or suma? Never null."""
    spoken = F.exists(cells, lambda c: F.coalesce(F.lower(c).rlike("|".join(FOOTER_WORDS)), F.lit(False)))
    return F.coalesce(spoken, F.lit(False))


def width_ratio(filled: Column, width: Column) -> Column:
    """:func:`nullish_ratio` of a row with ``filled`` of ``width`` cells."""
    return F.when(width <= 0, 1.0).otherwise((width - filled) / width)


# ----------------------------------------------------------------- leading rows


def split_leading(df: DataFrame, ratio: Column, *, check: int = 2, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Drop rows above ``threshold`` from the top of each file, at most ``check``, until one is kept.

    Returns (kept, removed).  Only the first ``check`` rows of a file per task
    survive the window's map-side limit.
    """
    if check <= 0:
        return df, df.limit(0)
    threshold = min(max(threshold, 0.0), 1.0)
    order = Window.partitionBy(FILE).orderBy(ROW)
    head = (
        df.select(FILE, ROW, ratio.alias("_ratio"))
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= check)
    )
    # Rows of the unbroken empty run: those before the first kept one.
    cut = head.groupBy(FILE).agg(
        F.min(F.when(F.col("_ratio") <= threshold, F.col(ROW))).alias("_first_kept"),
        F.max(ROW).alias("_last_checked"),
    )
    gone = F.when(F.col("_first_kept").isNull(), F.col(ROW) <= F.col("_last_checked"))
    return _split_at(df, cut, gone.otherwise(F.col(ROW) < F.col("_first_kept")))


def split_trailing(df: DataFrame, ratio: Column, *, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Drop the run of rows at or above ``threshold`` that ends each file. Returns (kept, removed)."""
    last_kept = F.max(F.when(ratio < threshold, F.col(ROW)))
    cut = df.groupBy(FILE).agg(last_kept.alias("_last_kept"))
    return _split_at(df, cut, F.col("_last_kept").isNull() | (F.col(ROW) > F.col("_last_kept")))


def _split_at(df: DataFrame, cut: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    marked = df.join(settle(cut, "cuts"), FILE, "left").withColumn("_gone", F.coalesce(gone, F.lit(False)))
    return marked.where(~F.col("_gone")).select(*df.columns), marked.where("_gone").select(*df.columns)


# ------------------------------------------------------------------- total rows


def _file_totals(df: DataFrame, sums: Mapping[str, Column], flag: Column, last: Column | None = None) -> DataFrame:
    """Per file: row count, last row's key, amounts and ``flag``, and the sums of everything before it.

    With ``last``, the number of each file's last row, all of it is one aggregate.

    Sums and the last key are one hash aggregate; the last row's own values are
    looked up afterwards, because carrying them through the aggregate would make
    Spark sort every row.
    """
    whole = [F.count("*").alias("_rows"), F.max(ROW).alias("_last"), *[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"_s_{c}") for c, v in sums.items()]]
    body = {f"_p_{c}": F.col(f"_s_{c}") - F.coalesce(F.col(f"_v_{c}"), F.lit(0.0)) for c in sums}
    if last is not None:
        ends = [F.max(F.when(F.col(ROW) == last, v)).alias(n) for n, v in {"_flag": flag, **{f"_v_{c}": v for c, v in sums.items()}}.items()]
        found = settle(df.groupBy(FILE).agg(*whole, *ends), "totals")
        return found.withColumns(body) if body else found
    stats = settle(df.groupBy(FILE).agg(*whole), "totals")
    own = df.select(FILE, ROW, flag.alias("_flag"), *[v.alias(f"_v_{c}") for c, v in sums.items()])
    ends = own.join(stats, FILE).where(F.col(ROW) == F.col("_last")).drop(ROW)
    return ends.withColumns(body) if body else ends


def split_total(
    df: DataFrame,
    decimals: Mapping[str, int],
    *,
    exclude: Iterable[str] = (),
    ratio: Column | None = None,
    last: Column | None = None,
    threshold: float = 0.8,
    atol: float = 0.5,
    rtol: float = 5e-4,
) -> tuple[DataFrame, DataFrame]:
    """Drop each file's last row when it totals every money column and holds little else.

    ``decimals`` maps the money columns to the digits compared; ``ratio`` is the
    nullish share of the rest (by default of all other columns but ``exclude``).
    A money column the frame lacks keeps the row, as does a file of one row.  ``last``,
    where it is known, is the number of each file's last row and spares a pass.
    """
    if not set(decimals) <= set(df.columns):
        return df, df.limit(0)
    money = {c: to_number(F.col(c)) for c in decimals}
    if ratio is None:
        ratio = nullish_ratio(_data_columns(df, (*decimals, *exclude)), STRICT_NULL_WORDS)
    totals = _file_totals(df, money, ratio >= threshold, last)
    flag = (F.col("_rows") >= 2) & F.col("_flag")
    for c, digits in decimals.items():
        end, body = F.col(f"_v_{c}"), F.col(f"_p_{c}")
        same = round_half_even(end, digits) == round_half_even(body, digits)
        near = F.abs(end - body) <= F.lit(atol) + F.lit(rtol) * F.abs(body)
        flag = flag & F.coalesce(same | near, F.lit(False))
    cut = totals.where(flag).select(FILE, "_last")
    return _split_at(df, cut, F.col(ROW) == F.col("_last"))


def split_footer(
    df: DataFrame,
    numeric: Mapping[str, Column] | Sequence[str] = (),
    *,
    spoken: Column | None = None,
    last: Column | None = None,
    tolerance: float = 1e-6,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop each file's last row when a cell reads total/suma, or every numeric column sums the body.

    ``spoken`` says whether a row has such a cell (by default, any column does).
    Returns (kept, removed, audit); the audit has one row per file.
    """
    sums = dict(numeric) if isinstance(numeric, Mapping) else {c: F.col(c).cast("double") for c in numeric}
    if spoken is None:
        spoken = F.lit(False)
        for c in _data_columns(df, ()):
            word = F.lower(strip(F.col(c).cast("string"))).rlike("|".join(FOOTER_WORDS))
            spoken = spoken | F.coalesce(word, F.lit(False))
    totals = _file_totals(df, sums, spoken, last)
    summed = F.col("_rows") >= 2 if sums else F.lit(False)
    for c in sums:
        end, body = F.col(f"_v_{c}"), F.col(f"_p_{c}")
        slack = F.greatest(F.lit(tolerance), F.lit(tolerance) * F.greatest(F.abs(end), F.abs(body)))
        summed = summed & F.coalesce(F.abs(end - body) <= slack, F.lit(False))
    reason = F.when(F.col("_flag"), "keyword_match").when(summed, "numeric_sum_match")
    audit = settle(totals.select(FILE, "_last", reason.alias("_reason")), "footers")
    kept, removed = _split_at(df, audit.where(F.col("_reason").isNotNull()), F.col(ROW) == F.col("_last"))
    report = audit.select(
        F.col(FILE).alias("archivo"),
        F.col("_reason").isNotNull().alias("footer_eliminado"),
        F.when(F.col("_reason").isNotNull(), F.col("_last")).alias("indice_footer"),
        F.col("_reason").alias("motivo"),
    )
    return kept, removed, report


def drop_blank_rows(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Drop rows whose data columns are all null."""
    return df.na.drop("all", subset=_data_columns(df, exclude))
