"""Tolerant numbers, rounding and the money rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import is_nullish, strip

# Texts a numeric column reads as missing (case matters).
MISSING_NUMBERS = ("", "None", "none", "nan", "NaN")
# Java would also read "1d" or "0x1p3"; a roster number is plain decimal or scientific.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Fixed value: value-added tax factor.
VAT = 1.19
# Commission rate of the net premium, by technical plan.
COMMISSION_RATES = {
    4277: 0.0476,
    4331: 0.0874, 4332: 0.0874, 4333: 0.0874, 4334: 0.0874, 4422: 0.0874,
    6270: 0.0665,
    6832: 0.0087, 8285: 0.0087,
}
# Instalments insured, by technical plan; every other plan insures four.
INSURED_INSTALMENTS = {4331: 3, 4332: 6, 4333: 8, 4334: 12}
OTHER_INSTALMENTS = 4
# Plan text -> (policy, technical plan, instalments).
PLAN_CODES = {
    "Plan 03 Cuotas": (4780715, 4331, 3), "Plan 3 Cuotas": (4780715, 4331, 3),
    "Plan 04 Cuotas": (4780716, 4422, 4), "Plan 4 Cuotas": (4780716, 4422, 4),
    "Plan 06 Cuotas": (4780717, 4332, 6), "Plan 6 Cuotas": (4780717, 4332, 6),
    "Plan 08 Cuotas": (4780718, 4333, 8), "Plan 8 Cuotas": (4780718, 4333, 8),
    "Plan 12 Cuotas": (4780719, 4334, 12),
}


def to_number(c: Column) -> Column:
    """Text to double: trimmed, spelled-out nulls and anything unreadable become null."""
    text = c.cast("string")
    trimmed = strip(text)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).when(
        trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double")
    )


def round_half_even(x: Column, digits: int = 0) -> Column:
    """Half-even on the binary value, as IEEE libraries round (2.675 to two digits is 2.67)."""
    if digits == 0:
        return F.bround(x, 0)
    return fixed_decimals(x, digits).cast("double")


def fixed_decimals(x: Column, digits: int = 2) -> Column:
    """A double as text with exactly ``digits`` decimals, without grouping."""
    return F.call_function("format_number", x, F.lit("0." + "0" * digits))


def to_whole(c: Column, fractional: str = "fail") -> Column:
    """Tolerant integer.

    ``fractional`` says what a value such as 10.5 does: ``round`` (half-even),
    ``null``, or ``fail`` (stop the job, the safest default for identifiers).
    """
    if fractional not in ("round", "null", "fail"):
        raise ValueError(f"fractional must be round, null or fail, not {fractional!r}")
    text = c.cast("string")
    trimmed = strip(text)
    x = trimmed.try_cast("double")
    whole = F.bround(x, 0)
    if fractional == "round":
        other = whole.try_cast("bigint")
    else:
        other = F.when(x == whole, whole.try_cast("bigint"))
        if fractional == "fail":
            message = F.concat(F.lit("not a whole number: "), trimmed)
            other = other.when(x != whole, F.raise_error(message).cast("bigint"))
    # Plain digits, the usual case, are cast directly: exact at any size, and one pass.
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")).when(trimmed.rlike(PLAIN_NUMBER), other)


def has_fraction(c: Column) -> Column:
    x = to_number(c)
    return F.coalesce(x != F.bround(x, 0), F.lit(False))


def cast_numbers(
    df: DataFrame,
    *,
    whole: Iterable[str] = (),
    decimal: Iterable[str] = (),
    fractional: str = "fail",
) -> DataFrame:
    """Cast the listed columns that exist, all in one projection."""
    present = set(df.columns)
    changes = {n: to_whole(F.col(n), fractional) for n in whole if n in present}
    changes |= {n: to_number(F.col(n)) for n in decimal if n in present}
    return df.withColumns(changes) if changes else df


def local_number(c: Column) -> Column:
    """``1.234.567,89``: dots group thousands, the comma is the decimal mark."""
    text = F.replace(F.replace(c.cast("string"), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return to_number(text)


def guessed_local_number(c: Column) -> Column:
    """Reads both marks as local, dots alone as thousands, a comma alone as decimal mark."""
    text = F.replace(strip(c.cast("string")), F.lit(" "), F.lit(""))
    grouped = (text.contains(".") & text.contains(",")) | text.rlike(r"^(?=.*\.)[\d.]*\d[\d.]*$")
    ungrouped = F.when(grouped, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.when(~is_nullish(c), to_number(F.replace(ungrouped, F.lit(","), F.lit("."))))


def truncated_whole(c: Column) -> Column:
    """Number cut to its whole part; blank or unreadable is null."""
    return to_number(c).try_cast("bigint")


def fixed_text(c: Column, digits: int = 2) -> Column:
    """Decimal comma or point to text with fixed decimals; blank or unreadable is null."""
    return fixed_decimals(to_number(F.replace(c.cast("string"), F.lit(","), F.lit("."))), digits)


# ------------------------------------------------------------------ money rules


def net_of_vat(x: Column) -> Column:
    return x / F.lit(VAT)


def _by_code(code: Column, table: dict[int, float]) -> Column:
    """CASE over a small code table, one branch per distinct value."""
    branches: dict[float, list[int]] = {}
    for key, value in table.items():
        branches.setdefault(value, []).append(key)
    case = None
    for value, keys in branches.items():
        hit = code.isin(*keys)
        case = F.when(hit, F.lit(value)) if case is None else case.when(hit, F.lit(value))
    return case


def commission(plan: Column, net_premium: Column, current: Column | None = None) -> Column:
    """Commission by plan; plans without a rate keep ``current`` (zero by default)."""
    rate = _by_code(plan, COMMISSION_RATES)
    keep = current if current is not None else F.lit(0.0)
    return F.when(plan.isin(*COMMISSION_RATES), rate * net_premium).otherwise(keep)


def insured_amount(plan: Column, instalment: Column) -> Column:
    return instalment * F.coalesce(_by_code(plan, INSURED_INSTALMENTS), F.lit(OTHER_INSTALMENTS))


def in_units(amount: Column, rate: Column) -> Column:
    """Amount at a daily rate; a missing or zero rate gives null."""
    return F.try_divide(amount, rate)


def plan_code(plan_text: Column, part: str) -> Column:
    """``policy``, ``plan`` or ``instalments`` of a plan text; unknown texts give null."""
    at = ("policy", "plan", "instalments").index(part)
    return _by_code(plan_text, {text: codes[at] for text, codes in PLAN_CODES.items()})


def vigency(policy: Column, last_period: Column, special: Iterable[int], special_period: int, period: int) -> Column:
    """1 when the last period is the one its rule asks for, else 0."""
    is_special = policy.isin(*special)
    hit = (is_special & (last_period == special_period)) | (~is_special & (last_period == period))
    return F.when(hit, 1).otherwise(0)
