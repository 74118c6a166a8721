"""Golden rows of the column functions, edge values included."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import dates, identity, numbers, periods, text


def test_nullish(column):
    values = [None, "", "  ", "None", "none", "nan", "NaN", "NONE", "x", " nan\t", "nano", "0", " "]
    assert column(text.is_nullish, values) == [True] * 8 + [False, True, False, False, True]
    assert column(lambda c: text.is_nullish(c, ("", "none")), ["nan", "none", ""]) == [False, True, True]


def test_clean_cell(column):
    assert column(text.clean_cell, [None, " a ", "None", "none", "nan", "NaN", "NONE", "\tb　"]) == [
        "", "a", "", "", "", "", "NONE", "b"]


def test_quotes_and_limits(column):
    assert column(text.strip_quotes, [' "a" ', '"', None]) == ["a", "", None]
    assert column(lambda c: text.limit_text(c, 3), [" abcd ", None]) == ["abc", None]
    assert column(lambda c: text.limit_text(c, 3, trim=False), [" abcd "]) == [" ab"]


def test_bad_bytes_are_replaced(column):
    assert column(lambda c: text.readable_text(c), [b"a\xffb", "ñ".encode()], "binary") == ["a�b", "ñ"]


NAMES = {
    " Número° de Plan ": "numero_de_plan", "Fecha (Inicio)": "fecha_inicio", "Monto-$ Total": "monto_total",
    "  Año  2024  ": "ano_2024", "Nº operación": "no_operacion", "N° operación": "n_operacion", "½ №": "1_2_no",
}


def test_technical_names(column):
    assert column(text.normalize_name, list(NAMES)) == list(NAMES.values())
    assert [text.header_name(n) for n in NAMES] == list(NAMES.values())


def test_accents_agree_with_unicode_data(column):
    values = ["Márzo Septiémbre", "Árbol Ñandú", "ﬁn ĳ ǆ ½", "Ａｂ１", "é", None, ""]
    assert column(text.strip_accents, values) == column(text.strip_accents_unicode, values)


def test_accent_folding_of_every_script(column):
    names = ["Ёлка Йод", "Άνθρωπος ΰ Ώ", "한국 각", "ﷺ ㎏ ½ œuvre", "\U0001d400\U0001d7d8 \U0001f100 \U0001d15e", "שּׁ क़ नि", "が ギ ㌀", "cafe\u0301", "plain", None, "\u0301"]
    assert column(text.strip_accents, names) == [None if n is None else text.fold(n) for n in names]
    assert column(text.normalize_name, names[:2]) == [text.header_name(n) for n in names[:2]]
    assert column(text.match_form, ["Йод Άλφα"]) == ["ИОД ΑΛΦΑ"]
    every = [chr(i) for i in range(0xA0, 0x20000) if not 0xD800 <= i < 0xE000]
    blocks = ["".join(every[i:i + 500]) for i in range(0, len(every), 500)]
    assert column(text.strip_accents, blocks) == [text.fold(b) for b in blocks]


def test_period_from_name(column):
    names = ["202503.xlsx", "x 2025-03", "03_2025.csv", "Marzo 2025.xlsx", "SETIEMBRE-2024", "Dic-2023", "SEPT. 2025.xlsx",
             "sin dato", "Márzo_2025", "abril 2025 enero", None, "a/b/2025.03.xlsx", "comarzo 2025"]
    plain = ["202503", "202503", "202503", "202503", "202409", "202312", None, None, "202503", "202501", None, "202503", None]
    assert column(periods.period_from_name, names) == plain
    plain[6] = "202509"
    assert column(lambda c: periods.period_from_name(c, extra_words=True), names) == plain


def test_canonical_names(column):
    assert column(lambda c: periods.canonical_name(c, "planes"), ["202503", None]) == ["Facturacion_Cesantia_202503.xlsx", None]
    assert column(lambda c: periods.canonical_name(c, "unidad_leasing"), [None]) == ["UNIDAD LEASING - Cesantia - 000000.xlsx"]
    assert column(periods.canonical_in_place, ["Flujo Marzo 2025.xlsx", "F 202503 Enero 2020.xlsx", "2025 x SEP.xlsx", "x.xlsx"]) == [
        "Flujo 202503.xlsx", "F 202503 Enero 2020.xlsx", "2025 x SEP 202509.xlsx", "x.xlsx"]


def test_prior_and_trailing_period(column):
    assert column(periods.prior_period, [202501, 202512, None], "int") == [202412, 202511, None]
    assert column(periods.trailing_period, ["Base 202503.xlsx", "a.b", None]) == ["202503", None, None]
    assert column(periods.valid_period, ["202503", "235959", "202513", None]) == [202503, None, None, None]


def test_remittance_and_policy(column):
    assert column(periods.remittance_name, ["remesa_20251104.csv", "remesa_20250115.csv", "remesa.csv", "r_20251399.csv"]) == [
        "remesa_202510.csv", "remesa_202412.csv", None, None]
    assert column(periods.policy_from_name, ["Nom 1234567.xlsx", "1234567x.xlsx", "1234567xy.xlsx"]) == ["1234567", "1234567", None]


def test_numbers(column):
    values = ["1.5", " 7 ", "abc", "", None, "NaN", "1e3", "1d", "0x1", "+3", ".5", "5."]
    assert column(numbers.to_number, values) == [1.5, 7.0, None, None, None, None, 1000.0, None, None, 3.0, 0.5, 5.0]


def test_whole_numbers(column):
    values = ["10.5", "11.5", "7", " 8 ", "9.0", "x", None, "12345678901234567"]
    assert column(lambda c: numbers.to_whole(c, "round"), values) == [10, 12, 7, 8, 9, None, None, 12345678901234567]
    assert column(lambda c: numbers.to_whole(c, "null"), values)[:5] == [None, None, 7, 8, 9]
    with pytest.raises(Exception, match="not a whole number: 1[01].5"):
        column(numbers.to_whole, values)


def test_local_numbers(column):
    assert column(numbers.local_number, ["1.234.567,89", "12,5", "1.234", "abc", ""]) == [1234567.89, 12.5, 1234.0, None, None]
    assert column(numbers.guessed_local_number, ["1.234,5", "1.234", "12,5", "-1.5", "none", "1 000"]) == [
        1234.5, 1234.0, 12.5, -1.5, None, 1000.0]


def test_fixed_text_rounds_the_binary_value(column):
    assert column(numbers.fixed_text, ["2.675", "0.125", "1,5", "1234567.891", "", "x", "-0.005"]) == [
        "2.67", "0.12", "1.50", "1234567.89", None, None, "-0.01"]


def test_money(spark):
    df = spark.createDataFrame([(4277, 100.0), (4331, 100.0), (6270, 100.0), (8285, 100.0), (1, 100.0), (None, 1.0)], "p int, x double")
    got = df.select(numbers.commission(F.col("p"), F.col("x")).alias("c"), numbers.insured_amount(F.col("p"), F.col("x")).alias("m")).collect()
    assert [round(r["c"], 6) for r in got] == [4.76, 8.74, 6.65, 0.87, 0.0, 0.0]
    assert [r["m"] for r in got] == [400.0, 300.0, 400.0, 400.0, 400.0, 4.0]
    rates = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None)], "x double, r double")
    assert [r[0] for r in rates.select(numbers.in_units(F.col("x"), F.col("r"))).collect()] == [2.5, None, None]


def test_vigency(spark):
    df = spark.createDataFrame([(1, 202510), (1, 202511), (2, 202511), (2, 202510), (None, 202511), (2, None)], "d int, m int")
    got = df.select(numbers.vigency(F.col("d"), F.col("m"), [1], 202510, 202511).alias("v")).collect()
    assert [r["v"] for r in got] == [1, 0, 1, 0, 0, 0]


DATES = ["05/09/2025", "2020-10-21 00:00:00", "07-04-1947", "45905", "20250905", "20250905.0", "0", "60001", "30/02/2025", None, ""]


def test_mixed_dates(column):
    got = column(lambda c: dates.as_int(dates.mixed_date(c)), DATES)
    assert got == [20250905, 20201021, 19470407, 20250905, 20250905, 20250905, 18991230, None, None, None, None]
    assert column(dates.mixed_date_failed, DATES) == [False] * 7 + [True, True, False, False]
    assert column(lambda c: dates.mixed_date(c, base=dates.CALENDAR_1904), ["1"]) == [date(1904, 1, 2)]


def test_other_dates(column):
    assert column(dates.date_number, DATES) == [20250509, 20201021, 19470704, 20250905, 20250905, None, None, None, None, None, None]
    assert column(dates.listed_date, ["2025-9-5", "05-09-2025", "05/09/2025", "2025/09/05", "45905.7", "1", "x"]) == [date(2025, 9, 5)] * 5 + [None, None]
    assert column(dates.compact_text, ["2025-09-05", "45905", "45905.5", "x", "1/2/2025"]) == ["20250905", None, "20250905", None, None]
    assert column(dates.strict_timestamp_number, ["2025-09-05 00:00:00", "2025-09-05", "05/09/2025"]) == [20250905, None, None]
    assert column(lambda c: dates.clamp_date(dates.text_date(c)), ["1700-01-01", "1753-01-01", "9999-12-31"]) == [
        None, date(1753, 1, 1), date(9999, 12, 31)]


RUTS = ["12.345.678-9", "12345678-k", "12345678K", "", "123456789012", None]


def test_identifiers(column):
    assert column(identity.hyphen_number, RUTS) == ["12345678", "12345678", None, None, None, None]
    assert column(identity.hyphen_digit, RUTS) == ["9", "K", None, None, None, None]
    assert column(identity.joined_number, RUTS) == [12345678, 12345678, 12345678, None, 12345678901, None]
    assert column(identity.joined_digit, RUTS) == ["9", "K", "K", None, "2", None]
    assert column(identity.digits_only, ["BCH00010406", "-", None]) == ["00010406", None, None]
    assert column(identity.has_valid_shape, ["12.345.678", "12345", "123456789", None, "1234k67"]) == [True, False, False, False, False]
    assert column(identity.check_digit, [" k ", "10", "", None]) == ["K", "1", None, None]
