"""Headers, row cleaning, joins and quality."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterflow.operators import headers, quality, relational, rows


def test_make_unique():
    assert headers.make_unique(["a", "b", "a", "a", "", None, "b"]) == ["a", "b", "a_2", "a_3", "col", "col_2", "b_2"]
    assert headers.make_unique(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]


@given(st.lists(st.sampled_from(["", "a", "a_2", "b", "col", "a_3"]), max_size=12))
def test_make_unique_is_unique(names):
    got = headers.make_unique(names)
    assert len(set(got)) == len(names)


def test_header_rows():
    assert headers.promoted_names(["N° Op", None, "", "N° Op"]) == ["n_op", "col_2", "col_3", "n_op_2"]
    assert headers.sheet_names([None, "RUT Cliente", "RUT Cliente"]) == ["unnamed_0", "rut_cliente", "rut_cliente_1"]
    assert headers.twin_columns(["x", "rut_cliente", "rut_cliente_2"], "rut_cliente") == ("rut_cliente", "rut_cliente_2")
    with pytest.raises(ValueError):
        headers.twin_columns(["rut_cliente"], "rut_cliente")


def test_pick_required_and_filled(spark):
    df = spark.createDataFrame([("", "b"), (None, "c")], "x string, y string")
    with pytest.raises(KeyError):
        headers.pick(df, "z", required=True)
    assert [r[0] for r in df.select(headers.pick_filled(df, "x", "y")).collect()] == ["", "c"]
    assert [r[0] for r in df.select(headers.pick_filled(df, "x", "y", blank_as_null=True)).collect()] == ["b", "c"]


def _roster(spark, cells):
    data = [("f", i, *row) for i, row in enumerate(cells)]
    return spark.createDataFrame(data, "_file string, _row bigint, a string, b string, c string")


def _kept(df):
    return sorted(r["_row"] for r in df.select("_row").collect())


def test_leading_and_trailing_rows(spark):
    df = _roster(spark, [("", None, "nan"), ("x", "y", "z"), ("", "", ""), ("x", "", "z"), ("", "", ""), (" ", "None", None)])
    kept, gone = rows.split_leading(df, rows.row_ratio(df))
    assert (_kept(kept), _kept(gone)) == ([1, 2, 3, 4, 5], [0])
    kept, gone = rows.split_trailing(df, rows.row_ratio(df))
    assert (_kept(kept), _kept(gone)) == ([0, 1, 2, 3], [4, 5])


def test_leading_never_checks_beyond_its_limit(spark):
    df = _roster(spark, [("", "", "")] * 4)
    assert _kept(rows.split_leading(df, rows.row_ratio(df))[0]) == [2, 3]
    assert _kept(rows.split_trailing(df, rows.row_ratio(df))[0]) == []
    assert _kept(rows.split_leading(df, rows.row_ratio(df), check=0)[0]) == [0, 1, 2, 3]


@pytest.mark.parametrize(
    ("last", "expected"),
    [(("", "60", ""), 2), (("", "60.4", None), 2), (("", "61", ""), 3), (("x", "60", ""), 3), (("", "abc", ""), 3)],
)
def test_total_row(spark, last, expected):
    df = _roster(spark, [("p", "20", "q"), ("p", "40", "q"), last])
    assert rows.split_total(df, {"b": 2})[0].count() == expected


def test_total_needs_all_columns_and_two_rows(spark):
    assert rows.split_total(_roster(spark, [("", "0", "")]), {"b": 2})[0].count() == 1
    assert rows.split_total(_roster(spark, [("p", "20", "q"), ("", "20", "")]), {"b": 2, "zz": 2})[0].count() == 2


def test_footer_reasons(spark):
    spoken = _roster(spark, [("p", "1", "q"), ("Subtotal", "9", "")])
    _, removed, audit = rows.split_footer(spoken, {"b": rows.to_number(F.col("b"))})
    assert audit.first()["motivo"] == "keyword_match" and removed.count() == 1
    summed = _roster(spark, [("p", "1.5", "q"), ("p", "2", "q"), ("", "3.5", "")])
    assert rows.split_footer(summed, {"b": rows.to_number(F.col("b"))})[2].first()["motivo"] == "numeric_sum_match"
    plain = _roster(spark, [("p", "1.5", "q"), ("p", "2", "q")])
    assert rows.split_footer(plain, {"b": rows.to_number(F.col("b"))})[2].first()["footer_eliminado"] is False


def test_ratio_without_columns(spark):
    assert spark.range(1).select(rows.nullish_ratio([])).first()[0] == 1.0


def test_skewed_left_join_is_the_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (1, "e")], "k int, l string")
    right = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 900, 1).otherwise((F.col("id") % 5 + 4).cast("int")).alias("k"), F.col("id").alias("r"))
    right = right.unionByName(spark.createDataFrame([(2, 5000), (None, 1)], "k int, r bigint"))
    hot = [r["k"] for r in relational.heavy_keys(right, ["k"], share=4, min_rows=0).collect()]
    assert hot == [1]
    plain = left.join(right, ["k"], "left")
    salted = relational.skew_left_join(left, right, ["k"], hot=[{"k": k} for k in hot], salts=4)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    assert {r["x"] for r in relational.delete_where(df, F.col("x") < 3).collect()} == {5, None}


def test_valid_keys_fail_without_any(spark):
    with pytest.raises(ValueError):
        quality.valid_keys(spark.createDataFrame([(" ",), (None,)], "k string"), "k")
    with pytest.raises(ValueError):
        quality.valid_keys(spark.range(1), "k")
