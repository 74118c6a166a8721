"""Facts told at scan time against the rules that pass over rows, however files are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import facts, headers, rows

CELLS = [None, "", " ", "None", "NaN", "nan", "　", "x", "Total", "12", "nano"]


def _sheets(draw):
    out = []
    for f in range(12):
        first = draw.choice([0, -3, 5])
        for i in range(draw.choice([1, 2, 3, 9, 40])):
            blank = i in (0, 1) and draw.random() < 0.5 or draw.random() < 0.25
            cells = [draw.choice(CELLS[:7]) if blank else draw.choice(CELLS) for _ in range(draw.randint(0, 7))]
            out.append((f"f{f}", first + 2 * i, cells))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_facts_settle_the_rules(spark, seed, monkeypatch):
    monkeypatch.setattr(facts, "HELD_FACTS", 5)
    draw = random.Random(seed)
    df = spark.createDataFrame(_sheets(draw), "_file string, _row long, cells array<string>").repartition(draw.choice([1, 3, 7]), "_row")
    told = facts.told_rows(df, words=rows.FOOTER_WORDS)
    got = {r["_file"]: r for r in facts.file_facts(told, drop_leading=True).collect()}

    filled = df.withColumn("_n", rows.filled_cells(F.col("cells")))
    width = df.groupBy("_file").agg(F.max(F.size("cells")).alias("_w"))
    kept, gone = rows.split_leading(filled.join(width, "_file"), rows.width_ratio(F.col("_n"), F.col("_w")))
    lead = {}
    for r in gone.collect():
        lead.setdefault(r["_file"], []).append(r["_row"])
    header = {r["_file"]: r for r in headers.header_table(kept.select("_file", "_row", "cells")).collect()}
    assert set(got) == set(header)
    ends = {r["_file"]: r for r in kept.groupBy("_file").agg(F.max("_row").alias("end"), F.max(F.when(F.col("_n") > 0, F.col("_row"))).alias("filled")).collect()}
    for name, r in got.items():
        assert sorted(r["_lead"]) == sorted(lead.get(name, [])), name
        assert (r["_header_row"], r["names"], r["_width"]) == (header[name]["_header_row"], header[name]["names"], len(header[name]["names"]))
        assert (r["_end"], r["_end_filled"]) == (ends[name]["end"], ends[name]["filled"])


@pytest.mark.parametrize("seed", range(3))
def test_the_last_row_that_stays(spark, seed):
    draw = random.Random(10 + seed)
    df = spark.createDataFrame(_sheets(draw), "_file string, _row long, cells array<string>").repartition(5)
    told = facts.told_rows(df)
    files = facts.file_facts(told).withColumn("keep", facts.last_row(facts.share_of([F.lit(1), F.lit(3), F.lit(None).cast("int")]), 0.7))
    got = {r["_file"]: r["keep"] for r in files.collect()}
    named = df.select("_file", "_row", F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(2)).alias("b"), F.lit(None).cast("string").alias("c"))
    kept, _ = rows.split_trailing(named, rows.nullish_ratio(["a", "b", "c"]), threshold=0.7)
    want = {r["_file"]: r["m"] for r in kept.groupBy("_file").agg(F.max("_row").alias("m")).collect()}
    assert {k: v for k, v in got.items() if v is not None} == want


def test_shapes_and_words(spark):
    df = spark.createDataFrame([("f", 0, ["a", None, "NONE", "SUMA x"]), ("f", 1, []), ("f", 2, None)], "_file string, _row long, cells array<string>")
    told = facts.told_rows(df, columns=3, words=rows.FOOTER_WORDS)
    assert [(r["_shape"], r["_spoken"]) for r in facts.rows_of(told).orderBy("_row").collect()] == [("100", False), ("", False), ("", False)]
    assert facts.rows_of(facts.told_rows(df, words=rows.FOOTER_WORDS)).where("_row = 0").first()["_spoken"] is True
    assert facts.told_rows(df.limit(0)).count() == 0


def test_a_known_last_row_spares_a_pass(spark):
    df = spark.createDataFrame([("f", 1, "5"), ("f", 2, "6"), ("f", 3, "11"), ("g", 1, "4"), ("g", 2, "5")], "_file string, _row long, m string")
    last = F.when(F.col("_file") == "f", 3).otherwise(2)
    for known in (None, last):
        kept, gone = rows.split_total(df, {"m": 2}, last=known)
        assert kept.count() == 4 and [r["_row"] for r in gone.collect()] == [3]
