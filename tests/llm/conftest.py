import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, id long, bucket string"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
PROSE = "The first line of a plain text that is long enough.\nAnd a second line, which says something else again.\nThird."
ROWS = [
    (1, "", "en", "a", 0, True, 9, "x"),
    (2, None, None, None, None, None, None, None),
    (None, PROSE + " With an end of its own and a null key for it.", "en", "b", 1, False, 1, "y"),
    (3, " \n\t \r ", "de", None, 5, True, 1, "y"),
    (4, "Word", "de", "a", 4, True, 1, "y"),
    (5, LONG, "en", "a", 10, True, 1, "y"),
    (6, LONG + " end", "en", "a", 10, True, 1, "y"),
    (7, PROSE, None, "c", 1, True, 1, "y"),
    (8, PROSE, "en", "c", 1, True, 1, "y"),
    (9, PROSE.replace("second", "sec0nd"), "en", "c", 1, True, 1, "y"),
    (10, "x" * 50_000, "fr", "c", 1, True, 1, "y"),
    (11, "ﬁ　① ▁marker  two  spaces \U0001f600 naïve\x0bǺ 1234 !? <s> </s>", "fr", "c", 1, True, 1, "y"),
    (12, "12 34 -- !! 56", "fr", "c", 1, True, 1, "y"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with nulls, empty and long texts, ties, and columns named like the operators' own."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark):
    """The same with every row twice."""
    return spark.createDataFrame(ROWS + ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
