"""Side-by-side comparison of registered queries and their SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)):
        value = float(value)
        if math.isnan(value):
            return None
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, (datetime, date)):
        return str(value).replace(" 00:00:00", "")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark_df, con, sql) -> str | None:
    """None when both give the same rows, else a description of the first difference."""
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(got_cols, g))}\n   != {dict(zip(want_cols, w))}"
    return None
