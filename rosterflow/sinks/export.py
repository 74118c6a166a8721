"""Exports and timed statements."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from rosterflow.operators.headers import exportable_text


def export_shown(df: DataFrame, path: str, fmt: str = "csv", n: int = 100) -> None:
    """The previewed rows (the first ``n``) as CSV or Parquet, text made valid UTF-8."""
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt must be csv or parquet")
    shown = exportable_text(df.limit(n))
    writer = shown.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def run_statement(spark: SparkSession, sql: str) -> dict[str, object]:
    """Run one statement to its end; seconds (3 decimals) and the error text instead of an exception.

    A statement that yields rows is run in full, its rows are not kept.
    """
    started = time.perf_counter()
    error = None
    try:
        found = spark.sql(sql)
        if found.columns:
            found.write.format("noop").mode("overwrite").save()
    except Exception as problem:  # reported, as the caller asked for a result and not a raise
        error = str(problem)
    return {"ok": error is None, "seconds": round(time.perf_counter() - started, 3), "error": error}
