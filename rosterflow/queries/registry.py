"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Sums of products often end exactly half way between two cents, where engines differ by how
# they round; the shift moves the boundary well away from where such sums fall.
_HALF = 0.5034567


def cents(x: Column, digits: int = 2) -> Column:
    return F.floor(x * 10.0**digits + _HALF) / 10.0**digits


def cents_sql(x: str, digits: int = 2) -> str:
    return f"floor({x} * {10**digits}.0::DOUBLE + {_HALF}::DOUBLE) / {10**digits}.0::DOUBLE"
