"""Joins, lookups and small listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.session import settle

# A key is hot when it holds more than 1/HOT_SHARE of a side (so at most HOT_SHARE keys are)
# and more rows than one task handles with ease.
HOT_SHARE = 1000
HOT_ROWS = 1_000_000
SALTS = 64


def join_dimension(df: DataFrame, dimension: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """Join a derived dimension.

    It is settled first, so the planner broadcasts it exactly when its written
    size allows; beyond that it is a shuffled join whose left side the adaptive
    planner splits at hot keys.
    """
    return df.join(settle(dimension, "dimension"), on, how)


def heavy_keys(
    df: DataFrame, keys: Sequence[str], *, share: int = HOT_SHARE, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with more than ``1/share`` of the rows and ``min_rows``: one sketch pass, no shuffle by key.

    The sketch tracks many more items than can be that frequent.  Every key it
    names occurs in ``df``; the result has at most ``share`` rows, one per key.
    """
    item = F.to_json(F.struct(*[F.col(k) for k in keys]))
    complete = F.when(sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 0, item)
    stats = df.select(complete.alias("item")).agg(
        F.count("*").alias("n"),
        F.expr(f"approx_top_k(item, {share}, {share * 16})").alias("top"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    return (
        stats.select("n", F.explode("top").alias("t"))
        .where((F.col("t.count") * share > F.col("n")) & (F.col("t.count") > min_rows) & F.col("t.item").isNotNull())
        .select(F.from_json("t.item", schema).alias("k"))
        .select(*[F.col(f"k.{k}").alias(k) for k in keys])
    )


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    hot: Sequence[Mapping[str, object]] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Left join whose *right* side may hold the hot keys that the caller names (see :func:`heavy_keys`).

    The adaptive planner can split only the left side of a left join.  Here the
    rows of a hot right key are spread over ``salts`` sub-keys by the partition
    they are read in, and the few left rows of that key are repeated once per
    sub-key.  A hot key must occur on the right: it is known to match, so its
    unmatched sub-keys are dropped and the result is exactly the left join.
    Without hot keys it is the plain join.
    """
    hot = list(hot)
    if not hot:
        return left.join(right, list(keys), "left")
    spark = left.sparkSession
    flags = spark.createDataFrame(hot, right.select(*keys).schema).withColumn("_hot", F.lit(True))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_left = left.join(F.broadcast(flags), list(keys), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    salted_right = (
        right.join(F.broadcast(flags), list(keys), "left")
        .withColumn("_salt", F.when(F.col("_hot"), F.spark_partition_id() % salts).otherwise(0))
        .withColumn("_matched", F.lit(True))
        .drop("_hot")
    )
    joined = salted_left.join(salted_right, [*keys, "_salt"], "left")
    return joined.where(F.col("_hot").isNull() | F.col("_matched")).drop("_hot", "_salt", "_matched")


# --------------------------------------------------------------------- lookups


def map_lookup(df: DataFrame, key: str, target: str, table: Mapping[str, int]) -> DataFrame:
    """Exact-text lookup of a configured table; unmapped keys give null."""
    if not table:
        return df.withColumn(target, F.lit(None).cast("bigint"))
    mapping = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return df.withColumn(target, F.element_at(mapping, F.col(key).cast("string")).cast("bigint"))


def unmapped_keys(df: DataFrame, key: str, target: str) -> DataFrame:
    """Distinct keys that the lookup left without a value, null included."""
    return df.where(F.col(target).isNull()).select(key).distinct()


def unmapped_counts(df: DataFrame, key: str, target: str) -> DataFrame:
    """The keys that a lookup left without a value, null included, with their rows."""
    return df.where(F.col(target).isNull()).groupBy(key).agg(F.count("*").alias("filas"))


# -------------------------------------------------------------------- listings


def distinct_descending(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.desc(column))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """``n`` rows, by ``order`` when given (a distributed top-k, no global sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def rows_of(df: DataFrame, column: str, *values: object) -> DataFrame:
    """Rows of the given files or periods; on a partitioned history this prunes folders."""
    return df.where(F.col(column).isin(*values))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """What a DELETE leaves: rows whose predicate is false *or unknown*."""
    return df.where(~F.coalesce(predicate, F.lit(False)))
