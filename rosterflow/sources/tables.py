"""Tables: queries, chunked iteration and remote databases over JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession

FETCH_ROWS = 50000
INSERT_ROWS = 20000


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A Spark SQL query; ``{name}`` in the text stands for a DataFrame argument."""
    return spark.sql(sql, **tables)


def iterate(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time, the next one fetched meanwhile."""
    return df.toLocalIterator(prefetchPartitions=True)


def jdbc_reader(spark: SparkSession, url: str, sql: str, *, fetch_rows: int = FETCH_ROWS, **options: str) -> DataFrameReader:
    """Reader of a query that runs in the remote database; only its result travels."""
    reader = spark.read.format("jdbc").option("url", url).option("query", sql).option("fetchsize", fetch_rows)
    return reader.options(**options)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str,
    low: object,
    high: object,
    splits: int,
    fetch_rows: int = FETCH_ROWS,
    **options: str,
) -> DataFrameReader:
    """Reader of a large remote table, in ``splits`` parallel ranges of ``split_column``."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", fetch_rows)
        .option("partitionColumn", split_column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", splits)
        .options(**options)
    )


def documents_query(table: str, column: str, documents: Iterable[int]) -> str:
    """The pass-through query for a list of document numbers."""
    listed = ", ".join(str(int(d)) for d in documents)
    return f"SELECT * FROM {table} WHERE {column} IN ({listed})"


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", batch_rows: int = INSERT_ROWS, **options: str) -> None:
    """Parallel batched inserts, one connection per partition."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_rows).options(
        **options
    ).mode(mode).save()
