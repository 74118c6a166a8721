"""History tables: Parquet folders partitioned by file name or period.

The reload of a file replaces exactly its partition; nothing else is read.
Before each write ``REBALANCE`` gathers the rows of a partition into files of
the advisory size and splits a partition that is too large for one task, so a
hot file is written by many tasks and a tiny one makes a single file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.text import strip
from rosterflow.session import fresh_path, scratch, settle

# What a load did to a key.
REPLACED = "reemplazo"
INSERTED = "inserción nueva"

LISTED_KEYS = 10_000


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


_GUESS = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_history(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table; partition keys are text as they were written (``007`` and ``2025-01-01`` stay so)."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    before = spark.conf.get(_GUESS)
    spark.conf.set(_GUESS, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_GUESS, before)


def usable_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows with a non-blank key, the key trimmed; the others are never loaded (see :func:`unloaded_rows`)."""
    text = strip(F.col(key).cast("string"))
    typed = text if dict(df.dtypes)[key] == "string" else F.col(key)
    return df.where(F.coalesce(F.length(text) > 0, F.lit(False))).withColumn(key, typed)


def unloaded_rows(df: DataFrame, key: str) -> int:
    """How many rows have a null or blank key."""
    return df.where(~F.coalesce(F.length(strip(F.col(key).cast("string"))) > 0, F.lit(False))).count()


def _write(df: DataFrame, path: str, key: str, mode: str) -> None:
    (
        df.hint("rebalance", F.col(key))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, key: str, values: Iterable[object] | None = None) -> None:
    """Replace the partitions of the keys in ``df``; with ``values``, of those keys instead.

    A listed value without rows loses its partition; rows whose key is not
    listed are appended, as a delete by list followed by an insert would do.  Values
    are compared as the text of the key's type, so 202503 and ``'202503'`` name the
    same partition; null ones name none.
    """
    rows = usable_keys(df, key)
    if values is None:
        _write(rows, path, key, "overwrite")
        return
    spark = df.sparkSession
    listed = [r[0] for r in key_texts(spark, values, df.schema[key].dataType).collect()]
    # Written first, the rows are computed once and may come from the table itself.
    with scratch():
        rows = settle(rows, "replacement")
        named = F.col(key).cast("string").isin(*listed) if listed else F.lit(False)
        _write(rows.where(named), path, key, "overwrite")
        others = rows.where(~named)
        if not others.isEmpty():
            _write(others, path, key, "append")
        sent = {r[0] for r in rows.where(named).select(F.col(key).cast("string")).distinct().collect()}
    # Last, so that a failed write leaves every listed partition as it was.
    drop_partitions(spark, path, key, [v for v in listed if v not in sent])


def key_texts(spark: SparkSession, values: Iterable[object], kind: T.DataType) -> DataFrame:
    """Listed key values as ``key``, the distinct texts that a key of type ``kind`` has; values that are none of its are left out."""
    texts = spark.createDataFrame([(None if v is None else str(v),) for v in values], "v string")
    typed = strip(F.col("v")) if isinstance(kind, T.StringType) else F.col("v").try_cast(kind).cast("string")
    return texts.select(typed.alias("key")).where("key is not null and length(key) > 0").distinct()


def drop_partitions(spark: SparkSession, path: str, key: str, values: Iterable[object]) -> int:
    """Remove the partitions of ``values``; returns how many existed."""
    removed = 0
    for value in values:
        fs, target = _filesystem(spark, f"{path}/{key}={_partition_text(spark, value)}")
        if fs.exists(target):
            removed += int(fs.delete(target, True))
    return removed


def _partition_text(spark: SparkSession, value: object) -> str:
    """Spark's own escaping of a partition value."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def append(df: DataFrame, path: str, key: str | None = None) -> None:
    if key is None:
        df.write.mode("append").parquet(path)
    else:
        _write(usable_keys(df, key), path, key, "append")


def truncate_and_load(df: DataFrame, path: str, key: str | None = None) -> None:
    """Empty the whole table, then insert."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(key) if key else writer).parquet(path)


def load_summary(df: DataFrame, key: str, history: DataFrame | None) -> DataFrame:
    """Per key of the load: its rows, the rows it replaces, and which of the two happened.

    Of the history only the loaded keys are counted: its partitions are pruned by
    the list of keys up to ``LISTED_KEYS`` of them, beyond by a join.  A history read
    as text is compared in the type of the load's key.
    """
    loaded = settle(usable_keys(df, key).groupBy(key).agg(F.count("*").alias("filas")), "loaded", outlives=True)
    if history is None:
        before = loaded.select(key, F.lit(0).cast("bigint").alias("filas_previas")).limit(0)
    else:
        sent = [r[0] for r in loaded.select(F.col(key).cast(history.schema[key].dataType)).limit(LISTED_KEYS + 1).collect()]
        if len(sent) <= LISTED_KEYS:
            history = history.where(F.col(key).isin(*sent))
        else:
            history = history.join(loaded.select(F.col(key).cast(history.schema[key].dataType)), key, "left_semi")
        before = history.groupBy(F.col(key).try_cast(loaded.schema[key].dataType).alias(key)).agg(F.count("*").alias("filas_previas"))
    joined = loaded.join(before, key, "left")
    previous = F.coalesce("filas_previas", F.lit(0)).cast("bigint")
    return joined.select(
        key, "filas", previous.alias("filas_previas"), F.when(previous > 0, REPLACED).otherwise(INSERTED).alias("accion")
    )


# ---------------------------------------------------------------------- upsert


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after a merge of ``stage`` by ``keys``.

    Matched target rows take the stage's other columns (a stage of keys only
    changes nothing), unmatched stage rows are inserted, null keys never match.
    A key repeated in the stage is an error.  One full outer join reads the target
    once; rows with a null key, which meet nothing in it, are spread by their content.
    """
    keys = list(keys)
    stage = settle(stage, "stage", outlives=True)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    repeated = stage.where(known).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"the stage repeats a key of {keys}")
    incoming = stage.select(*[F.col(c).alias(f"_new_{c}") for c in stage.columns], F.lit(True).alias("_hit"))
    # Null keys equal nothing, so their rows come out of the join as they are, from either side.
    new_known = reduce(Column.__and__, [F.col(f"_new_{k}").isNotNull() for k in keys])
    old = target.withColumns({"_old": F.lit(True), "_spread": _spread(target, known)})
    incoming = incoming.withColumn("_new_spread", _spread(incoming, new_known))
    same = F.col("_spread") == F.col("_new_spread")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_new_{k}"))
    joined = old.join(incoming, same, "full_outer")

    def merged(c: str) -> Column:
        if c not in stage.columns:
            return F.col(c)
        if c in keys:
            return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)
        return F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in target.columns])


def _spread(df: DataFrame, known: Column) -> Column:
    """0 for rows with a complete key, else a hash of what the row holds, so that no task gets all of them."""
    hashed = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return F.when(known, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*hashed))


def write_upsert(target_path: str, stage: DataFrame, keys: Sequence[str], new_path: str) -> DataFrame:
    """Write the merged table to ``new_path`` (never over the path being read) and return it."""
    spark = stage.sparkSession
    merged = upsert(spark.read.parquet(target_path), stage, keys)
    merged.write.mode("error").parquet(new_path)
    return spark.read.parquet(new_path)


def upsert_table(name: str, stage: DataFrame, keys: Sequence[str], place: str | None = None) -> DataFrame:
    """Merge ``stage`` into a catalogued table, which then holds the merged rows under its own name.

    The new rows are written beside the old ones and the catalogue is pointed to
    them in one step: a reader sees the table before or after, and a failed write
    leaves it as it was.  The old files stay where they are, for readers that have
    begun.
    """
    spark = stage.sparkSession
    place = place or fresh_path(spark, name, owned=False)
    upsert(spark.table(name), stage, keys).write.mode("error").parquet(place)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


# ------------------------------------------------------------- derived tables


def rebuild_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop and recreate a derived table from a query; at ``path`` when given."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.format("parquet").mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def insert_select(df: DataFrame, name: str) -> None:
    """Append a query result to a table, by column name."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)
