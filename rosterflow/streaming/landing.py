"""Incremental folder load: each new file is loaded once, then cleaned away."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterflow.session import fresh_path, scratch, settle
from rosterflow.sinks.history import usable_keys
from rosterflow.sinks.versioned import History

Prepare = Callable[[DataFrame], DataFrame]
ORIGIN = ("_file", "_time")
# Fixed value: the file source forgets files older than its newest one by this much, and then never loads them.
NO_AGE_LIMIT = "36500d"


def newer_rows(rows: DataFrame, key: str, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows to load, and ``key, time, file`` of where they come from.

    Of a key's rows (with ``_file`` and ``_time``) those of its newest file count, and
    only if that is newer than what ``loaded`` (key, time, file) says of the key; files
    of one time are ordered by name.
    """
    text = F.col(key).cast("string")
    # The largest of structs is found by sorting: of a row per key and file, written first, as the planner would join both steps.
    sent = settle(rows.select(text.alias("key"), F.col("_time").alias("time"), F.col("_file").alias("file")).distinct(), "sent")
    newest = sent.groupBy("key").agg(F.max(F.struct("time", "file")).alias("new"))
    known = loaded.select("key", F.struct("time", "file").alias("old"))
    due = newest.join(known, "key", "left").where(F.col("old").isNull() | (F.col("new") > F.col("old")))
    # Written first: a row per key, broadcast by its true size, so that the rows are not shuffled by their few keys.
    marks = settle(due.select("key", "new.time", "new.file"), "marks")
    of = marks.select(F.col("key").alias("_key"), F.col("time").alias("_of_time"), F.col("file").alias("_of_file"))
    same = (text == F.col("_key")) & (F.col("_time") == F.col("_of_time")) & (F.col("_file") == F.col("_of_file"))
    return rows.join(of, same, "left_semi").drop(*ORIGIN), marks


def land(
    spark: SparkSession,
    folder: str,
    history_path: str,
    key: str,
    prepare: Prepare,
    *,
    schema,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Load what is new in ``folder`` into the versioned history, replacing each key's rows, and stop.

    The newest file of a key is the one that counts, whatever the batches and runs:
    the history keeps, with each key's rows, the time and name of their file, and a
    batch replaces only what is older.  A file that arrives late is ignored for keys
    of which a newer one is loaded and loaded for all others, however old it is.

    The stream's checkpoint remembers the files already taken (all of them, as there
    is no age limit: ``maxFileAge`` may be given to set one).  Rows and marks are
    committed in one step, so a batch that is retried changes nothing.
    ``clean_source`` is ``off``, ``archive`` or ``delete`` and acts after the batch is
    committed.  Where ``prepare`` keeps the columns ``_file`` and ``_time`` that its batch
    has, a batch holds ``files_per_batch`` files, by default all there are; a ``prepare``
    that drops them gets one file per batch.
    """
    options = {"maxFileAge": NO_AGE_LIMIT} | options
    reader = spark.readStream.format(fmt).schema(schema).option("cleanSource", clean_source).options(**options)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    stream = reader.load(folder).schema
    told = prepare(spark.createDataFrame([], stream).withColumns({"_file": F.lit(""), "_time": F.current_timestamp()}))
    by_row = set(ORIGIN) <= set(told.columns)
    if not by_row and (files_per_batch or 1) > 1:
        raise ValueError("several files in a batch need the columns _file and _time")
    if files_per_batch or not by_row:
        reader = reader.option("maxFilesPerTrigger", files_per_batch or 1)
    table = History(spark, history_path, key)
    adaptive = "spark.sql.adaptive.enabled"

    def load(batch: DataFrame, _: int) -> None:
        # A stream's session has this off, and then all rows of a key are written by one task.
        batch.sparkSession.conf.set(adaptive, spark.conf.get(adaptive))
        with scratch():
            replace_older(batch)

    def replace_older(batch: DataFrame) -> None:
        rows = prepare(batch)
        if not by_row:
            origin = batch.select(*ORIGIN).first()
            if origin is None:
                return
            rows = rows.withColumns({"_file": F.lit(origin["_file"]), "_time": F.lit(origin["_time"]).cast("timestamp")})
        rows, marks = newer_rows(usable_keys(rows, key), key, table.marks())
        if not marks.isEmpty():
            table.replace(rows, marks=marks)

    return (
        reader.load(folder)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or fresh_path(spark, "landing"))
        .trigger(availableNow=True)
        .start()
    )


def land_and_wait(*args, **kwargs) -> None:
    """:func:`land`, returning when everything available is loaded."""
    query = land(*args, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
