"""Session defaults and the shared scratch area.

Everything that must outlive an executor goes to the folder named by
``spark.checkpoint.dir``; without that setting it goes below the warehouse folder
where that is shared, or where there is one machine only.
"""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Only what differs from Spark's own defaults.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split a skewed join side even when it costs an extra shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Methods above this size are never compiled by the JVM: wide rosters use split code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settled paths with what deletes them: those of open blocks, by thread, and the application's.
_Settled = tuple[str, object]
_blocks = threading.local()
_application: list[_Settled] = []
_lock = threading.Lock()


def build_session(app: str = "rosterflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compile_split_code(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the limit of generated methods, unless it has one of its own.

    A wide roster's rows are one method under Spark's default, too large for the JVM's
    compiler, and run interpreted; split code is compiled.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, DEFAULTS[name])


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir")
        alone = spark.sparkContext.master.split("[")[0] == "local"
        if not alone and configured.split(":")[0] in (configured, "file"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    root = configured.rstrip("/")
    # One spelling for every reader: file:/x and file:///x are one place.
    return f"file://{root[5:]}" if root.startswith("file:/") and not root.startswith("file://") else root


def _open_blocks() -> list[list[_Settled]]:
    if not hasattr(_blocks, "stack"):
        _blocks.stack = []
    return _blocks.stack


def _own(spark: SparkSession, path: str, depth: int = 1) -> None:
    """Give a path to the ``depth``-th block from the innermost one of this thread, or to the application."""
    # The configuration of the file systems outlives its session, as the JVM does.
    settled = path, spark.sparkContext._jsc.hadoopConfiguration()
    stack = _open_blocks()
    if len(stack) >= depth:
        stack[-depth].append(settled)
        return
    with _lock:
        _application.append(settled)
    _delete_on_stop(spark.sparkContext)


def fresh_path(spark: SparkSession, label: str, owned: bool = True) -> str:
    """A path below the shared area that nothing has used yet; the current owner deletes it unless ``owned`` is false."""
    path = f"{shared_dir(spark)}/rosterflow/{label}-{uuid.uuid4().hex}"
    if owned:
        _own(spark, path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    _delete(path, spark.sparkContext._jsc.hadoopConfiguration())


def _delete(path: str, conf) -> None:
    place = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


def _release(settled: list[_Settled]) -> None:
    while settled:
        with suppress(Exception):
            _delete(*settled.pop())


def _delete_on_stop(context: SparkContext) -> None:
    """The application's paths go when its context stops."""
    if getattr(context.stop, "deletes_settled", False):
        return
    stop = context.stop

    def stop_and_delete() -> None:
        _end_of_application()
        stop()

    stop_and_delete.deletes_settled = True
    context.stop = stop_and_delete


@contextmanager
def scratch() -> Iterator[None]:
    """Owns what this thread settles inside the block and deletes it afterwards.

    A result that must live on is settled with ``outlives=True``: it belongs to
    the surrounding block, or to the application, which deletes it when its session
    stops or the process ends.
    """
    stack = _open_blocks()
    stack.append([])
    try:
        yield
    finally:
        _release(stack.pop())


@atexit.register
def _end_of_application() -> None:
    with _lock:
        settled = _application[:]
        _application.clear()
    _release(settled)


def settle(
    df: DataFrame, label: str = "settled", outlives: bool = False, rows_per_file: int | None = None, folders: str | None = None,
) -> DataFrame:
    """Write ``df`` to the shared area and return a reader over it.

    Used where a result is read more than once, or where the planner needs its
    true size: the reader's statistics come from the written files, so Catalyst
    broadcasts it only when it really is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with the
    adaptive planner splitting hot keys.  Unlike a cached block it survives the
    loss of any executor.  The shuffle files of the write are dropped with it.
    ``rows_per_file`` cuts what a task writes into several files, which the tasks that
    read it share, however few wrote it.  ``folders`` names a column each of whose
    values is written to a folder of its own, which ``drop_folder`` deletes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label, owned=False)
    _own(spark, path, depth=2 if outlives else 1)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.mode("error")
        writer = writer.partitionBy(folders) if folders else writer
        (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(settled: DataFrame, column: str, value: str) -> None:
    """Delete what ``settle`` wrote for one value of ``folders``; nothing may read it afterwards."""
    for path in {x.rpartition("/")[0] for x in settled.where(f"{column} = '{value}'").inputFiles() if f"/{column}={value}/" in x}:
        delete_path(settled.sparkSession, path)
