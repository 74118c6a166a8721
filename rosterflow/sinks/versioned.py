"""A history table whose loads take effect in one step.

Every load writes its rows to a folder of its own, partitioned by key.  A
manifest says which folder holds the live rows of a key, and how many there are;
a load is committed by creating the next version file, which names its manifest.
Until then the table is as it was, whatever happens to the load, and readers keep
the version they began with.  Nothing is rewritten but the keys a load touches.

``data/_load=<id>/<key>=<value>/``, ``manifests/<id>/`` (Parquet: key, load, rows, and time and file of what a stream loaded),
``versions/<number>`` (JSON: manifest, schema).  Two loads at once cannot make the
same version: the second one fails and changes nothing.  This needs a file system
that refuses to create a file twice, as HDFS and local ones do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import delete_path, settle
from rosterflow.sinks.history import INSERTED, REPLACED, _filesystem, key_texts, path_exists, read_history, upsert, usable_keys

LOAD = "_load"
_MANIFEST = "key string, load string, rows long, time timestamp, file string"
# Loads that were never committed are left alone this long: they may still be running.
ORPHAN_HOURS = 24
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Files that a task writes at once; the rows of further keys are sorted.
OPEN_FILES = 10


class ConcurrentLoad(RuntimeError):
    """Another load has been committed since this one began."""


class History:
    """The versioned table at ``path``, partitioned by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    # ------------------------------------------------------------- versions

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, ascending."""
        if not path_exists(self.spark, f"{self.path}/versions"):
            return []
        fs, folder = _filesystem(self.spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _entry(self, version: int | None) -> tuple[int, dict | None]:
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, None
        fs, file = _filesystem(self.spark, f"{self.path}/versions/{version:08d}")
        stream = fs.open(file)
        try:
            return version, json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """``key, load, rows, time, file``: where the rows of a key are; a null key is that of rows without one."""
        _, entry = self._entry(version)
        if entry is None:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests/{entry['manifest']}")

    def read(self, version: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The rows of a version, by default the latest; keys are text as they were written.

        The version is fixed now: later loads do not change what the result reads.
        With ``keys`` (key) only the folders of those keys are read.
        """
        number, entry = self._entry(version)
        if entry is None:
            raise FileNotFoundError(f"no load has been committed to {self.path}")
        live = self.manifest(number)
        if keys is not None:
            chosen = keys.select(F.col("key").alias("_chosen"))
            # Written first, so that its size is known and it is broadcast to prune the folders.
            live = settle(live.join(chosen, live["key"].eqNullSafe(F.col("_chosen")), "left_semi"), "live")
        return self._rows(live, T.StructType.fromJson(entry["schema"]))

    def marks(self, version: int | None = None) -> DataFrame:
        """``key, time, file``: the newest file of each key that a load with marks has brought."""
        newest = self.manifest(version).where("time is not null").groupBy("key").agg(F.max(F.struct("time", "file")).alias("m"))
        return newest.select("key", "m.time", "m.file")

    def _rows(self, live: DataFrame, schema: T.StructType) -> DataFrame:
        columns = [f.name for f in schema]
        fields = [f for f in schema if f.name != self.key] + [T.StructField(LOAD, T.StringType()), T.StructField(self.key, T.StringType())]
        if not path_exists(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], schema)
        rows = read_history(self.spark, f"{self.path}/data", T.StructType(fields))
        # The filter lets the planner prune folders by the manifest at run time.  It does so by
        # equality only, hence the key's comparison without nulls beside the one with them.
        live = live.where("rows > 0").select(F.col("load").alias("_of_load"), F.col("key").alias("_of_key"))
        texts = F.coalesce(F.col(self.key), F.lit("")) == F.coalesce("_of_key", F.lit(""))
        same = (F.col(LOAD) == F.col("_of_load")) & F.col(self.key).eqNullSafe(F.col("_of_key")) & texts
        return rows.join(live, same, "left_semi").select(*columns)

    def _commit(self, after: int, manifest: DataFrame, schema: T.StructType) -> int:
        """Make ``manifest`` the version that follows ``after``."""
        name = uuid.uuid4().hex
        manifest.write.parquet(f"{self.path}/manifests/{name}")
        return self._publish(after, name, schema)

    def _publish(self, after: int, manifest: str, schema: T.StructType) -> int:
        fs, file = _filesystem(self.spark, f"{self.path}/versions/{after + 1:08d}")
        text = json.dumps({"manifest": manifest, "schema": json.loads(schema.json())})
        try:
            stream = fs.create(file, False)
        except Exception as error:
            if fs.exists(file):
                raise ConcurrentLoad(f"version {after + 1} of {self.path} exists already") from error
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return after + 1

    # ---------------------------------------------------------------- loads

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` to a folder of their own: ``key, load, rows`` of what they hold."""
        load = uuid.uuid4().hex
        folder = f"{self.path}/data/{LOAD}={load}"
        # A task with few keys keeps a file open for each instead of sorting its rows, which one file's hot key may all be.
        conf = rows.sparkSession.conf
        before = conf.get(_WRITERS)
        conf.set(_WRITERS, str(OPEN_FILES))
        try:
            rows.hint("rebalance", F.col(self.key)).write.partitionBy(self.key).parquet(folder)
        finally:
            conf.set(_WRITERS, before)
        # Counted from the written files, which holds their footers only.
        written = read_history(self.spark, folder, T.StructType([T.StructField(self.key, T.StringType())])) if self._has_keys(folder) else None
        if written is None:
            return self.spark.createDataFrame([], "key string, load string, rows long")
        return written.groupBy(F.col(self.key).alias("key")).agg(F.count("*").alias("rows")).select("key", F.lit(load).alias("load"), "rows")

    @staticmethod
    def _marked(entries: DataFrame, marks: DataFrame | None) -> DataFrame:
        """Manifest entries with the ``time, file`` of their key."""
        if marks is None:
            return entries.withColumns({"time": F.lit(None).cast("timestamp"), "file": F.lit(None).cast("string")})
        of = marks.select(F.col("key").alias("_key"), "time", "file")
        return entries.join(of, entries["key"].eqNullSafe(of["_key"]), "left").drop("_key")

    def _has_keys(self, folder: str) -> bool:
        fs, place = _filesystem(self.spark, folder)
        return any(s.isDirectory() for s in fs.listStatus(place))

    def _schema(self, entry: dict | None, df: DataFrame) -> T.StructType:
        """The columns of the table and then those that ``df`` adds; the key is text."""
        known = {f.name: f for f in T.StructType.fromJson(entry["schema"])} if entry else {}
        for f in df.schema:
            kind = T.StringType() if f.name == self.key else f.dataType
            if f.name in known and known[f.name].dataType != kind:
                raise TypeError(f"{f.name} is {known[f.name].dataType.simpleString()} in the table and {kind.simpleString()} in the load")
            known[f.name] = T.StructField(f.name, kind)
        return T.StructType(list(known.values()))

    def replace(self, df: DataFrame, values: Iterable[object] | None = None, marks: DataFrame | None = None) -> DataFrame:
        """Replace the rows of the keys in ``df``, or of those listed; returns the load's summary.

        A listed key without rows loses its rows; rows whose key is not listed are
        added.  Listed values are compared in the type of the key: 202503 names the
        same key in a load of texts and of numbers.  Rows without a key are not loaded.
        ``marks`` (key, time, file) say which file a key's rows come from; they are
        committed with the rows.
        The summary has, per key of the load, its rows, the rows there were, and which
        of the two happened (``filas, filas_previas, accion``), all from the manifests.
        """
        before, entry = self._entry(None)
        rows = usable_keys(df, self.key)
        schema = self._schema(entry, rows)
        old, new = self.manifest(before), self._write(rows)
        gone = new.select("key").distinct() if values is None else key_texts(self.spark, values, df.schema[self.key].dataType)
        kept = old.join(gone, "key", "left_anti")
        after = self._commit(before, kept.unionByName(self._marked(new, marks)), schema)
        return self.summary(after)

    def append(self, df: DataFrame) -> DataFrame:
        """Add the rows of ``df``; returns the summary."""
        return self.replace(df, values=())

    def summary(self, version: int) -> DataFrame:
        """What the load of ``version`` did: the rows it brought by key, and the rows these keys had before."""
        now, then = self.manifest(version), self.manifest(version - 1)
        brought = now.join(then.select("load").distinct(), "load", "left_anti").groupBy("key").agg(F.sum("rows").alias("filas"))
        previous = then.groupBy("key").agg(F.sum("rows").alias("filas_previas"))
        joined = brought.join(previous, "key", "left")
        count = F.coalesce("filas_previas", F.lit(0)).cast("bigint")
        return joined.select(
            F.col("key").alias(self.key), "filas", count.alias("filas_previas"), F.when(count > 0, REPLACED).otherwise(INSERTED).alias("accion")
        )

    def upsert(self, stage: DataFrame, keys: Sequence[str]) -> int:
        """Merge ``stage`` by ``keys`` (see :func:`history.upsert`); returns the new version.

        Only the partitions that hold a matched row are written anew; what is inserted
        is added to the others.  A stage that changes the partition key moves rows.  Marks stay.
        """
        before, entry = self._entry(None)
        if entry is None:
            raise FileNotFoundError(f"no load has been committed to {self.path}")
        schema = T.StructType.fromJson(entry["schema"])
        old = self.manifest(before)
        whole = self._rows(old, schema)
        match = reduce(Column.__and__, [F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in keys])
        hit = whole.alias("_t").join(stage.select(*keys).alias("_s"), match, "left_semi")
        touched = hit.select(F.col(self.key).alias("key")).distinct()
        name = uuid.uuid4().hex
        touched.write.parquet(f"{self.path}/touched/{name}")
        try:
            touched = self.spark.read.schema("key string").parquet(f"{self.path}/touched/{name}")
            concerns = old.join(touched, old["key"].eqNullSafe(touched["key"]), "left_semi")
            kept = old.join(touched, old["key"].eqNullSafe(touched["key"]), "left_anti")
            merged = upsert(self._rows(concerns, schema), stage, keys)
            return self._commit(before, kept.unionByName(self._marked(self._write(merged), self.marks(before))), schema)
        finally:
            delete_path(self.spark, f"{self.path}/touched/{name}")

    # -------------------------------------------------------------- vacuum

    def rollback(self, version: int) -> int:
        """Make an earlier version's rows those of a new one."""
        before, _ = self._entry(None)
        _, entry = self._entry(version)
        return self._publish(before, entry["manifest"], T.StructType.fromJson(entry["schema"]))

    def vacuum(self, keep: int = 1, orphan_hours: float = ORPHAN_HOURS) -> int:
        """Delete all versions but the last ``keep`` and the folders that only they hold; returns how many folders went.

        Readers of a deleted version fail.  Loads that were never committed go once they are ``orphan_hours`` old.
        """
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        if not kept:
            return 0
        live = reduce(DataFrame.unionByName, [self.manifest(v) for v in kept]).select("load", "key").distinct()
        removed = 0
        if old:
            past = reduce(DataFrame.unionByName, [self.manifest(v) for v in old]).select("load", "key").distinct()
            same = (past["load"] == live["load"]) & past["key"].eqNullSafe(live["key"])
            for row in past.join(live, same, "left_anti").toLocalIterator():
                removed += self._delete(f"{self.path}/data/{LOAD}={row['load']}/{self.key}={self._folder_of(row['key'])}")
        known = {r["load"] for r in live.select("load").distinct().toLocalIterator()}
        fs, data = _filesystem(self.spark, f"{self.path}/data")
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        for status in fs.listStatus(data) if fs.exists(data) else []:
            load = status.getPath().getName().removeprefix(f"{LOAD}=")
            empty = not any(s.isDirectory() for s in fs.listStatus(status.getPath()))
            if load not in known and (empty or now - status.getModificationTime() >= orphan_hours * 3_600_000):
                removed += self._delete(f"{self.path}/data/{LOAD}={load}")
        named = {self._entry(v)[1]["manifest"] for v in kept}
        for version in old:
            manifest = self._entry(version)[1]["manifest"]
            self._delete(f"{self.path}/versions/{version:08d}")
            if manifest not in named:
                self._delete(f"{self.path}/manifests/{manifest}")
        return removed

    def _folder_of(self, key: str | None) -> str:
        if key is None:
            return "__HIVE_DEFAULT_PARTITION__"
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(key)

    def _delete(self, path: str) -> int:
        fs, target = _filesystem(self.spark, path)
        return int(fs.exists(target) and fs.delete(target, True))
