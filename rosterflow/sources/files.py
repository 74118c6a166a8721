"""Folder listings as DataFrames (file bytes are never read: the scan prunes them)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.periods import extension


def list_files(spark: SparkSession, folder: str, extensions: Iterable[str] = (), *, recursive: bool = False) -> DataFrame:
    """``path, modificationTime, length`` of the files with one of ``extensions`` (any case, dot optional)."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    wanted = [e.lower() if e.startswith(".") or not e else f".{e.lower()}" for e in extensions]
    return found.where(F.lower(extension(F.col("path"))).isin(*wanted)) if wanted else found


def latest_file(spark: SparkSession, folder: str, extensions: Iterable[str], *, recursive: bool = False) -> str:
    """Path of the newest such file; an error when there is none."""
    newest = list_files(spark, folder, extensions, recursive=recursive).agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    ).first()
    if newest["path"] is None:
        raise FileNotFoundError(f"no file with {sorted(extensions)} in {folder}")
    return newest["path"]
