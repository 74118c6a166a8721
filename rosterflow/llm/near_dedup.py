"""Near-duplicate documents by circulant MinHash.

Two permutations of the shingle universe give a whole signature: the first one
breaks its structure, the second one is shifted circularly by one place per
coordinate (C-MinHash, Li and Li 2022).  Bands of coordinates find candidates;
links are confirmed on the full shingle sets, and components are found by joins.
Documents with equal sets are one node from the start, so that a large group of
copies costs no candidate at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import WordHash, give_back, mix64, register, table
from rosterflow.llm.linking import Jaccard, among, components_sql, link
from rosterflow.session import scratch, settle

BANDS = 32
ROWS = 4
PERCENT = 80


def shingle_sets(texts: list[str | None], width: int, hashes: WordHash) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of every whole text, A-Z folded.

    A text with fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    out = []
    for text in texts:
        words = text.encode().lower().split() if text else []
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        w = hashes.of(words)
        n = min(width, len(w))
        value = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - n + 1 + i])
        out.append(np.unique(value))
    return out


def circulant_signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` minima per non-empty set."""
    # The first permutation: hashes are mixed already, their upper half is a place in a universe of 2**32.
    place = np.concatenate([(s >> np.uint64(32)).astype(np.uint32) for s in sets])
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        # The second permutation, at places shifted around the universe by k.
        x = place - np.uint32(k)
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per band, different from band to band."""
    rows = signatures.shape[1] // bands
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(signatures), axis=0)
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    for r in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys.view(np.int64)


def signed(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """``key, n_shingles, set_digest, keys``: digest and band keys are null for empty sets."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                sets = shingle_sets(batch.column(1).to_pylist(), width, hashes)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(circulant_signatures(full, bands * rows), bands) if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    [key, "n_shingles", "set_digest", "keys"],
                )
        hashes.clear()
        give_back()

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_shingles long, set_digest binary, keys array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``id, items`` of the documents in ``ids``: their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                sets = shingle_sets(batch.column(1).to_pylist(), width, hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "items"]
                )
        hashes.clear()
        give_back()

    wanted = among(docs.select(F.col(key).cast("long").alias("id"), text), ids)
    return wanted.mapInArrow(run, "id long, items array<long>").where(F.size("items") > 0)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    Documents are linked where the Jaccard similarity of their ``width``-word
    shingle sets is at least ``percent`` hundredths; ``component_id`` is the
    smallest key reachable and one document of each component is kept.  A pair at
    the threshold is missed by all bands with probability ``(1 - 0.8**4)**32``,
    about 5e-8.  Null or blank texts link with nothing.  Rows that share a key are
    one node in links; each row shows its own set's component.  A null key links
    with nothing and is kept.  Keys are whole numbers.
    """
    with scratch():
        marks = settle(signed(docs, key, text, width, bands, rows), "signatures", outlives=True)
        nodes = marks.where(F.col(key).isNotNull() & F.col("set_digest").isNotNull())
        equal = nodes.groupBy("set_digest").agg(F.min(key).alias("first"), F.count("*").alias("copies"))
        equal = settle(equal, "equal-sets", outlives=True)
        first = nodes.join(equal.select(F.col("first").alias(key), "set_digest"), [key, "set_digest"], "left_semi")
        buckets = first.select(F.explode("keys").alias("bucket"), F.col(key).cast("long").alias("id")).distinct()
        linked = link(buckets, lambda ids: full_sets(docs, ids, key, text, width), Jaccard(percent))
        groups = equal.join(linked, F.col("first") == F.col("id"), "left").where("copies > 1 or component is not null")
        groups = settle(groups.select("set_digest", F.coalesce("component", "first").alias("_component")), "groups", outlives=True)
        found = marks.join(groups, "set_digest", "left")
    component = F.when(F.col(key).isNotNull(), F.coalesce("_component", key))
    return found.select(
        key, "n_shingles", component.cast(docs.schema[key].dataType).alias("component_id"),
        F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )


@register("op9_minhash", components_sql(2, PERCENT, "doc_id, n_shingles, component_id, doc_id = component_id AS kept"))
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
