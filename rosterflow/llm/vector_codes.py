"""Vector codes: a codebook per part of the vectors, learnt by active-entry Lloyd rounds.

A row keeps the entry of each of its parts and the exact squared distance to
it.  In the next round a part whose entry has not moved is nearer to it than to
any other that has not moved either, so it is compared with the moved entries
only; a part whose entry has moved is compared with all.  Everything is done on
whole numbers, so the codes are those of full comparison, ties included.

A round is one pass over the rows: each task writes its rows with their new
entries and, last, the sums of its parts by entry.  Only those sums meet, by
part, entry and component; the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import register, squeeze, table, unsqueeze
from rosterflow.session import delete_path, fresh_path, scratch, settle

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Distances are whole numbers of 64 bits; with 53 bits they may be found by floating-point products.
EXACT_BITS, DOUBLE_BITS = 62, 53


@dataclass
class Codebooks:
    """``entries[part]``: one row of whole numbers per entry; ``moved[part]``: which rows the last round has changed (None: none known)."""

    entries: list[np.ndarray]
    moved: list[np.ndarray] | None = None

    def text(self) -> str:
        return ",".join(str(x) for part in self.entries for x in part.ravel().tolist())

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The whole-number vectors that rows of entry indexes stand for."""
        return np.concatenate([part[codes[:, p]] for p, part in enumerate(self.entries)], axis=1)


def usable(vector: str) -> Column:
    """Neither null nor with a component that is null, infinite or not a number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int, width: int) -> np.ndarray:
    """``floor(scale * x)``; an error where distances over ``width`` components would leave 64 bits."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size and 2 * np.log2(2 * np.abs(scaled).max() + 2) + np.log2(max(width, 1)) > EXACT_BITS:
        raise ValueError("components are too large for exact distances of 64 bits")
    return scaled.astype(np.int64)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All exact distances between rows of ``x`` and ``entries``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0))) + 1
    if (4 * most * most * max(x.shape[1], 1)).bit_length() <= DOUBLE_BITS:
        # Sums of whole numbers below 2**53 are exact in any order.
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        out[:, j] = ((x - entry) ** 2).sum(1)
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower one on a tie, and its distance."""
    all_ = squared_distances(x, entries)
    code = all_.argmin(1)
    return code, all_[np.arange(len(x)), code]


def reassign(x: np.ndarray, code: np.ndarray, distance: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same as :func:`nearest`, from the last codes and distances and the entries that have moved since."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = nearest(x[lost], entries)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(fixed):
        at, far = nearest(x[fixed], entries[active])
        at = active[at]
        better = (far < distance[fixed]) | ((far == distance[fixed]) & (at < code[fixed]))
        code[fixed[better]], distance[fixed[better]] = at[better], far[better]
    return code, distance


def _first_entries(rows: DataFrame, dimension: int, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the rows with the smallest keys; rows of one key by their vector.  Null keys come last."""
    first = rows.orderBy(F.col("key").asc_nulls_last(), F.col("vector")).select("vector").limit(entries).collect()
    values = np.array([r[0] for r in first], np.float64).reshape(len(first), dimension)
    numbers = whole_numbers(values, scale, dimension // parts)
    return Codebooks([np.ascontiguousarray(x) for x in np.split(numbers, parts, axis=1)])


def _vectors(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, dimension)


def _assign(rows: DataFrame, books: Codebooks, dimension: int, scale: int, keep_vectors: bool) -> DataFrame:
    """Rows with their codes and distances and, after the last row of a task, its sums (the other columns null)."""
    parts = len(books.entries)
    width = dimension // parts
    fields = [(f.name, f.dataType.simpleString()) for f in rows.select("key", "label", *(["vector"] if keep_vectors else [])).schema]
    output = ", ".join(f"`{n}` {k}" for n, k in fields) + ", codes binary, distances array<long>, counts binary, sums binary"
    names = [n for n, _ in fields] + ["codes", "distances", "counts", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(e), width), np.int64) for e in books.entries]
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        kinds, step = None, max(1, (1 << 20) // max(dimension, ENTRIES))
        for whole in batches:
            kinds = [whole.schema.field(n).type for n, _ in fields]
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                n = batch.num_rows
                numbers = whole_numbers(_vectors(batch, dimension), scale, width)
                known = books.moved is not None and "codes" in batch.schema.names
                if known:
                    old = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    far = np.asarray(batch.column("distances").flatten()).reshape(n, parts)
                codes, distances = np.empty((n, parts), np.uint8), np.empty((n, parts), np.int64)
                for p, entries in enumerate(books.entries):
                    x = numbers[:, p * width:(p + 1) * width]
                    code, distance = reassign(x, old[:, p], far[:, p], entries, books.moved[p]) if known else nearest(x, entries)
                    codes[:, p], distances[:, p] = code, distance
                    order = np.argsort(code, kind="stable")
                    used, first = np.unique(code[order], return_index=True)
                    if width:
                        sums[p][used] += np.add.reduceat(x[order], first, axis=0)
                    counts[p] += np.bincount(code, minlength=len(entries))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c, _ in fields]
                    + [
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts), pa.int32()), pa.array(distances.ravel())),
                        pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                    ],
                    names,
                )
        if kinds is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, k) for k in kinds]
                + [
                    pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int64())), pa.array([squeeze(np.concatenate(counts))], pa.binary()),
                    pa.array([squeeze(np.concatenate([s.ravel() for s in sums]))], pa.binary()),
                ],
                names,
            )

    return rows.mapInArrow(run, output)


def _moved_books(state: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: each entry the floor of its parts' mean; unused ones stay."""
    shapes = [e.shape for e in books.entries]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, total = unsqueeze(counts, np.int64), unsqueeze(sums, np.int64)
                per = np.repeat(n, np.repeat([w for _, w in shapes], [k for k, _ in shapes]))
                at = np.flatnonzero(per)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(per[at]), pa.array(total[at])], ["at", "n", "total"])

    sent = state.where("sums is not null").select("counts", "sums").mapInArrow(spread, "at long, n long, total long")
    # As many rows as the codebooks have components.
    rows = sent.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    flat = np.concatenate([e.ravel() for e in books.entries])
    for r in rows:
        flat[r["at"]] = r["total"] // r["n"]
    after, start = [], 0
    for entries in books.entries:
        after.append(flat[start:start + entries.size].reshape(entries.shape))
        start += entries.size
    return Codebooks(after, [(a != b).any(1) for a, b in zip(after, books.entries)])


def learn_codes(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``key, label, codes (array of int), error`` per usable row, and the final codebooks.

    Components become ``floor(scale * x)``; a vector is cut into ``parts`` equal
    pieces.  A part's codebook starts as that piece of the ``entries`` (at most 256)
    smallest keys, ascending; each of ``rounds`` rounds gives every piece its nearest
    entry, the lower index on a tie, and then makes each used entry the floor of its
    pieces' mean.  After the last round pieces get their nearest entry once more;
    ``error`` is the sum of their squared distances.

    Rows whose vector is null or has a null or non-finite component are dropped, and
    so are vectors of another length than most have (of the longer one on a tie).
    Repeated rows each count.  Rows of one key start by their vector; a null key comes
    last.  Other columns play no part.  A length that ``parts`` does not divide is an
    error, as are components beyond some 2**29 / scale, whose distances no longer fit 64 bits.
    Without a usable row there are no rows, and codebooks without entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: at most 256 entries")
    spark = rows.sparkSession
    kept = rows.where(usable(vector)).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    common = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimension = common["n"] if common else 0
    if dimension % parts:
        raise ValueError(f"{dimension} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("vector") == dimension)
    books = _first_entries(kept, dimension, parts, entries, scale)
    if not len(books.entries[0]):
        kind = rows.schema[key].dataType.simpleString(), rows.schema[label].dataType.simpleString()
        return spark.createDataFrame([], f"`key` {kind[0]}, `label` {kind[1]}, codes array<int>, error long").toDF(key, label, "codes", "error"), books
    state, before = kept, None
    for turn in range(rounds + 1):
        last = turn == rounds
        path = fresh_path(spark, "codes")
        found = _assign(state, books, dimension, scale, keep_vectors=not last)
        found.write.parquet(path)
        written = spark.read.schema(found.schema).parquet(path)
        if before:
            delete_path(spark, before)
        if not last:
            books = _moved_books(written, books)
        state, before = written.where("sums is null"), path
    codes = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.conv(F.hex(F.substring("codes", 1, parts)).substr(2 * p + 1, F.lit(2)), 16, 10).cast("int"))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda x, y: x + y)
    return state.select(F.col("key").alias(key), F.col("label").alias(label), codes.alias("codes"), error.alias("error")), books


def code_text(codes: str) -> Column:
    """Two lower-case hex digits per index."""
    return F.concat_ws("", F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))


def _sql() -> str:
    steps = ["""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, p, e[p * (len(e) // 4) + 1:(p + 1) * (len(e) // 4)] AS e FROM v, range(4) r(p)),
b0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS j, e FROM x WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256))"""]
    for k in range(ROUNDS + 1):
        # Distance and index in one number: the smallest is the nearest entry, the lower index on a tie.
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, label, x.p, x.e, min(256 * (list_inner_product(x.e::DOUBLE[], x.e::DOUBLE[]) + list_inner_product(b.e::DOUBLE[], b.e::DOUBLE[])
  - 2 * list_inner_product(x.e::DOUBLE[], b.e::DOUBLE[]))::BIGINT + j) AS m FROM x JOIN b{k} b ON b.p = x.p GROUP BY ALL)""")
        if k < ROUNDS:
            steps.append(f"""s{k} AS (SELECT p, m % 256 AS j, i, sum(e[i])::BIGINT AS s, count(*) AS c FROM a{k}, range(1, 1 + (SELECT max(len(e)) FROM x)) r(i) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.j, coalesce(n.e, b.e) AS e FROM b{k} b LEFT JOIN (
  SELECT p, j, list((s - ((s % c) + c) % c) // c ORDER BY i) AS e FROM s{k} GROUP BY p, j) n ON n.p = b.p AND n.j = b.j)""")
    last = ROUNDS
    return f"""WITH {', '.join(steps)},
d AS (SELECT vec_id, label, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error FROM a{last} GROUP BY ALL),
h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM d CROSS JOIN h"""


@register("op13_vector_codes", _sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's code of four bytes, its error, and the error of its label."""
    with scratch():
        coded, books = learn_codes(table(spark, sf_dir, "embeddings"))
        coded = settle(coded.select("vec_id", "label", code_text("codes").alias("code"), "error"), "coded", outlives=True)
        labels = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors", outlives=True)
    sealed = hashlib.sha256(books.text().encode()).hexdigest()
    same = coded["label"].eqNullSafe(labels["label"])
    return coded.join(labels, same).select("vec_id", "code", "error", "label_error", F.lit(sealed).alias("codebooks_sha256"))
