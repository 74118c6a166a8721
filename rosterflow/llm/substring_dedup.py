"""Removal of word windows that a document with a smaller id holds as well.

A count-min sketch says which windows may be repeated, and only those are
grouped exactly:

1. Documents are dealt into chunks.  Each chunk makes its partition sketch, the
   count-min cells its windows fall into (sorted and packed, as almost all cells
   of a partition are empty).
2. The sketch is merged slice by slice: a task adds the cells of all chunks for
   one range of one sketch row and answers every chunk, one bit per cell, whether
   the merged count is at least two.  The merged sketch is as wide as the corpus
   asks for, yet no task holds more than a slice and nothing is broadcast.
3. A window whose cells all count two or more is *estimated repeated*.  Counts are
   only ever over-estimated, so no repeated window is missed.  Their 128-bit
   digests are grouped exactly, each chunk sending a window once with its smallest
   id, so that a window of every document costs an entry per chunk.
4. One bit per entry comes back (a smaller id holds it), and the words under such
   windows are dropped.

Chunks are dealt by hash in each of three passes over the text; the shuffle of
a pass is dropped when its small result is written.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import WordHash, mix64, parts_for, register, table, text_bytes
from rosterflow.session import scratch, settle

WINDOW = 13
DEPTH = 2
CHUNK_BYTES = 8 << 20
SLICE_CELLS = 1 << 25
SLICE_ENTRIES = 1 << 22
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Layout:
    """Sizes that follow the corpus: sketch width, its slices, and the slices of the exact grouping."""

    window: int
    bits: int
    slice_bits: int
    exact_bits: int

    @classmethod
    def of(cls, total_bytes: int, window: int) -> Layout:
        expected = max(1, total_bytes // 6)
        bits = max(16, (4 * expected - 1).bit_length())
        slice_bits = min(SLICE_CELLS.bit_length() - 1, bits - 4)
        return cls(window, bits, slice_bits, max(4, (expected // SLICE_ENTRIES).bit_length()))


def pack(values: np.ndarray) -> bytes:
    """Ascending numbers below 2**32 as differences, byte plane by byte plane, compressed."""
    import zstandard

    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


class Chunk:
    """The windows of some documents: distinct ones in the order of their first hash."""

    def __init__(self, docs: pa.Table, window: int):
        self.ids = np.array([NO_ID if i is None else i for i in docs.column("id").to_pylist()], np.int64)
        self.words = [t.encode().split() if t else [] for t in docs.column("text").to_pylist()]
        self.window = window
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        hashes = WordHash()
        flat = hashes.of([w for row in self.words for w in row])
        doc = np.repeat(np.arange(len(self.words)), lengths)
        n = max(0, len(flat) - window + 1)
        # Windows inside one document only.
        inside = np.flatnonzero(doc[:n] == doc[window - 1:]) if n else np.zeros(0, np.int64)
        first, second = self._rolling(flat, n), self._rolling(mix64(flat ^ np.uint64(0x5851F42D4C957F2D)), n)
        first, second, doc = mix64(first[inside]), mix64(second[inside]), doc[inside]
        order = np.argsort(first)
        self.place, self.doc = inside[order], doc[order]
        first, second = first[order], second[order]
        fresh = np.ones(len(first), bool)
        fresh[1:] = first[1:] != first[:-1]
        starts = np.flatnonzero(fresh)
        self.first, self.second = first[starts], second[starts]
        self.of_window = np.cumsum(fresh) - 1
        ids = self.ids[self.doc]
        self.least = np.minimum.reduceat(ids, starts) if len(starts) else np.zeros(0, np.int64)
        self.many = (np.maximum.reduceat(ids, starts) if len(starts) else self.least) != self.least
        self.starts_of_docs = np.cumsum(lengths) - lengths

    def _rolling(self, flat: np.ndarray, n: int) -> np.ndarray:
        value = np.zeros(n, np.uint64)
        for j in range(self.window):
            value = value * np.uint64(0x9E3779B97F4A7C15) + flat[j:j + n]
        return value

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct cells of a sketch row, which of them count two already, and each window's index among them."""
        cell = (self.first if row == 0 else self.second if row == 1 else mix64(self.second + np.uint64(row))) >> np.uint64(64 - bits)
        order = np.arange(len(cell)) if row == 0 else np.argsort(cell)
        cell = cell[order]
        fresh = np.ones(len(cell), bool)
        fresh[1:] = cell[1:] != cell[:-1]
        starts = np.flatnonzero(fresh)
        index = np.empty(len(cell), np.int64)
        index[order] = np.cumsum(fresh) - 1
        if not len(starts):
            return cell, np.zeros(0, bool), index
        two = (np.diff(starts, append=len(cell)) > 1) | np.logical_or.reduceat(self.many[order], starts)
        return cell[starts], two, index


def _edges(values: np.ndarray, shift: int) -> list[tuple[int, int, int]]:
    """Ranges of ascending ``values`` with a common prefix: prefix, start, end."""
    prefix = values >> np.uint64(shift)
    cuts = np.flatnonzero(np.diff(prefix)) + 1
    bounds = [0, *cuts.tolist(), len(values)]
    return [(int(prefix[a]), a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


_ASK = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("slice", pa.int64()), ("n", pa.int64()), ("blob", pa.binary()), ("flags", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("slice", pa.int64()), ("n", pa.int64()), ("flags", pa.binary())])
_ASK_SQL = "chunk long, row int, slice long, n long, blob binary, flags binary"
_ANSWER_SQL = "chunk long, row int, slice long, n long, flags binary"
# Rows of the sketch are numbered from 0; these are the windows estimated repeated and the exact answers.
_ESTIMATED, _EXACT = -1, -2


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _sketch(docs: pa.Table, layout: Layout) -> pa.Table:
    chunk, out = Chunk(docs, layout.window), []
    number = docs.column("chunk")[0].as_py()
    for row in range(DEPTH):
        cells, two, _ = chunk.cells(row, layout.bits)
        for part, a, b in _edges(cells, layout.slice_bits):
            local = cells[a:b] & np.uint64((1 << layout.slice_bits) - 1)
            out.append((number, row, part, b - a, pack(local), _bits(two[a:b])))
    return _table(out, _ASK)


def _merge(asks: pa.Table, layout: Layout) -> pa.Table:
    """One slice of one sketch row: counts of all chunks are added (two is as good as more), then every chunk is answered."""
    count = np.zeros(1 << layout.slice_bits, np.uint8)
    rows = asks.select(["chunk", "row", "slice", "n", "blob", "flags"]).to_pylist()
    for ask in rows:
        cells = unpack(ask["blob"])
        count[cells] = np.minimum(2, count[cells] + 1 + _flags(ask["flags"], ask["n"]))
    return _table([(r["chunk"], r["row"], r["slice"], r["n"], _bits(count[unpack(r["blob"])] >= 2)) for r in rows], _ANSWER)


def _answers(table_: pa.Table, row: int) -> np.ndarray:
    rows = sorted((r for r in table_.to_pylist() if r["row"] == row), key=lambda r: r["slice"])
    return np.concatenate([_flags(r["flags"], r["n"]) for r in rows]) if rows else np.zeros(0, bool)


def _candidates(docs: pa.Table, answers: pa.Table, layout: Layout) -> pa.Table:
    if not docs.num_rows:
        return _table([], _ASK)
    chunk = Chunk(docs, layout.window)
    number = docs.column("chunk")[0].as_py()
    estimated = np.ones(len(chunk.first), bool)
    for row in range(DEPTH):
        index = chunk.cells(row, layout.bits)[2]
        estimated &= _answers(answers, row)[index] if len(index) else True
    out = [(number, _ESTIMATED, 0, len(estimated), None, _bits(estimated))]
    first, second, least = chunk.first[estimated], chunk.second[estimated], chunk.least[estimated]
    for part, a, b in _edges(first, 64 - layout.exact_bits):
        out.append((number, _EXACT, part, b - a, first[a:b].tobytes() + second[a:b].tobytes(), least[a:b].tobytes()))
    return _table(out, _ASK)


def _group(asks: pa.Table) -> pa.Table:
    """Exact grouping of one range of digests: does another chunk hold the window with a smaller id?"""
    rows = asks.select(["chunk", "slice", "n", "blob", "flags"]).to_pylist()
    n = np.array([r["n"] for r in rows])
    digests = [np.frombuffer(r["blob"], np.uint64).reshape(2, -1) for r in rows]
    first, second = np.concatenate([d[0] for d in digests]), np.concatenate([d[1] for d in digests])
    least = np.concatenate([np.frombuffer(r["flags"], np.int64) for r in rows])
    order = np.lexsort((second, first))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    smallest = np.minimum.reduceat(least[order], np.flatnonzero(fresh))
    smaller = np.empty(len(order), bool)
    smaller[order] = smallest[np.cumsum(fresh) - 1] < least[order]
    ends = np.cumsum(n)
    return _table([(r["chunk"], _EXACT, r["slice"], r["n"], _bits(smaller[e - r["n"]:e])) for r, e in zip(rows, ends)], _ANSWER)


def _removed(chunk: Chunk, answers: pa.Table) -> np.ndarray:
    """Which words (all documents of the chunk in a row) lie under a window that a smaller id holds."""
    total = sum(map(len, chunk.words))
    elsewhere = np.zeros(len(chunk.first), bool)
    estimated = _answers(answers, _ESTIMATED)
    if len(estimated):
        elsewhere[estimated] = _answers(answers, _EXACT)
    gone = elsewhere[chunk.of_window] | (chunk.ids[chunk.doc] > chunk.least[chunk.of_window])
    depth = np.zeros(total + 1, np.int32)
    np.add.at(depth, chunk.place[gone], 1)
    np.add.at(depth, chunk.place[gone] + chunk.window, -1)
    return np.cumsum(depth[:-1]) > 0


def remove_repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, keep_text: bool = False
) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` and, with ``keep_text``, ``kept_text`` of every row.

    Words are maximal runs of characters other than space and U+0009 to U+000D.  A
    word goes if one of its windows starts in a document with a smaller key as
    well, judged on the texts as they come.  Null texts have no words.  Rows with
    one key are no smaller than each other: a window they share stays in all of
    them; a null key is larger than every other.  Keys are whole numbers.
    """
    spark = docs.sparkSession
    size = text_bytes(docs, text)
    layout = Layout.of(size, window)
    chunks = parts_for(spark, size, CHUNK_BYTES)
    dealt = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    kind = docs.schema[key].dataType.simpleString()

    def sketch(group: pa.Table) -> pa.Table:
        return _sketch(group, layout)

    def merge(group: pa.Table) -> pa.Table:
        return _merge(group, layout)

    def candidates(group: pa.Table, answers: pa.Table) -> pa.Table:
        return _candidates(group, answers, layout)

    def exact(group: pa.Table) -> pa.Table:
        return _group(group)

    fields = "id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")

    def finish(group: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * keep_text
        if not group.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        chunk = Chunk(group, layout.window)
        gone = _removed(chunk, answers)
        n, removed, kept = [], [], []
        for start, words in zip(chunk.starts_of_docs.tolist(), chunk.words):
            mine = gone[start:start + len(words)]
            lost = int(mine.sum())
            n.append(len(words))
            removed.append(lost)
            kept.append(b" ".join(words if not lost else [words[i] for i in np.flatnonzero(~mine).tolist()]))
        out = [group.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
        return pa.table(out + [pa.array([k.decode() for k in kept], pa.string())] * keep_text, names)

    by_chunk = dealt.groupBy("chunk")
    with scratch():
        asks = by_chunk.applyInArrow(sketch, _ASK_SQL)
        answers = settle(asks.groupBy("row", "slice").applyInArrow(merge, _ANSWER_SQL), "sketch-answers")
        asks = settle(by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(candidates, _ASK_SQL), "candidates")
        estimated = asks.where(F.col("row") == _ESTIMATED).drop("blob")
        exact_answers = asks.where(F.col("row") == _EXACT).groupBy("slice").applyInArrow(exact, _ANSWER_SQL)
        answers = settle(estimated.unionByName(exact_answers), "exact-answers", outlives=True)
    found = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(finish, fields)
    return found.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", key)


@register("op1_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
             unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s FROM d WHERE len(w) >= 13),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM m WHERE least < doc_id),
r AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words removed from every document where a smaller id holds them."""
    return remove_repeated_windows(table(spark, sf_dir, "documents"))
