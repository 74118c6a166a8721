"""What several text operators share: words, digests and registration of their queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Word separators: space and U+0009 to U+000D.  bytes.split() without argument splits at exactly these.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def register(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows where there is one."""

    def put(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: what partition counts and sketch widths are derived from."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(spark: SparkSession, amount: int, per_part: int) -> int:
    """Number of groups so that each holds about ``per_part`` and every shuffle partition gets some."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), amount // per_part + 1)


def fold_held_out(key: str, modulus: int, fold: int = 2) -> Column:
    """True for rows whose crc32 of the key's text falls in the held-out fold; a null key is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == fold, F.lit(False))


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z only (bytes.lower touches nothing else)."""
    return text.lower()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """64-bit hashes of words, remembered up to ``limit`` words so that memory stays bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        value = xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def byte_slices(batch, column: int, most: int = 4 << 20):
    """A record batch in pieces of about ``most`` bytes of text, so that memory does not follow the batch size."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers of one width, byte plane by byte plane, compressed."""
    import zstandard

    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(blob: bytes, kind) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def rows_table(rows: list[tuple], schema):
    """A table of row tuples, empty ones included."""
    import pyarrow as pa

    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def prefix_ranges(values: np.ndarray, shift: int) -> list[tuple[int, int, int]]:
    """Ranges of ascending 64-bit ``values`` with a common prefix: prefix, start, end."""
    cuts = np.flatnonzero(np.diff(values >> np.uint64(shift))) + 1
    bounds = [0, *cuts.tolist(), len(values)]
    return [(int(values[a] >> np.uint64(shift)), a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def pack_batch(batch) -> bytes:
    """A record batch as compressed bytes."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(blob: bytes):
    import pyarrow as pa

    with pa.ipc.open_stream(blob) as source:
        return source.read_all()


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks and share a machine's memory with others."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
