"""SentencePiece encoding and decoding by a table of distinct chunks.

In a vocabulary whose pieces never hold a whitespace marker after another
character, no merge can cross the place where a marker follows a
non-marker.  A text therefore falls into *chunks* (a run of markers and the
characters up to the next run) that the library segments independently.  Each
task keeps a table of distinct chunks: a chunk is segmented once, and ids are
joined back by position with array gathers.  The table is per task and bounded:
one for the whole corpus would have to shuffle every word occurrence (about
seven times the input), while words are Zipf-distributed and a task's table
already answers most of them.

A vocabulary with a piece across a marker is detected when the model is
loaded; its texts are then encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rosterflow.llm.common import give_back, register, table

MARKER = "▁"
MAX_MODEL_BYTES = 64 << 20


class ChunkTable:
    """Segments texts through a table of distinct chunks; at most ``limit`` chunks are remembered."""

    def __init__(self, model: bytes, begin: bool = True, end: bool = True, limit: int = 500_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.vocab_size()
        inside = re.compile(f"[^{MARKER}]{MARKER}")
        self.separable = not any(inside.search(self.library.id_to_piece(i)) for i in range(size))
        # Chunks are handed over without their first marker, which the library must put back and leave otherwise alone.
        self.separable = self.separable and all(
            self.library.decode(self.library.encode(t)) == t for t in ("a", " a", "a  b", "a\nb ", "ﬁ　①")
        ) and self.library.id_to_piece(self.library.encode("a")[0]).startswith(MARKER)
        self.begin = [self.library.bos_id()] if begin else []
        self.end = [self.library.eos_id()] if end else []
        self.limit = limit
        self.split = re.compile(" +[^ ]*").findall
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        # A chunk that is one marker alone, at the end of a text, would be handed over as nothing.
        lone = [self.library.piece_to_id(MARKER)]
        found = [lone if c == " " else ids for c, ids in zip(chunks, self.library.encode([c[1:] for c in chunks], num_threads=1))]
        length = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(length.sum()))
        self.row.update(zip(chunks, range(len(self.row), len(self.row) + len(chunks))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, begin and end ids included."""
        if not self.separable:
            return [np.array(self.begin + ids + self.end, np.uint32) for ids in self.library.encode(texts, num_threads=1)]
        # The library adds one marker in front of a text that is not empty.
        chunks = [self.split(" " + t.replace(MARKER, " ")) if t else [] for t in texts]
        if len(self.row) > self.limit:
            self._clear()
        new = list(dict.fromkeys(c for row in chunks for c in row if c not in self.row))
        if new:
            self._learn(new)
        out = []
        for row in chunks:
            at = np.fromiter(map(self.row.__getitem__, row), np.int64, len(row))
            length = self.length[at]
            ends = np.cumsum(length)
            total = int(ends[-1]) if len(row) else 0
            place = np.repeat(self.start[at] - (ends - length), length) + np.arange(total)
            out.append(np.concatenate([np.array(self.begin, np.uint32), self.ids[place], np.array(self.end, np.uint32)]))
        return out

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        return self.library.decode([r.tolist() for r in rows], num_threads=1)


def _slices(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold about ``most`` characters, so that memory follows neither batch size nor row count."""
    first = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: a model of more than {MAX_MODEL_BYTES} bytes is not shipped to every task")
    return model


def codec(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", begin: bool = True, end: bool = True,
    keep_ids: bool = False,
) -> DataFrame:
    """Ids and decoded text of every row: ``key, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``, ``ids, decoded``.

    The model file is read on the driver and travels with the job (its size is
    checked).  Null texts count as empty: begin and end ids only, decoded to the
    empty text.  Rows are independent, so repeated rows, null keys and ties give a
    row each; other columns are not read.  No shuffle.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model_bytes(model_path))
    fields = f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(shipped.value, begin, end)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _slices(texts):
                rows = chunks.encode(texts[lo:hi])
                decoded = chunks.decode(rows)
                out = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                ]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out += [pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)
                del rows, decoded, out
        # The worker lives on: neither the table nor what the slices took may stay with it.
        chunks = texts = batch = None
        give_back()

    return docs.select(key, text).mapInArrow(run, fields)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded by the distinct-chunk table."""
    return codec(table(spark, sf_dir, "documents"), default_model())
