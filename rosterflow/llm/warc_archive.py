"""WARC archives of single-frame Zstandard records with an embedded dictionary.

Each task collects the records of one archive, builds a dictionary from them,
and writes a file that starts with a skippable frame holding that dictionary;
every record follows as a frame of its own, so that one record can be read by
its offset.  Reading streams over the frames with the embedded dictionary.

Records of equal payload are written once: the one with the smallest key is a
``response``, the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import register, table
from rosterflow.session import fresh_path, scratch, settle
from rosterflow.sinks.history import path_exists

# Fixed values of the formats.
SKIPPABLE_DICTIONARY = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:record:"
EPOCH = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20


def _uri(text: str) -> str:
    """A header value may hold no line break or other control character."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record_bytes(key: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One WARC/1.1 record; with ``first`` it is a revisit that carries the HTTP header alone."""
    name = f"<{RECORD_ID}{'' if key is None else key}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url) if url else name[1:-1]}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if first is not None:
        lines[5:5] = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{first}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_bytes(name: str, date: str) -> bytes:
    block = b"software: rosterflow\r\nformat: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:{name}>\r\nWARC-Date: {date}\r\n"
        f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes], name: str, date: str = EPOCH, dictionary_bytes: int = DICTIONARY_BYTES):
    """The file of ``records`` and each record's offset and length in it.

    The dictionary is built from records spread evenly over the archive, at most
    ``SAMPLE_BYTES`` of them; it only serves compression.  Archives too small for
    one are written without, and then have no leading skippable frame.
    """
    import zstandard

    size = sum(map(len, records))
    step = max(1, size // SAMPLE_BYTES)
    samples = [r[:65536] for r in records[::step]]
    dictionary = None
    if len(samples) >= 8 and sum(map(len, samples)) >= 8 * 4096:
        try:
            dictionary = zstandard.train_dictionary(min(dictionary_bytes, sum(map(len, samples)) // 8), samples, k=200, d=8)
        except zstandard.ZstdError:  # records that share nothing
            dictionary = None
    press = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
    out = io.BytesIO()
    if dictionary is not None:
        raw = dictionary.as_bytes()
        out.write(struct.pack("<II", SKIPPABLE_DICTIONARY, len(raw)) + raw)
    out.write(press.compress(info_bytes(name, date)))
    places = []
    for record in records:
        frame = press.compress(record)
        places.append((out.tell(), len(frame)))
        out.write(frame)
    return out.getvalue(), places


def embedded_dictionary(data: bytes):
    """The decompressor of an archive and where its first frame of data starts."""
    import zstandard

    magic, length = struct.unpack_from("<II", data) if len(data) >= 8 else (0, 0)
    if magic != SKIPPABLE_DICTIONARY:
        return zstandard.ZstdDecompressor(), 0
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + length])), 8 + length


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive, streamed frame after frame."""
    press, start = embedded_dictionary(data)
    stream = io.BufferedReader(press.stream_reader(memoryview(data)[start:], read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield fields, block


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_first(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """Pages with ``_payload`` and ``_first``: the smallest key of their payload where another row holds it.

    Only digests met more than once are joined back; without ``least`` bytes a
    payload has no first.  A hot digest is aggregated before the shuffle, and the
    join splits it.
    """
    hashed = pages.withColumn("_payload", F.encode(F.coalesce(payload, F.lit("")), "UTF-8")).withColumn(
        "_sha1", F.unhex(F.sha1("_payload"))
    )
    firsts = (
        hashed.where(F.octet_length("_payload") >= least).groupBy("_sha1")
        .agg(F.min(key).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    )
    return hashed.join(settle(firsts, "payloads"), "_sha1", "left")


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    min_revisit_bytes: int = 0, archive_size: int = ARCHIVE_BYTES, date: str = EPOCH,
) -> DataFrame:
    """Write every row as a record below ``folder``; one row per record: ``archive, offset, length, key``.

    Null payloads count as empty, null addresses become the record's own name.
    Repeated rows are written each; rows that repeat the smallest key of a payload
    are responses all.  A null key is never the smallest one unless all are null.
    A task holds one archive at a time; a file gets its final name only when
    complete, so a repeated task replaces it.  Without rows nothing is written.  A
    payload of any length is one record, held whole by a task (Arrow's limit of 2 GB
    a value holds).  Files go through Arrow's own file systems, which need their own
    credentials for a remote store.  Other columns play no part.
    """
    kind = pages.schema[key].dataType
    # Only these three play a part: other columns may have any names.
    pages = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[object, bytes]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            name = f"part-{part:06d}-{number:05d}.warc.zst"
            data, places = archive_bytes([r for _, r in held], name, date)
            store.create_dir(root, recursive=True)
            hidden = f"{root}/.{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out:
                out.write(data)
            store.move(hidden, f"{root}/{name}")
            number += 1
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(held)), pa.array([p[0] for p in places], pa.int64()),
                    pa.array([p[1] for p in places], pa.int64()), pa.array([k for k, _ in held], pa.from_numpy_dtype("int64")),
                ],
                ["archive", "offset", "length", "key"],
            )
            held.clear()
            return rows

        size = 0
        for batch in batches:
            for k, address, body, first in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = first is not None and k != first
                held.append((k, record_bytes(k, address, body, base32_sha1(body), first if revisit else None, date)))
                size += len(held[-1][1])
                if size >= archive_size:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    ready = with_first(pages, "key", "payload", min_revisit_bytes).select(
        F.col("key").cast("long").alias("key"), "url", "_payload", F.col("_first").cast("long").alias("_first")
    )
    written = ready.mapInArrow(run, "archive string, offset long, length long, key long")
    return written.select("archive", "offset", "length", F.col("key").cast(kind).alias(key))


def read_archives(spark: SparkSession, folder: str, key: str = "page_id", keep_payload: bool = False) -> DataFrame:
    """One row per record of every archive below ``folder``.

    ``key, payload_bytes, payload_digest, record_type, refers_to`` and, with
    ``keep_payload``, ``url`` and ``payload`` (null for a revisit).  The digest of a
    response is computed from what was read and must equal the stated one.  A folder
    without archives, or none at all, has no rows.
    """
    fields = "key long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if keep_payload:
        fields += ", url string, payload binary"

    def number(value: str) -> int | None:
        text = value.removeprefix(f"<{RECORD_ID}").removesuffix(">")
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64())] + [("url", pa.string()), ("payload", pa.binary())] * keep_payload
        )
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for head, block in read_records(data.as_buffer()):
                    kind = head["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response":
                        size = len(payload)
                        if base32_sha1(payload) != digest:
                            raise ValueError(f"record {head['warc-record-id']} does not match its digest")
                    else:
                        size = int(http.rpartition(b"Content-Length:")[2])
                    row = [number(head["warc-record-id"]), size, digest, kind, number(head["warc-refers-to"]) if kind == "revisit" else None]
                    rows.append(row + [head["warc-target-uri"], payload if kind == "response" else None] * keep_payload)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    if not path_exists(spark, folder):
        return spark.createDataFrame([], fields).withColumnRenamed("key", key)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(run, fields).withColumnRenamed("key", key)


# Base 32 of 40 hexadecimal digits: eight groups of five bytes are not aligned to digits, 10 digits give 8 letters.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(d, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::INT, 1)), '')"""


@register("op8_warc", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
SELECT page_id, octet_length(encode(h)) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (d)""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, which are then read back."""
    folder = fresh_path(spark, "warc")
    with scratch():
        settle(write_archives(table(spark, sf_dir, "pages"), folder), "index")
    return read_archives(spark, folder)
