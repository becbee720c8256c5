"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A record file is a run of frames, one for each document in ascending doc_id order:

    length   u64, of the payload in bytes
    check    u32, masked CRC-32C of the 8 length bytes
    payload  i64 doc_id, then the ids, as u16 where the vocabulary allows and as u32 else
    check    u32, masked CRC-32C of the payload

all little-endian; masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2^32. That is the framing of the
well-known record files of training frameworks, so their readers can read these. Beside each ``.rec`` file
an ``.idx`` file holds the byte offset of each frame as u64: a reader that wants records in shuffled order
seeks to them (``read_record``) instead of reading the file through.

Files are written under names of their own attempt; only those that the manifest (a Parquet table, written
by Spark when a task succeeds) names count. What a lost executor or a second attempt left is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirewire.llm.common import joined, qualified, small_batches
from hirewire.llm.tokens import SLICE_BYTES, library_encoder

NO_ID = -(1 << 63)  # stands in a payload for a null doc_id
BLOCK = 2048  # bytes that one table lookup of the checksum covers
ROWS = np.arange(BLOCK, dtype=np.int32) * 256  # where the table of each place in a block begins


@lru_cache(maxsize=1)
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """For CRC-32C, which is linear: what each byte value at each distance from a block's end adds to the
    register, and what a block of zeros does to each register byte."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0x82F63B78), one >> 1).astype(np.uint32)
    at = np.empty((BLOCK, 256), np.uint32)
    at[BLOCK - 1] = one
    for i in range(BLOCK - 2, -1, -1):
        at[i] = one[at[i + 1] & 0xFF] ^ (at[i + 1] >> 8)
    return at.ravel(), at[:4].copy()


def crc32c(data: bytes) -> int:
    """CRC-32C (Castagnoli), by blocks of table lookups."""
    at, by_register = _crc_tables()
    register = 0xFFFFFFFF
    n = len(data)
    head = n % BLOCK
    values = np.frombuffer(data, np.uint8)
    if head:
        register = _short(at, values[:head], register)
    for start in range(head, n, BLOCK):
        block = int(np.bitwise_xor.reduce(at.take(ROWS + values[start:start + BLOCK])))
        for k in range(4):
            block ^= int(by_register[k][(register >> 8 * k) & 0xFF])
        register = block
    return register ^ 0xFFFFFFFF


def _short(at: np.ndarray, values: np.ndarray, register: int) -> int:
    """Fewer bytes than a block: the register joins the first four, or is shifted by as many as there are."""
    n = len(values)
    if n < 4:
        for v in values.tolist():
            register = int(at[ROWS[-1] + ((register ^ v) & 0xFF)]) ^ (register >> 8)
        return register
    mixed = values.copy()
    mixed[:4] ^= np.frombuffer(struct.pack("<I", register), np.uint8)
    return int(np.bitwise_xor.reduce(at.take(ROWS[BLOCK - n:] + mixed)))


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(crc32c(length))), payload, struct.pack("<I", masked(crc32c(payload)))))


def unframe(stream) -> Iterator[bytes]:
    """The payloads of an open file, each checked; raises ValueError on a damaged or cut frame."""
    while head := stream.read(12):
        if len(head) < 12 or masked(crc32c(head[:8])) != struct.unpack("<I", head[8:])[0]:
            raise ValueError("damaged record length")
        size = struct.unpack("<Q", head[:8])[0]
        body = stream.read(size + 4)
        if len(body) < size + 4 or masked(crc32c(body[:size])) != struct.unpack("<I", body[size:])[0]:
            raise ValueError("damaged record")
        yield body[:size]


def _store(path: str):
    """The file system of a path and the path in it; any store that pyarrow knows (file, hdfs, s3, gs ...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


MANIFEST = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("file", T.StringType()),
                         T.StructField("id_bytes", T.IntegerType()), T.StructField("records", T.LongType()), T.StructField("tokens", T.LongType())])


def write_records(df: DataFrame, folder: str, path: str, end_id: int | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode each whole text with the tokenizer file ``path``, append ``end_id`` and write record files in
    ascending id order below ``folder``, which all executors must reach; a path without a scheme is one of Spark's default
    file system, for the records as for the manifest. Returns the manifest: part (ascending as the ids do), file, id_bytes (width of an id), records, tokens.

    A range exchange on the id deals out the documents; each task streams its part to one file, so memory is
    some MB of batches, or one that is larger. Null texts: empty; null ids come first; repeated ids: by text; an empty table: an empty manifest."""
    small_batches(df.sparkSession)
    folder = qualified(df.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = library_encoder(path), TaskContext.get().partitionId()
        end = b"" if end_id is None else struct.pack("<I", end_id)
        width = id_bytes(encoder, end_id)
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        offsets, at, tokens, stream = [], 0, 0, None
        for b in joined(batches, SLICE_BYTES):
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1))):
                ids += end
                data = frame(struct.pack("<q", NO_ID if doc is None else doc) + (ids if width == 4 else narrow(ids)))
                if stream is None:
                    stream = store.open_output_stream(f"{base}/{name}.rec")
                stream.write(data)
                offsets.append(at)
                at += len(data)
                tokens += len(ids) // 4
        if stream is not None:
            stream.close()
            with store.open_output_stream(f"{base}/{name}.idx") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [f"{name}.rec"],
                                              "id_bytes": pa.array([width], pa.int32()), "records": [len(offsets)], "tokens": [tokens]})

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    manifest = f"{folder.rstrip('/')}/manifest"
    rows.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return df.sparkSession.read.schema(MANIFEST).parquet(manifest)


def id_bytes(encoder, end_id: int | None) -> int:
    """Bytes of an id in a file: 2 if no id of the vocabulary needs more."""
    largest = max(encoder.split.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
    return 2 if max(largest, end_id or 0) < 1 << 16 else 4


def narrow(ids: bytes) -> bytes:
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def wide(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def read_records(manifest: DataFrame, folder: str, id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """Read the files that the manifest names, checksums verified: (id, start, n_tokens, ids binary), or with
    ``digest`` instead of the ids ids_crc32, the unsigned CRC-32 of the ids as u32.

    ``start`` counts the ids of all documents before, over all files; only the manifest, one row for each
    file, meets in a window. A task reads a file as a stream; null ids come back as null."""
    folder = qualified(manifest.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for b in batches:
            for file, start, width in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(f"{base}/{file}", buffer_size=1 << 20) as stream:
                    for payload in unframe(stream):
                        doc, n = struct.unpack("<q", payload[:8])[0], (len(payload) - 8) // width
                        ids = wide(payload[8:], width)
                        rows.append((None if doc == NO_ID else doc, start, n, zlib.crc32(ids) if digest else ids))
                        start, held = start + n, held + (32 if digest else len(payload))
                        if held >= 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["id", "start", "n_tokens", last])

    last = "ids_crc32" if digest else "ids"

    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", "file", "id_bytes", before.cast("long").alias("start"))
    spread = files.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "file")
    out = spread.select("file", "start", "id_bytes").mapInArrow(run, f"id long, start long, n_tokens long, {last} {'long' if digest else 'binary'}")
    return out.withColumnRenamed("id", id_col)


def read_record(folder: str, file: str, number: int, width: int) -> tuple[int | None, np.ndarray]:
    """One record by its number in a file of ids of ``width`` bytes, by way of the offset index: (id, ids)."""
    store, base = _store(folder)
    with store.open_input_file(f"{base}/{file.removesuffix('.rec')}.idx") as index:
        index.seek(8 * number)
        at = struct.unpack("<Q", index.read(8))[0]
    with store.open_input_file(f"{base}/{file}") as data:
        data.seek(at)
        payload = next(unframe(data))
    doc = struct.unpack("<q", payload[:8])[0]
    return (None if doc == NO_ID else doc), np.frombuffer(wide(payload[8:], width), "<u4")
