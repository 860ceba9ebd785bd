"""Length-delimited binary records of token ids, with an offset index for shuffled reads.

A file is a run of records.  A record is

    length of the payload   8 bytes, unsigned, little-endian
    masked checksum of it   4 bytes
    payload                 `length` bytes
    masked checksum of it   4 bytes

with crc32 masked as ``rotate_right(crc, 15) + 0xa282ead8``, so that a checksum
stored among data isn't taken for one of its own.  A payload is the document's
number (8 bytes), then its ids as little-endian unsigned 32-bit integers in one zstd frame.
The index is a table with one row per record: file, offset, size, first id, ids.

Files are ordered by range-partitioning on ``doc_id``; a task writes its own file
under a new name, and only files named by the finished task's index rows exist for
readers.  So a task that is lost and run again leaves at most an unread file.

Results for odd input: a null text has just the end id; rows with a null id come
first and keep it; rows of one id are separate records, next to each other.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import Struct

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engrama.llm.common import text_batches
from engrama.llm.tokens import END_ID, encoder, vocabulary_path
from engrama.session import work_dir

_LENGTH, _CHECK, _HEAD = Struct("<Q"), Struct("<I"), Struct("<?q")
_END = np.asarray([END_ID], dtype="<u4").tobytes()
READ_BYTES = 8 * 1024 * 1024  # neighbouring records fetched in one read
INDEX = "file string, offset bigint, size bigint, doc_id bigint, n_tokens bigint, row bigint"


class CorruptRecord(ValueError):
    """A record whose length or payload doesn't agree with its checksum."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def unframe(record: bytes | memoryview) -> bytes:
    """The payload of one whole record, checked."""
    record = bytes(record)
    length = record[:8]
    if len(record) < 16 or _CHECK.unpack_from(record, 8)[0] != masked(length):
        raise CorruptRecord("length checksum")
    payload = record[12:-4]
    if len(payload) != _LENGTH.unpack(length)[0] or _CHECK.unpack_from(record, len(record) - 4)[0] != masked(payload):
        raise CorruptRecord("payload checksum")
    return payload


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One of each per worker process."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def encode_payload(doc_id: int | None, ids: bytes) -> bytes:
    return _HEAD.pack(doc_id is not None, doc_id or 0) + _codec()[0].compress(ids)


def decode_payload(payload: bytes) -> tuple[int | None, bytes]:
    known, doc_id = _HEAD.unpack_from(payload)
    return doc_id if known else None, _codec()[1].decompress(payload[_HEAD.size:])


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _writer(folder: str, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.rec"  # by name in the order of ids
        out, offset, row = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = store.open_output_stream(f"{root}/{name}")
            offsets, sizes, counts = [], [], []
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder(vocabulary).encode(batch.column(1).to_pylist())):
                record = frame(encode_payload(doc_id, tokens + _END))
                out.write(record)
                offsets.append(offset), sizes.append(len(record)), counts.append(len(tokens) // 4 + 1)
                offset += len(record)
            yield pa.RecordBatch.from_pydict({
                "file": [name] * len(ids), "offset": offsets, "size": sizes, "doc_id": pa.array(ids, pa.int64()),
                "n_tokens": counts, "row": list(range(row, row + len(ids))),
            })
            row += len(ids)
        if out is not None:
            out.close()  # raises if the file isn't whole, before the task ends

    return run


def write_records(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Write the documents' ids in ascending ``doc_id`` order to ``folder``; returns the stored index.

    ``folder`` must be reachable by all executors.  The index is written next to
    the files, so each record is encoded once however often it is read.
    """
    spark = docs.sparkSession
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    vocabulary = vocabulary or vocabulary_path()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # many rows of one id, or of none, spread by their texts
    ordered = texts.withColumn("salt", F.xxhash64("text")).repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt").drop("salt")
    text_batches(ordered).mapInArrow(_writer(folder, vocabulary), INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: the number of ids in all records before, over all files in order."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    # one row per file: as few as there were write tasks
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return local.join(F.broadcast(shifts), "file").select(
        "file", "offset", "size", "doc_id", "n_tokens", "row", (F.col("before") + F.col("inside")).cast("bigint").alias("start")
    )


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        name, source = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, offsets, sizes = (batch.column(i).to_pylist() for i in range(3))
            ids, counts, checks = [], [], []
            held, begin = memoryview(b""), 0
            for i, (file, offset, size) in enumerate(zip(files, offsets, sizes)):
                if file != name:
                    name, source, held = file, store.open_input_file(f"{root}/{file}"), memoryview(b"")
                if not begin <= offset <= offset + size <= begin + len(held):
                    last = i  # records that follow without a gap are fetched together
                    while last + 1 < len(files) and files[last + 1] == file and offsets[last + 1] == offsets[last] + sizes[last] and offsets[last + 1] + sizes[last + 1] - offset <= READ_BYTES:
                        last += 1
                    begin, held = offset, memoryview(source.read_at(offsets[last] + sizes[last] - offset, offset))
                doc_id, tokens = decode_payload(unframe(held[offset - begin:offset - begin + size]))
                ids.append(doc_id), counts.append(len(tokens) // 4), checks.append(zlib.crc32(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column(3), pa.array(counts, pa.int64()), pa.array(checks, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return run


def read_digests(index: DataFrame, folder: str) -> DataFrame:
    """Read every record in the index back: doc_id, start, n_tokens and the checksum of its ids."""
    wanted = index.select("file", "offset", "size", "start").sortWithinPartitions("file", "offset")
    return text_batches(wanted).mapInArrow(_reader(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_records(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` and read them back from their files."""
    folder = folder or work_dir(docs.sparkSession, "records")
    return read_digests(write_records(docs, folder, vocabulary), folder)
