"""``.fbin`` vector files: ``uint32 n, uint32 dim`` and ``n * dim`` little-endian float32 values.

``spark.read.format("fbin")`` splits every file into byte ranges; row ``i`` starts
at byte ``8 + 4 * dim * i``, so each task reads the rows beginning in its range and
yields Arrow batches.  ``df.write.format("fbin")`` writes bounded files per task.
"""

from __future__ import annotations

import glob
import os
import struct
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from engrama.defaults import MAX_FILE_DIM

# fixed values: the file layout
HEADER = struct.Struct("<II")
SUFFIX = ".fbin"
ROW_SCHEMA = "path string, file_name string, row_index bigint, dim int, vector array<float>"
HEADER_SCHEMA = "path string, file_name string, n bigint, dim int"

SPLIT_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """Local paths and any file system Arrow knows by URI."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    """One file, every vector file of a folder, or a local glob; other suffixes are refused."""
    system, inner = _open(path)
    if any(c in inner for c in "*?[") and isinstance(system, fs.LocalFileSystem):
        found = sorted(p for p in glob.glob(inner) if p.lower().endswith(SUFFIX))
    else:
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == fs.FileType.Directory:
            listing = system.get_file_info(fs.FileSelector(inner))
            found = sorted(i.path for i in listing if i.path.lower().endswith(SUFFIX))
        else:
            if not inner.lower().endswith(SUFFIX):
                raise ValueError(f"only {SUFFIX} vector files can be read, got {path}")
            found = [inner]
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return [prefix + f for f in found]


def _sizes(path: str) -> list[tuple[str, int]]:
    """Files with their bytes, from one listing per call of the file system."""
    files = _files(path)
    if not files:
        return []
    system, _ = _open(files[0])
    return [(f, info.size) for f, info in zip(files, system.get_file_info([_open(f)[1] for f in files]))]


def read_header(path: str) -> tuple[int, int]:
    system, inner = _open(path)
    with system.open_input_file(inner) as source:
        head = source.read(HEADER.size)
    if len(head) != HEADER.size:
        raise ValueError(f"{path}: header shorter than {HEADER.size} bytes")
    n, dim = HEADER.unpack(head)
    if not 0 < dim <= MAX_FILE_DIM:
        raise ValueError(f"{path}: dimension {dim} is outside 1..{MAX_FILE_DIM}")
    return n, dim


@dataclass
class FilePart(InputPartition):
    path: str


@dataclass
class ByteRange(InputPartition):
    """Rows beginning in bytes [start, end) of a file; the last range of a file has no end."""

    path: str
    start: int
    end: int | None


class FbinSource(DataSource):
    """``path`` is a file, folder or glob; ``limit`` caps rows per file; ``mode=header`` reads sizes only."""

    @classmethod
    def name(cls) -> str:
        return "fbin"

    def schema(self) -> str:
        return HEADER_SCHEMA if self.options.get("mode") == "header" else ROW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HeaderReader(self.options) if self.options.get("mode") == "header" else RowReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FbinWriter(self.options)


class HeaderReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.limit = options["path"], int(options.get("limit", 0))

    def partitions(self):
        return [FilePart(p) for p in _files(self.path)]

    def read(self, part):
        n, dim = read_header(part.path)
        yield part.path, os.path.basename(part.path), min(n, self.limit) if self.limit > 0 else n, dim


class RowReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.limit = options["path"], int(options.get("limit", 0))
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self):
        """Ranges by file size alone: headers are opened by the tasks, not by the driver one after the other."""
        parts = []
        for path, size in _sizes(self.path):
            cuts = list(range(0, max(size, 1), self.split_bytes))
            parts += [ByteRange(path, a, b) for a, b in zip(cuts, [*cuts[1:], None])]
        return parts or [ByteRange("", 0, 0)]  # Spark wants one partition even when there is no row

    def read(self, part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        n, dim = read_header(part.path)
        n = min(n, self.limit) if self.limit > 0 else n
        system, inner = _open(part.path)
        width = 4 * dim
        step = max(1, BATCH_BYTES // width)
        begin = max(0, -(-(part.start - HEADER.size) // width))
        stop = n if part.end is None else min(n, -(-(part.end - HEADER.size) // width))
        if begin >= stop:
            return
        with system.open_input_file(inner) as source:
            source.seek(HEADER.size + width * begin)
            for first in range(begin, stop, step):
                rows = min(step, stop - first)
                raw = source.read(rows * width)
                if len(raw) != rows * width:
                    raise ValueError(f"{part.path}: the header promises {n} rows, the file ends in row {first + len(raw) // width}")
                flat = pa.array(np.frombuffer(raw, dtype="<f4"))
                offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.path] * rows),
                        pa.array([os.path.basename(part.path)] * rows),
                        pa.array(np.arange(first, first + rows, dtype=np.int64)),
                        pa.array(np.full(rows, dim, dtype=np.int32)),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    names=["path", "file_name", "row_index", "dim", "vector"],
                )


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class FbinWriter(DataSourceArrowWriter):
    """Takes one vector column.  Files are closed at ``fileBytes``, so their row count is known when the
    header is written and nothing is rewritten in place.

    Tasks write into a folder of this write; committing moves the finished tasks' files out of it, so an
    append never meets earlier files and a lost or repeated task leaves nothing behind.  Names begin with the
    time of the write, so files of later appends sort behind earlier ones.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.write_id = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.pending = f"{self.path.rstrip('/')}/_pending-{self.write_id}"
        self.column = options.get("column", "vector")
        self.file_bytes = int(options.get("fileBytes", SPLIT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        partition, attempt = context.partitionId(), context.taskAttemptId()
        paths, blocks, held = [], [], 0

        def flush():
            nonlocal blocks, held
            if not blocks:
                return
            if len({b.shape[1] for b in blocks}) != 1:
                raise ValueError("all vectors of one file must have the same dimension")
            rows = np.concatenate(blocks)
            target = f"{self.pending}/{attempt}/part-{self.write_id}-{partition:05d}-{len(paths):04d}{SUFFIX}"
            system, inner = _open(target)
            system.create_dir(os.path.dirname(inner), recursive=True)
            with system.open_output_stream(inner) as sink:
                sink.write(HEADER.pack(*rows.shape))
                sink.write(rows.astype("<f4").tobytes())
            paths.append(target)
            blocks, held = [], 0

        for batch in iterator:
            if not batch.num_rows:
                continue
            column = batch.column(self.column)
            lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            if not (lengths == lengths[0]).all():
                raise ValueError("all vectors of one file must have the same dimension")
            rows = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, int(lengths[0]))
            blocks.append(rows)
            held += rows.size * 4
            if held >= self.file_bytes:
                flush()
        flush()
        return Written(paths)

    def commit(self, messages) -> None:
        system, root = _open(self.path.rstrip("/"))
        system.create_dir(root, recursive=True)
        for path in (p for m in messages if m for p in m.paths):
            inner = _open(path)[1]
            system.move(inner, f"{root}/{os.path.basename(inner)}")
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        system, inner = _open(self.pending)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            system.delete_dir(inner)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FbinSource)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("fbin").options(**options).load(path)


def write(df: DataFrame, path: str, column: str, order: str | None = None, **options) -> None:
    """Write one vector column; with ``order`` the files, by name, follow that column."""
    register(df.sparkSession)
    if order:
        df = df.repartitionByRange(order).sortWithinPartitions(order)
    df.select(column).write.format("fbin").mode("append").options(column=column, **options).save(path)


def file_offsets(headers: DataFrame) -> DataFrame:
    """First global row number of every file, in name order (one row per file)."""
    from pyspark.sql import Window

    earlier = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    return headers.select("path", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_row"))


def reconcile(headers: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows promised by the header against rows loaded, per file."""
    counts = loaded.groupBy("path").agg(F.count(F.lit(1)).alias("n_loaded"))
    return headers.join(counts, "path", "left").select(
        "path", "file_name", "n", "dim", F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"),
        (F.coalesce("n_loaded", F.lit(0)) == F.col("n")).alias("complete"),
    )
