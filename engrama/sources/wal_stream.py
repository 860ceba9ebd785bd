"""A growing log as a streaming source: offsets are the bytes of each file up to its last finished frame.

A file that ends within a frame is read up to the frame before, and from there on once
the rest has come, so no frame is lost or read twice however the log is appended to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from engrama.sources.fbin import _open

FRAME_SCHEMA = "value string, path string, position bigint"
SPLIT_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 1024 * 1024
PACKED = (".gz", ".bz2", ".zst", ".lz4")  # can't be appended to: taken as finished


@dataclass
class LogRange(InputPartition):
    """Bytes [start, end) of a file: whole frames."""

    path: str
    start: int
    end: int


def last_frame_end(source, size: int, separator: bytes, block: int = BLOCK_BYTES) -> int:
    """Where the last finished frame ends; 0 if there is none.  Reads backwards, no further than that."""
    high = size
    while high > 0:
        low = max(0, high - block)
        data = source.read_at(min(size, high + len(separator) - 1) - low, low)
        at = data.rfind(separator)
        if at >= 0:
            return low + at + len(separator)
        high = low
    return 0


def next_frame_end(source, start: int, end: int, separator: bytes, block: int = BLOCK_BYTES) -> int:
    """Where the first frame that ends after ``start`` ends, or ``end``."""
    low = start
    while low < end:
        data = source.read_at(min(end - low, block + len(separator) - 1), low)
        at = data.find(separator)
        if at >= 0:
            return low + at + len(separator)
        low += block
    return end


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.separator = options.get("newline", "\n").encode().decode("unicode_escape").encode() * 2
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def _ends(self) -> dict[str, int]:
        system, inner = _open(self.path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            return {}
        listing = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner))
        ends = {}
        for file in listing:
            if file.type != fs.FileType.File or file.base_name.startswith(("_", ".")):
                continue
            if file.path.endswith(PACKED):
                ends[file.path] = file.size
                continue
            with system.open_input_file(file.path) as source:
                ends[file.path] = last_frame_end(source, file.size, self.separator)
        return ends

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        system, _ = _open(self.path)
        parts = []
        for path, high in sorted(end.items()):
            low = start.get(path, 0)
            if high < low:
                raise ValueError(f"{path}: shorter than what was read of it")
            if path.endswith(PACKED) or high - low <= self.split:
                parts += [LogRange(path, low, high)] if high > low else []
                continue
            with system.open_input_file(path) as source:  # cuts are made once, between frames
                while low < high:
                    cut = high if high - low <= self.split else next_frame_end(source, low + self.split, high, self.separator)
                    parts.append(LogRange(path, low, cut))
                    low = cut
        return parts or [LogRange("", 0, 0)]

    def read(self, part: LogRange) -> Iterator[tuple[str, str, int]]:
        if part.end <= part.start:
            return
        system, _ = _open(self.path)
        if part.path.endswith(PACKED):
            if part.start == 0:
                with system.open_input_stream(part.path, compression="detect") as source:
                    yield from self._frames(lambda n: source.read(n), None, part)
            return
        with system.open_input_file(part.path) as source:
            source.seek(part.start)
            yield from self._frames(source.read, part.end - part.start, part)

    def _frames(self, read, left: int | None, part: LogRange) -> Iterator[tuple[str, str, int]]:
        """Frames from blocks; what is held is one frame and one block."""
        held, at = b"", part.start
        while left is None or left > 0:
            data = read(BLOCK_BYTES if left is None else min(left, BLOCK_BYTES))
            if not data:
                break
            left = None if left is None else left - len(data)
            *whole, held = (held + data).split(self.separator)
            for frame in whole:
                yield frame.decode("utf-8", "replace"), part.path, at
                at += len(frame) + len(self.separator)
        if held:  # the end of a packed file
            yield held.decode("utf-8", "replace"), part.path, at


class LogSource(DataSource):
    """``path`` is a log file or a folder of them; ``newline`` is how its lines end."""

    @classmethod
    def name(cls) -> str:
        return "agent_log"

    def schema(self) -> str:
        return FRAME_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(self.options)


def follow(spark: SparkSession, path: str, newline: str = "\n", **options: str) -> DataFrame:
    """Frames of a log as they are finished: value, path, position."""
    spark.dataSource.register(LogSource)
    written = {"\n": "\\n", "\r\n": "\\r\\n"}[newline]
    return spark.readStream.format("agent_log").options(newline=written, **options).load(path)
