"""The event log as text frames: ``event: wal`` and ``data:`` lines, a blank line after each frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the frame layout
EVENT_NAME = "wal"
FRAME_END = "\n\n"
EVENT_SCHEMA = "lsn bigint, event string, _raw string"


def write_log(events: DataFrame, path: str, lsn: str = "lsn") -> None:
    """One frame per event, with the remaining columns as the JSON event."""
    body = F.struct(*[F.col(c) for c in events.columns if c != lsn])
    data = F.to_json(F.struct(F.col(lsn).alias("lsn"), body.alias("event")))
    frames = events.select(F.concat(F.lit(f"event: {EVENT_NAME}\ndata: "), data).alias("value"))
    frames.write.mode("append").option("lineSep", FRAME_END).text(path)


def _with_file(raw: DataFrame) -> DataFrame:
    return raw.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def read_frames(spark: SparkSession, path: str, newline: str = "\n") -> DataFrame:
    """Raw frames with where they came from; the scan splits large files between frames."""
    return _with_file(spark.read.option("lineSep", newline * 2).text(path))


def finished_frames(frames: DataFrame, newline: str = "\n") -> DataFrame:
    """Drop the last frame of a file that ends before the frame's blank line.

    Every finished frame takes its bytes plus the separator; when these sums pass
    the file size, the file's last row was cut short.  A compressed log can't be
    appended to and is taken as finished.
    """
    packed = F.lower(F.col("_file")).rlike(r"\.(gz|bz2|zst|deflate|lz4|snappy|xz)$")
    placed = frames.withColumn("_at", F.struct("_block", F.monotonically_increasing_id().alias("_id")))
    per_file = placed.groupBy("_file").agg(
        F.max("_at").alias("_last"),
        (~F.bool_or(packed) & (F.sum(F.octet_length("value") + 2 * len(newline)) > F.max("_size"))).alias("_cut"),
    )
    kept = placed.join(per_file, "_file").where(~(F.col("_cut") & (F.col("_at") == F.col("_last"))))
    return kept.select(*frames.columns)


def _after(prefix: str, lines: Column) -> Column:
    return F.filter(lines, lambda line: F.startswith(line, F.lit(prefix)))


def parse_frames(frames: DataFrame, newline: str = "\n") -> DataFrame:
    """``(lsn, event, parse_error, raw)`` of the log frames; comments and other frames are skipped."""
    return parse_finished(finished_frames(frames, newline))


def parse_finished(frames: DataFrame) -> DataFrame:
    """``parse_frames`` of frames that are all whole."""
    lines = F.split(F.col("value"), "\r?\n")
    names = F.transform(_after("event:", lines), lambda line: F.trim(F.substring(line, 7, 1 << 30)))
    data = F.transform(_after("data:", lines), lambda line: F.ltrim(F.substring(line, 6, 1 << 30)))
    parsed = frames.select(
        F.try_element_at(names, F.lit(-1)).alias("_name"), F.size(data).alias("_n"),
        F.array_join(data, "\n").alias("raw"),
    ).where((F.col("_name") == EVENT_NAME) & (F.col("_n") > 0))
    fields = F.from_json("raw", EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"})
    return parsed.select(fields.alias("f"), "raw").select(
        "f.lsn", "f.event", F.col("f._raw").isNotNull().alias("parse_error"),
        F.when(F.col("f._raw").isNotNull(), F.col("raw")).alias("raw"),
    )


def scan_log(spark: SparkSession, path: str, from_lsn: int = 0, newline: str = "\n") -> DataFrame:
    """Events of a log from ``from_lsn`` on; unparsable frames have no position and are always kept as such."""
    return from_position(parse_frames(read_frames(spark, path, newline), newline), from_lsn)


def from_position(events: DataFrame, from_lsn: int) -> DataFrame:
    return events.where((F.col("lsn") >= from_lsn) | F.col("lsn").isNull())
