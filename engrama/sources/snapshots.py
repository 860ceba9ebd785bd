"""Tables as numbered versions: a change writes a new folder, readers take the newest finished one.

A writer fills a folder of its own and then commits it under the next number by creating
that number's commit file, which only one writer can: of two at once, the other gets a
``Conflict`` and has changed nothing.  A folder that nobody committed is never read, so a
lost executor or driver never exposes half a table, and the last good version stays
readable.  A writer that died between creating and filling its commit file leaves a
number without a version, which the next one skips.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.session import join_null_safe, materialize

ROWS_PER_FILE = 5_000_000
BYTES_PER_FILE = 128 * 1024 * 1024  # of values in memory, by estimate
_COMMITS = "_commits"


class Conflict(RuntimeError):
    """Another writer has committed the version this one was to be."""


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm


def exists(spark: SparkSession, path: str) -> bool:
    system, target, _ = _file_system(spark, path)
    return system.exists(target)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions, oldest first."""
    return sorted({number for number, _ in _folders(spark, root)})


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers that some writer has taken, oldest first."""
    system, target, _ = _file_system(spark, f"{root}/{_COMMITS}")
    if not system.exists(target):
        return []
    return sorted(int(n) for n in (s.getPath().getName() for s in system.listStatus(target)) if n.isdigit())


def _folders(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(version, folder name) of all committed versions, oldest first."""
    found = []
    for number in _numbers(spark, root):
        system, target, jvm = _file_system(spark, f"{root}/{_COMMITS}/{number}")
        stream = system.open(target)
        try:
            name = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        if name:
            found.append((number, name))
    return found


def _next(spark: SparkSession, root: str, based_on: int | None) -> int:
    """The number to commit; ``based_on`` must still be the newest version."""
    newest = (versions(spark, root) or [0])[-1]
    if based_on is not None and newest != based_on:
        raise Conflict(f"{root}: version {newest} has come after version {based_on}")
    return ([newest, *_numbers(spark, root)])[-1] + 1


def retried(change: Callable[[], None], tries: int) -> None:
    """Run a change that reads the newest version and writes the next, again after each conflict."""
    for left in range(tries - 1, -1, -1):
        try:
            return change()
        except Conflict:
            if not left:
                raise


def _folder_name(number: int, job: str) -> str:
    return f"v={number}-{_job_mark(job) if job else 0}-{uuid.uuid4().hex}"


def _commit(spark: SparkSession, root: str, number: int, name: str) -> None:
    """Make the folder version ``number``, unless there is one."""
    system, target, _ = _file_system(spark, f"{root}/{_COMMITS}/{number}")
    try:
        stream = system.create(target, False)  # fails if the file exists
    except Py4JJavaError as error:
        if system.exists(target):
            raise Conflict(f"{root}: version {number} was committed by another writer") from error
        raise
    stream.write(bytearray(name.encode()))
    stream.close()


def _job_mark(job: str) -> str:
    return hashlib.sha256(job.encode()).hexdigest()[:32]


class _Finished:
    """Which jobs wrote a finished version, by the mark in its folder's name."""

    def __init__(self, marks: set[str]):
        self.marks = marks

    def __contains__(self, job: str) -> bool:
        return _job_mark(job) in self.marks


def finished_jobs(spark: SparkSession, root: str) -> _Finished:
    return _Finished({name.split("-")[1] for _, name in _folders(spark, root) if "-" in name})


def write_version(df: DataFrame, root: str, partition_by: str | None = None, job: str = "", based_on: int | None = None) -> int:
    """Write the next version and return its number; ``df`` may read an earlier one.

    With ``job`` the folder's name carries the job's mark.  ``based_on`` is the version
    that ``df`` was made from (0: none); if there is a newer one, ``Conflict`` is raised.
    """
    spark = df.sparkSession
    number = _next(spark, root, based_on)
    name = _folder_name(number, job)
    if partition_by:
        spread_by(df, partition_by).write.partitionBy(partition_by).parquet(f"{root}/{name}")
    else:
        df.write.parquet(f"{root}/{name}")
    _commit(spark, root, number, name)
    return number


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    found = [name for n, name in _folders(spark, root) if number in (None, n)]
    if not found:
        raise FileNotFoundError(root)
    parts = _parts(spark, root, found[-1])
    if parts is None:
        return spark.read.parquet(f"{root}/{found[-1]}")
    key, held = parts
    frames = [spark.read.parquet(f"{root}/{folder}").where(_among(F.col(key), values)) for folder, values in sorted(held.items())]
    if not frames:  # every partition is gone: the columns are those of the version before
        numbers = [n for n, name in _folders(spark, root)]
        at = next(n for n, name in _folders(spark, root) if name == found[-1])
        return read_version(spark, root, numbers[numbers.index(at) - 1]).where("false")
    return reduce(lambda a, b: a.unionByName(b), frames)


def _among(column: Column, values: list) -> Column:
    known = [v for v in values if v is not None]
    return F.coalesce(column.isin(known), F.lit(False)) | (column.isNull() if None in values else F.lit(False))


def _parts(spark: SparkSession, root: str, name: str) -> tuple[str, dict[str, list]] | None:
    """(partition column, values by the folder that holds them) of a version written in part; None for a whole one."""
    if not exists(spark, f"{root}/parts-{name}"):
        return None
    rows = spark.read.parquet(f"{root}/parts-{name}")
    key = next(c for c in rows.columns if c != "_folder")
    held: dict[str, list] = {}
    for r in rows.collect():  # as many as the table has partitions
        if r["_folder"] is not None:
            held.setdefault(r["_folder"], []).append(r[key])
    return key, held


def write_changed(
    changed: DataFrame, root: str, partition_by: str, touched: DataFrame, job: str = "", based_on: int | None = None
) -> int:
    """Write the next version by rewriting only the touched partitions; the others stay where they are.

    ``changed`` holds what is left of the touched partitions.  A small table next to
    the version tells which folder holds which partition; the commit finishes both.
    """
    spark = changed.sparkSession
    number = _next(spark, root, based_on)
    before = _folders(spark, root)[-1][1]
    name = _folder_name(number, job)
    old = _parts(spark, root, before)
    if old is None:
        values = spark.read.parquet(f"{root}/{before}").select(partition_by).distinct().withColumn("_folder", F.lit(before))
    else:
        rows = [(v, folder) for folder, held in old[1].items() for v in held]
        kind = changed.schema[partition_by].dataType.simpleString()
        values = spark.createDataFrame(rows, f"{partition_by} {kind}, _folder string")
    kept = values.join(touched, values[partition_by].eqNullSafe(touched[partition_by]), "left_anti")
    moved = changed.select(partition_by).distinct().withColumn("_folder", F.lit(name))
    kept.unionByName(moved).coalesce(1).write.parquet(f"{root}/parts-{name}")
    spread_by(changed, partition_by).write.partitionBy(partition_by).parquet(f"{root}/{name}")
    _commit(spark, root, number, name)
    return number


def spread_by(df: DataFrame, key: str, rows_per_file: int = ROWS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Gather rows by ``key`` for a partitioned write, with a hot key cut into several tasks by its rows and bytes.

    The shares are a row per folder, so they go to the rows and no row moves for them.
    """
    pieces = F.greatest(F.count(F.lit(1)) / rows_per_file, F.sum(row_bytes(df)) / bytes_per_file)
    shares = materialize(df.groupBy(key).agg(F.ceil(pieces).cast("int").alias("_pieces")))
    total = shares.agg(F.sum("_pieces")).first()[0] or 0
    cut = join_null_safe(df, F.broadcast(shares), [key]).withColumn("_piece", F.pmod(F.xxhash64(*df.columns), "_pieces"))
    enough = total <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cut.repartition(key, "_piece") if enough else cut.repartition(total, key, "_piece")).select(*df.columns)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    def size(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.octet_length(column)
        if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            return F.size(column) * 8
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(column.alias("v"))))
        return F.lit(8)

    sizes = [F.coalesce(size(F.col(f"`{f.name}`"), f.dataType).cast("bigint"), F.lit(0)) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, sizes)


def manifest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count and an order-free checksum per key."""
    digest = F.sum(F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), digest.cast("string").alias("checksum"))


def export_snapshot(df: DataFrame, path: str, partition_by: str) -> DataFrame:
    """Write partitioned Parquet and compare what is read back with what was meant to be written."""
    spread_by(df, partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    back = df.sparkSession.read.parquet(path).select(*df.columns)
    want, got = manifest(df, [partition_by]), manifest(back, [partition_by])
    got = got.withColumnsRenamed({"n_rows": "n_read", "checksum": "checksum_read", partition_by: "_read_key"})
    return want.join(got, want[partition_by].eqNullSafe(got["_read_key"]), "full").select(
        F.coalesce(want[partition_by], got["_read_key"]).alias(partition_by), "n_rows", "n_read",
        (F.col("n_rows").eqNullSafe(F.col("n_read")) & F.col("checksum").eqNullSafe(F.col("checksum_read")))
        .alias("verified"),
    )
