"""Session defaults and the shared scratch folder.

Intermediate tables and checkpoints go to the folder the cluster names in
``spark.checkpoint.dir``.  A local folder is made up only for ``local[*]``
masters (tests, laptops), where driver and executors share one disk anyway.
"""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, app_name: str = "engrama", **conf: str
) -> SparkSession:
    """A session with the defaults above; a cluster passes no master and its own sizes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; on a local master without one, a fresh temp folder."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="engrama-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint, so that partition numbers stay fixed on retry."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str, floor: int = 1024 * 1024) -> DataFrame:
    """Use all cores on a table too small to have a full scan split for each of them.

    A large table already has more splits than cores and is returned as it is,
    so no shuffle is added where one would cost.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, *keys) if floor < size < cores * split else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the key columns are the left side's."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matched = reduce(and_, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    joined = left.join(renamed, matched, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started (as ``--py-files`` would)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='engrama-package-')}/engrama", "zip", package.parent, package.name
    )
    context.addPyFile(archive)  # Spark copies it to every executor
    _shipped.add(context.applicationId)
