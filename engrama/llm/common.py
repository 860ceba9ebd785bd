"""Helpers shared by the operators: batches, checked broadcasts, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.session import materialize, ship_package

BROADCAST_BYTES = 32 * 1024 * 1024  # largest side sent to every executor
BATCH_ROWS = 256                    # rows of texts handed to a Python worker at once


def text_batches(df: DataFrame) -> DataFrame:
    """Hand texts to Python in small batches, since one text may be very long."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to each non-empty Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return text_batches(df).mapInArrow(run, schema)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores put in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sized(df: DataFrame, row_bytes: int, array: str | None = None, cell_bytes: int = 0) -> DataFrame:
    """``df``, which should be pinned, marked for broadcast if its measured size fits; else left to a shuffle.

    Measured are its rows, and the cells of ``array`` if it has one.
    """
    cells = F.coalesce(F.sum(F.size(array).cast("bigint")), F.lit(0)) if array else F.lit(0)
    size = df.agg(F.count(F.lit(1)).alias("rows"), cells.alias("cells")).first()
    return F.broadcast(df) if size["rows"] * row_bytes + size["cells"] * cell_bytes <= BROADCAST_BYTES else df


def released(df: DataFrame) -> DataFrame:
    """``df`` pinned, and the shuffle files of the steps before it let go.

    Spark removes those once the driver's JVM has collected the plans they belong
    to, which a quiet driver does seldom; a job of many steps would keep them all.
    """
    pinned = materialize(df)
    pinned.sparkSession.sparkContext._jvm.System.gc()
    return pinned


def connected_components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id that can be reached.

    Alternates large-star and small-star steps: every id is joined to the
    smallest id near it until only stars are left.  Each round is pinned, and a
    hot center's links stay rows, which a skewed join can split.  After ``rounds``,
    if given, ids of one component may still differ, but never agree across two.
    """
    edges = materialize(links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("u > v").distinct())
    seen, done = None, 0
    while rounds is None or done < rounds:
        done += 1
        if rounds is None:
            state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if state == seen:
                break
            seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = released(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())
    # an id with several smaller neighbours, before the last round, takes the smallest
    own = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    centers = edges.select(F.col("v").alias("id")).distinct().join(own.select("id"), "id", "left_anti")
    return own.unionByName(centers.select("id", F.col("id").alias("component")))


def crc32_text(column: Column) -> Column:
    """crc32 of a value's text form."""
    return F.crc32(column.cast("string").cast("binary"))
