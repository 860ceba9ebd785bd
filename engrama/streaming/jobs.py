"""Structured Streaming jobs: log tail, deduplicated ingest, materialization, metrics, task lifecycle.

Every job takes a streaming DataFrame and folders for its output and its
checkpoint.  Sinks that use ``foreachBatch`` write each micro-batch to its own
folder, so a batch that is run again after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from engrama.operators.ingest import materialize_memory, upsert_latest
from engrama.session import join_null_safe
from engrama.sources import snapshots
from engrama.sources.wal import from_position, parse_finished
from engrama.streaming.lifecycle import OUTCOME_SCHEMA, TaskLifecycle

INGEST_DELAY = "1 hour"
TASK_BUCKETS = 256  # choose it so that a bucket has some ten thousand open tasks at most
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name Spark writes for null
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, to the end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def table_stream(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def with_event_time(stream: DataFrame, column: str = "event_time") -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def _per_batch(transform: Callable[[DataFrame], DataFrame], output: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return write


def wal_tail(frames: DataFrame, output: str, checkpoint: str, from_lsn: int = 0) -> StreamingQuery:
    """Follow the log (``wal_stream.follow``) and append its events from a position on.

    A frame comes once it is finished, in a file that has grown since the last run as well.
    """
    def parse(batch: DataFrame) -> DataFrame:
        return from_position(parse_finished(batch), from_lsn)

    writer = frames.writeStream.foreachBatch(_per_batch(parse, output)).option("checkpointLocation", checkpoint)
    return run_available(writer)


def _ids_of_days(spark: SparkSession, output: str, days: DataFrame, schema: T.StructType, batch_id: int) -> DataFrame | None:
    """Rows that earlier micro-batches wrote for these days, or None; an unfinished run of this batch isn't among them.

    Only the folders of these days are listed, however many batches and days there have been.
    """
    # one value per day a micro-batch brings
    names = [r.name for r in days.select(F.coalesce(F.col("event_date").cast("string"), F.lit(NULL_DAY)).alias("name")).distinct().collect()]
    folders = [f for f in (f"{output}/event_date={name}" for name in names) if snapshots.exists(spark, f)]
    if not folders:
        return None
    kept = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(kept).option("basePath", output).parquet(*folders).where(F.col("batch_id") < batch_id)


def deduplicated_ingest(events: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """One row per event id and day of the event, however late it comes.

    The output, a folder per day and in it one per batch, is its own ledger: a batch
    lists and reads the days it brings, so no event is discarded, no state grows, and a
    batch doesn't get dearer with the batches before it.  A repeated delivery has the
    time of the first.  Events without an id are all kept.  A batch that is run again
    replaces the folders it wrote.
    """
    keys = ["event_id", "event_date"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("event_date", F.to_date("event_time"))
        fresh = dated.where("event_id IS NOT NULL").dropDuplicates(keys)
        earlier = _ids_of_days(spark, output, fresh.select("event_date"), dated.schema, batch_id)
        if earlier is not None:
            fresh = join_null_safe(fresh, earlier.select(*keys), keys, "left_anti")
        rows = fresh.unionByName(dated.where("event_id IS NULL")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replaced = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy("event_date", "batch_id").parquet(output)

    return run_available(events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def ingested(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop("batch_id", "event_date")


def materialization(events: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Memories from every micro-batch, newest version per event; ``current_memory`` merges the batches."""
    writer = events.writeStream.foreachBatch(_per_batch(materialize_memory, output))
    return run_available(writer.option("checkpointLocation", checkpoint))


def current_memory(spark: SparkSession, output: str, table: str | None = None) -> DataFrame:
    """Newest version of every id: of the compacted table, if there is one, and the batches written since."""
    rows = spark.read.parquet(output)
    newest = [F.desc("version"), F.desc("event_time"), F.desc("batch_id")]
    base = rows.where("false")
    if table and snapshots.versions(spark, table):
        base = snapshots.read_version(spark, table)
        through = base.agg(F.max("batch_id")).first()[0]
        rows = rows.where(F.col("batch_id") > through)
        base = base.select(*rows.columns)
    return upsert_latest(base, rows, ["memory_id"], newest).drop("batch_id")


def compact_memory(spark: SparkSession, output: str, table: str) -> int:
    """Write the next version of the compacted table, so that reads merge only newer batches; returns its number.

    Every row carries the last batch it includes.
    """
    last = spark.read.parquet(output).agg(F.max("batch_id")).first()[0]
    merged = current_memory(spark, output, table).withColumn("batch_id", F.lit(last))
    return snapshots.write_version(merged, table)


def _latest_before(spark: SparkSession, output: str, batch_id: int) -> object:
    """The latest event time before this micro-batch: one row, kept by the batch before it."""
    if not batch_id:
        return None
    return spark.read.parquet(f"{output}/reached/batch_id={batch_id - 1}").first().latest


def window_metrics(
    events: DataFrame, output: str, checkpoint: str, window: str = "1 day", delay: str = INGEST_DELAY
) -> StreamingQuery:
    """Event counts per window, workspace and type: each batch adds its part, late rows like any other.

    ``n_late`` counts input rows whose window had closed before they came.  How far the
    stream has come is one row per batch, apart from the counts, and a batch reads only
    the row of the batch before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = _latest_before(spark, output, batch_id)
        counted = batch.groupBy(F.window(F.col("event_time").cast("timestamp"), window), "workspace_id", "event_type").agg(
            F.count(F.lit(1)).alias("n_events"), F.sum(F.octet_length("payload")).alias("payload_bytes"), F.max("event_time").alias("latest"),
        )
        closed = F.lit(False) if latest is None else F.col("window.end").cast("timestamp_ntz") <= F.lit(latest) - F.expr(f"interval {delay}")
        counts = f"{output}/counts/batch_id={batch_id}"
        counted.select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "workspace_id", "event_type", "n_events", "payload_bytes", F.when(closed, F.col("n_events")).otherwise(0).alias("n_late"), "latest",
        ).write.mode("overwrite").parquet(counts)
        reached = spark.read.parquet(counts).agg(F.max("latest").alias("latest"))
        if latest is not None:
            reached = reached.select(F.greatest("latest", F.lit(latest)).alias("latest"))
        reached.write.mode("overwrite").parquet(f"{output}/reached/batch_id={batch_id}")

    return run_available(events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


def metrics(spark: SparkSession, output: str, delay: str = INGEST_DELAY) -> DataFrame:
    """Totals per window with ``n_late`` and ``closed``: whether events have come from ``delay`` behind its end."""
    rows = spark.read.parquet(f"{output}/counts")
    kept = spark.read.parquet(f"{output}/reached")  # one row per batch
    reached = kept.agg((F.max("latest") - F.expr(f"interval {delay}")).alias("_reached"))
    totals = rows.groupBy("window_start", "window_end", "workspace_id", "event_type").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_events", "payload_bytes", "n_late")]
    )
    return totals.crossJoin(F.broadcast(reached)).withColumn("closed", F.col("window_end") <= F.col("_reached")).drop("_reached", "window_end")


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for the time of a run; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _micros(spark: SparkSession, span: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp '1970-01-01 00:00:00Z' + interval {span})").first()[0]


def task_lifecycle(
    starts: DataFrame, completions: DataFrame, output: str, checkpoint: str, timeout: str = "10 days",
    delay: str = INGEST_DELAY, keep: str = "30 days", buckets: int = TASK_BUCKETS,
) -> StreamingQuery:
    """Started tasks with their completion; without one in time they come out as timed out.

    A start's timer fires when the watermark is past its timeout.  The task's state stays
    ``keep`` longer: a completion that happened in time but arrives later comes out as a
    correction, the next ``revision`` of the task; ``task_outcomes`` gives the last one.
    A completion may also arrive before its start, by at most ``keep``.  Tasks that came
    out as neither are listed by ``open_tasks``, those without an id among them.  State is
    held per bucket of task ids; ``buckets`` is fixed for a checkpoint and grows with the
    tasks of one span.
    """
    spark = starts.sparkSession
    started = with_event_time(starts, "started_at").withWatermark("started_at", delay)
    finished = with_event_time(completions, "finished_at").withWatermark("finished_at", delay)
    kinds = {f.name: f.dataType.simpleString() for f in starts.schema}
    # as numbers, times no longer mark a row as late: the watermark moves timers but drops nothing
    rows = started.select("task_id", "task_type", F.unix_micros("started_at").alias("started_us"), F.lit(None).cast("bigint").alias("finished_us"))
    rows = rows.unionByName(finished.select(
        "task_id", F.lit(None).cast(kinds["task_type"]).alias("task_type"), F.lit(None).cast("bigint").alias("started_us"), F.unix_micros("finished_at").alias("finished_us")))
    processor = TaskLifecycle(_micros(spark, timeout), _micros(spark, keep))
    bucketed = rows.where("task_id IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("task_id"), F.lit(buckets)))
    told = bucketed.groupBy("bucket").transformWithStateInPandas(
        processor, OUTCOME_SCHEMA.format(id=kinds["task_id"], type=kinds["task_type"]), "Append", "EventTime")
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    outcomes = told.select(
        "task_id", "task_type", time("started_us").alias("started_at"), "outcome", ((F.col("finished_us") - F.col("started_us")) / 1000.0).alias("duration_ms"), "revision")
    with _state_store(spark):
        return run_available(
            outcomes.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
        )


def task_outcomes(spark: SparkSession, output: str) -> DataFrame:
    """The last revision of every task's outcome."""
    rows = spark.read.parquet(output)
    last = F.max_by(F.struct(*rows.columns), "revision")
    return rows.groupBy("task_id").agg(last.alias("r")).select("r.*").drop("revision")


def open_tasks(starts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Started tasks without an outcome so far."""
    return starts.join(outcomes.select("task_id"), "task_id", "left_anti")
