"""Streaming jobs run to the end of the test tables; each returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.plans.ingest_queries import _log, _redelivered
from engrama.plans.registry import query
from engrama.plans.views import Tables
from engrama.session import work_dir
from engrama.sources import wal_stream
from engrama.streaming import jobs


def _stream_of(t: Tables, rows: DataFrame, label: str) -> DataFrame:
    """A table written to a fresh folder and read as a stream."""
    path = work_dir(t.spark, label)
    rows.write.parquet(path)
    return jobs.table_stream(t.spark, path, rows.schema)


def _folders(t: Tables, label: str) -> tuple[str, str]:
    return work_dir(t.spark, f"{label}-out"), work_dir(t.spark, f"{label}-state")


@query("""
WITH m AS (SELECT CAST(floor(median(lsn)) AS BIGINT) AS from_lsn FROM fx_events)
SELECT lsn, event_id, event_type FROM fx_events, m WHERE lsn >= from_lsn
""")
def stream_wal_tail(t: Tables) -> DataFrame:
    """The log followed from its middle."""
    middle = t.fx_events.agg(F.floor(F.median("lsn")).cast("bigint")).first()[0]
    output, state = _folders(t, "tail")
    jobs.wal_tail(wal_stream.follow(t.spark, _log(t)), output, state, from_lsn=middle)
    return t.spark.read.parquet(output).select(
        "lsn", F.get_json_object("event", "$.event_id").alias("event_id"),
        F.get_json_object("event", "$.event_type").alias("event_type"),
    )


@query("""
SELECT event_id, workspace_id, event_type, event_time FROM fx_events
""")
def stream_ingest_dedup(t: Tables) -> DataFrame:
    """An event stream in which every purchase is delivered twice."""
    twice = t.fx_events.unionByName(t.fx_events.where("event_type = 'purchase'"))
    output, state = _folders(t, "dedup")
    jobs.deduplicated_ingest(_stream_of(t, twice, "events"), output, state)
    return jobs.ingested(t.spark, output).select("event_id", "workspace_id", "event_type", "event_time")


@query("""
SELECT concat('mem_', event_id) AS memory_id, workspace_id,
       CASE WHEN event_type = 'purchase' THEN importance + 1 ELSE importance END AS importance,
       CASE WHEN event_type = 'purchase' THEN version + 1 ELSE version END AS version, event_time
FROM fx_events
""")
def stream_materialize(t: Tables) -> DataFrame:
    """Memories kept up to date from a stream with second versions of all purchases."""
    output, state = _folders(t, "memory")
    jobs.materialization(_stream_of(t, _redelivered(t), "events"), output, state)
    return jobs.current_memory(t.spark, output).select("memory_id", "workspace_id", "importance", "version", "event_time")


@query("""
WITH w AS (SELECT date_trunc('day', event_time) AS window_start, workspace_id, event_type, count(*) AS n_events,
                  CAST(sum(strlen(payload)) AS BIGINT) AS payload_bytes FROM fx_events GROUP BY 1, 2, 3)
SELECT *, 0::bigint AS n_late, window_start + interval 1 day <= (SELECT max(event_time) - interval 1 hour FROM fx_events) AS closed FROM w
""")
def stream_metrics(t: Tables) -> DataFrame:
    """Daily counts of all days, closed and open."""
    output, state = _folders(t, "metrics")
    jobs.window_metrics(_stream_of(t, t.fx_events, "events"), output, state)
    return jobs.metrics(t.spark, output)


_OUTCOMES = """
s AS (SELECT task_id, task_type, started_at FROM fx_tasks),
f AS (SELECT o_orderkey AS task_id, o_orderdate + to_hours(CAST(floor(o_totalprice / 1000) AS INTEGER)) AS finished_at
      FROM orders WHERE o_orderstatus <> 'O'),
w AS (SELECT least((SELECT max(started_at) FROM s), (SELECT max(finished_at) FROM f)) - interval 1 hour AS mark),
j AS (SELECT s.*, finished_at FROM s LEFT JOIN f ON s.task_id = f.task_id AND finished_at <= started_at + interval 10 day)"""


def _task_stream(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Starts and outcomes of orders as tasks; the dearer an order, the longer it takes, and some take too long."""
    starts = t.fx_tasks.select("task_id", "task_type", "started_at")
    hours = F.make_dt_interval(hours=F.floor(F.col("o_totalprice") / 1000).cast("int"))
    completions = t.orders.where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("task_id"), (F.col("o_orderdate") + hours).alias("finished_at")
    )
    output, state = _folders(t, "tasks")
    jobs.task_lifecycle(_stream_of(t, starts, "starts"), _stream_of(t, completions, "completions"), output, state)
    return starts, jobs.task_outcomes(t.spark, output)


@query(f"""
WITH {_OUTCOMES}
SELECT task_id, task_type, started_at, CASE WHEN finished_at IS NULL THEN 'timed_out' ELSE 'completed' END AS outcome,
       (epoch_us(finished_at) - epoch_us(started_at)) / 1000.0::double AS duration_ms
FROM j, w WHERE finished_at IS NOT NULL OR started_at + interval 10 day < mark
""")
def stream_task_lifecycle(t: Tables) -> DataFrame:
    """Orders as tasks: completed or timed out."""
    return _task_stream(t)[1]


@query(f"""
WITH {_OUTCOMES}
SELECT task_id, task_type, started_at FROM j, w WHERE NOT coalesce(finished_at IS NOT NULL OR started_at + interval 10 day < mark, false)
""")
def stream_open_tasks(t: Tables) -> DataFrame:
    """The tasks that are neither so far."""
    return jobs.open_tasks(*_task_stream(t))
