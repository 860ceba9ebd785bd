"""Bulk load of vector files into the event log: scan, build one event per row, append."""

from __future__ import annotations

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import DEFAULT_TENANT
from engrama.operators.ingest import EVENT_TEXT_FORMAT, event_slug_id, file_stem
from engrama.sources import fbin


def new_import_batch_id() -> str:
    """A fresh id for one load: the day it began and a random part."""
    return f"load-{dt.date.today():%Y-%m-%d}-{uuid.uuid4().hex}"


@F.pandas_udf(T.StringType())
def _printed(values: pd.Series) -> pd.Series:
    """Values at full double precision, joined by blanks."""
    return pd.Series([" ".join(map(repr, v.astype(float).tolist())) for v in values])


def vector_events(
    rows: DataFrame,
    dataset: str,
    workspace_id: str,
    import_batch_id: str,
    tenant_id: str = DEFAULT_TENANT,
    agent_id: str = "bulk_loader",
    session_id: str = "",
    event_type: str = "dataset_record",
    source: str = "bulk_load",
    version: int = 1,
    event_id_scope: str = "file",
    preview_k: int = 8,
) -> DataFrame:
    """Rows of vector files as events; ids come from dataset, file and row, so a repeat load gives the same ids."""
    name = F.col("file_name")
    batch = F.lit(import_batch_id) if event_id_scope == "batch" else None
    session = F.lit(session_id.strip()) if session_id.strip() else F.concat(F.lit(f"ingest_{dataset}_"), name)
    head = _printed(F.slice("vector", 1, preview_k)) if preview_k > 0 else F.lit("")  # the rest of a vector stays in the JVM
    text = F.format_string(EVENT_TEXT_FORMAT, name, F.lit(dataset), F.col("row_index"), F.col("dim"), head)
    stamp = F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz")
    return rows.select(
        event_slug_id(F.lit(dataset), file_stem(name), F.col("row_index"), batch).alias("event_id"),
        F.lit(tenant_id).alias("tenant_id"), F.lit(workspace_id).alias("workspace_id"),
        F.lit(agent_id).alias("agent_id"), session.alias("session_id"), F.lit(event_type).alias("event_type"),
        stamp.alias("event_time"), stamp.alias("ingest_time"), stamp.alias("visible_time"),
        F.col("vector").alias("embedding_vector"),
        F.struct(
            text.alias("text"), F.lit(dataset).alias("dataset"), name.alias("file_name"),
            F.col("row_index"), F.col("dim"), F.lit("float32").alias("dtype"),
            F.lit("bulk_dataset").alias("ingest_mode"), F.lit(import_batch_id).alias("import_batch_id"),
        ).alias("payload"),
        F.lit(source).alias("source"), F.lit(version).alias("version"),
    )


def bulk_upload(
    spark: SparkSession,
    dataset: str,
    workspace_id: str,
    path: str,
    table_path: str,
    limit: int = 0,
    dry_run: bool = False,
    import_batch_id: str = "",
    **event_fields,
) -> int:
    """Append the events of a vector file or folder to ``table_path``; returns the number of rows written.

    A dry run reads one row, writes nothing and returns 1, or 0 for an empty file.
    """
    if dry_run:
        return fbin.read(spark, path, limit=1).limit(1).count()
    rows = fbin.read(spark, path, limit=max(0, limit))
    batch_id = import_batch_id.strip() or new_import_batch_id()
    written = Observation()
    events = vector_events(rows, dataset, workspace_id, batch_id, **event_fields)
    events.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(table_path)
    return written.get["n"]
