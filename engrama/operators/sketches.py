"""Stored metrics per window that can be merged: distinct agents and payload sizes of any range without the events.

A window's row holds counts and two sketches.  Rows of any number of windows, batches or
tables merge into one, so a day is read as its 24 hours and a late batch is one more row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.defaults import AGENT_SKETCH_BITS, SIZE_SKETCH_K

KEYS = ("workspace_id", "event_type")


def sketched(events: DataFrame, unit: str = "day", time: str = "event_time") -> DataFrame:
    """One row per window (a ``date_trunc`` unit), workspace and type.

    Events without a time are a window of their own, null.  Null agents are counted as
    events but not as agents; null payloads have no size.
    """
    size = F.octet_length("payload").cast("bigint")
    start = F.date_trunc(unit, time).cast("timestamp_ntz").alias("window_start")
    return events.groupBy(start, *KEYS).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(size).alias("payload_bytes"),
        F.hll_sketch_agg("agent_id", AGENT_SKETCH_BITS).alias("agents"), F.kll_sketch_agg_bigint(size, SIZE_SKETCH_K).alias("sizes"),
    )


def merged(stored: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``sketched`` with equal keys as one row, which can be merged again."""
    return stored.groupBy(*keys).agg(
        F.sum("n_events").alias("n_events"), F.sum("payload_bytes").alias("payload_bytes"),
        F.hll_union_agg("agents").alias("agents"), F.kll_merge_agg_bigint("sizes").alias("sizes"),
    )


def of_range(stored: DataFrame, start: Column, end: Column, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Metrics per workspace and type of the windows that start in ``[start, end)``; distinct agents and quantiles are estimates.

    Agents are off by about ``1.04 / sqrt(2 ** AGENT_SKETCH_BITS)``, a quantile's rank by about
    ``1.7 / SIZE_SKETCH_K``; without payloads a quantile is null.
    """
    wanted = stored.where((F.col("window_start") >= start) & (F.col("window_start") < end))
    filled = F.kll_sketch_get_n_bigint("sizes") > 0
    return merged(wanted, *KEYS).select(
        *KEYS, "n_events", "payload_bytes", F.hll_sketch_estimate("agents").alias("n_agents"),
        *[F.when(filled, F.kll_sketch_get_quantile_bigint("sizes", F.lit(q))).alias(f"payload_p{round(100 * q)}") for q in quantiles],
    )
