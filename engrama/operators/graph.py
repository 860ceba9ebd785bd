"""Object tables and graph work: traces, evidence, session context, pending tool calls, sharing."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engrama.defaults import CONTEXT_EVENTS
from engrama.operators.filters import only_of
from engrama.operators.ingest import document_chunks
from engrama.operators.numbering import pinned_segments
from engrama.session import join_null_safe, materialize


def proof_trace(roots: DataFrame, edges: DataFrame, max_depth: int | None = None, root: str = "root_id") -> DataFrame:
    """``(root, node_id, depth)``: everything reachable along edges, at its smallest depth, up to ``max_depth`` if given.

    Breadth-first over pairs of a root and a node: each level is one join of the
    frontier with the edges, pinned by a checkpoint so that later levels do not repeat
    earlier joins.  Nodes seen before are dropped, so cycles end, and the loop stops at an
    empty frontier.  Once the frontier holds at most half as many nodes as roots, these
    nodes become the roots of a trace of their own, and that is joined to the frontier:
    a path that many roots share is walked once, however many they are.  A null root
    reaches itself only; edges with a null end lead nowhere.
    """
    starts = roots.select(F.col(root).alias("_root")).distinct()
    links = edges.where("src_id IS NOT NULL AND dst_id IS NOT NULL").select(F.col("src_id").alias("node_id"), "dst_id")
    return _trace(starts, links, max_depth).withColumnRenamed("_root", root)


def _trace(starts: DataFrame, links: DataFrame, max_depth: int | None) -> DataFrame:
    seen = starts.select("_root", F.col("_root").alias("node_id"), F.lit(0).cast("bigint").alias("depth"))
    frontier = seen
    for depth in count(1):
        if max_depth is not None and depth > max_depth:
            return seen
        reached = frontier.join(links, "node_id").select("_root", F.col("dst_id").alias("node_id")).distinct()
        if depth == 1:  # a root has seen itself only
            fresh = reached.where(F.col("node_id") != F.col("_root"))
        else:
            fresh = reached.join(seen.select("_root", "node_id"), ["_root", "node_id"], "left_anti")
        frontier = materialize(fresh.withColumn("depth", F.lit(depth).cast("bigint")))
        # estimates serve: both ways to go on give the same rows
        n_pairs, n_roots, n_nodes = frontier.agg(
            F.count(F.lit(1)), F.approx_count_distinct("_root"), F.approx_count_distinct("node_id")
        ).first()
        if not n_pairs:
            return seen
        if 2 * n_nodes <= n_roots:
            break
        seen = seen.unionByName(frontier)
    shared = frontier.select(F.col("node_id").alias("_root")).distinct()
    onward = _trace(shared, links, None if max_depth is None else max_depth - depth).select(
        F.col("_root").alias("_via"), F.col("node_id").alias("_next"), F.col("depth").alias("_further")
    )
    joined = frontier.join(onward, F.col("node_id") == F.col("_via")).select(
        "_root", F.col("_next").alias("node_id"), (F.col("depth") + F.col("_further")).alias("depth")
    )
    return seen.unionByName(joined).groupBy("_root", "node_id").agg(F.min("depth").alias("depth"))


def evidence(
    hits: DataFrame, texts: DataFrame, edges: DataFrame, id_column: str, text: str, object_column: str
) -> DataFrame:
    """One row per piece of evidence of every hit: chunk texts in order, then trace nodes by depth."""
    hits = materialize(hits)
    hit_texts = only_of(texts, hits, id_column)
    chunks = document_chunks(hit_texts, [id_column], text).select(
        id_column, F.lit("chunk").alias("evidence_kind"), F.col("segment_index").alias("position"),
        F.col("chunk").alias("evidence"),
    )
    trace = proof_trace(hits.select(F.col(object_column).alias("root_id")), edges).where("depth > 0").select(
        F.col("root_id").alias(object_column), F.lit("trace").alias("evidence_kind"),
        F.col("depth").alias("position"), F.col("node_id").alias("evidence"),
    )
    return hits.join(chunks, id_column).unionByName(hits.join(trace, object_column))


def session_context(events: DataFrame, last_n: int = CONTEXT_EVENTS, order: str = "seq", agent_id: str = "") -> DataFrame:
    """The last events of every session, numbered oldest first."""
    if agent_id:
        events = events.where(F.col("agent_id") == agent_id)
    newest = Window.partitionBy("session_id").orderBy(F.desc(order))
    kept = events.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= last_n)
    oldest = Window.partitionBy("session_id").orderBy(order)  # at most last_n rows each
    return kept.withColumn("position", F.row_number().over(oldest).cast("bigint")).drop("_back")


def pending_calls(events: DataFrame, call_type: str, result_type: str, time: str = "event_time") -> DataFrame:
    """Calls with no later result in the same session.

    "A later result exists" means the session's last result is later, so one
    aggregated row per session replaces the inequality join.
    """
    last_result = events.where(F.col("event_type") == result_type).groupBy("session_id").agg(
        F.max(time).alias("_last_result")
    )
    calls = events.where(F.col("event_type") == call_type).join(last_result, "session_id", "left")
    return calls.where(F.col("_last_result").isNull() | (F.col("_last_result") <= F.col(time))).drop("_last_result")


def matched_results(
    events: DataFrame, call_type: str, result_type: str, time: str = "event_time", id_column: str = "event_id"
) -> DataFrame:
    """Every call with the first later result of its session, ties to the smaller id, and the wait in milliseconds.

    An as-of match without a join of calls and results: both lie newest first in range
    partitions of session and time, so a session holding a third of all events spreads over
    many tasks; each task carries the earliest result so far, and one row per partition and
    session carries it on.  Calls without a session, a time or a later result keep null.
    """
    called = F.col("event_type") == call_type
    both = events.where(called | ((F.col("event_type") == result_type) & F.col("session_id").isNotNull() & F.col(time).isNotNull()))
    newest_first = both.select(
        F.col(id_column).alias("_id"), "session_id", F.col(time).alias("_time"), called.alias("_call"),
        (-F.unix_micros(F.col(time).cast("timestamp"))).alias("_back"), F.when(called, 0).otherwise(1).alias("_last"),
    )
    # at one time calls come before results, which are not later
    laid_out = pinned_segments(newest_first, ["session_id"], ["_back", "_last"])
    result = F.when(~F.col("_call"), F.struct(F.col("_time").alias("time"), F.col("_id").alias("id")))
    inside = Window.partitionBy("_segment", "session_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    local = laid_out.withColumn("_here", F.min(result).over(inside)).where("_call")
    earlier = Window.partitionBy("session_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = laid_out.groupBy("_segment", "session_id").agg(F.min(result).alias("_first")).select(
        "_segment", "session_id", F.min("_first").over(earlier).alias("_carried")
    )
    found = join_null_safe(local, carried, ["_segment", "session_id"])
    match = F.when(F.col("_time").isNotNull(), F.coalesce("_here", "_carried"))
    wait = (F.unix_micros(F.col("_m.time").cast("timestamp")) - F.unix_micros(F.col("_time").cast("timestamp"))) / 1000.0
    return found.withColumn("_m", match).select(
        F.col("_id").alias(id_column), "session_id", F.col("_time").alias(time), F.col("_m.id").alias("result_id"),
        F.col("_m.time").alias("result_time"), wait.alias("wait_ms"),
    )


def shared_view(memory: DataFrame, contracts: DataFrame) -> DataFrame:
    """Who can see which memory: owners their own, grantees what a contract covers in its workspace."""
    granted = contracts.where(F.col("owner_agent_id") != F.col("grantee_agent_id")).select(
        F.col("owner_agent_id").alias("agent_id"), "workspace_id", F.col("grantee_agent_id").alias("viewer_agent_id")
    ).distinct()
    own = memory.withColumn("viewer_agent_id", F.col("agent_id"))
    # contracts are distinct and never name the owner as grantee, so the union holds no duplicates
    return own.unionByName(memory.join(granted, ["agent_id", "workspace_id"]))
