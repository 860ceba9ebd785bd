"""Task, multi-agent and evaluation analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engrama.functions.vectors import r6
from engrama.operators.numbering import dense_number, running_total
from engrama.session import join_null_safe


def task_summary(tasks: DataFrame, durations: DataFrame) -> DataFrame:
    """Per task type: open and finished tasks, success rate, mean duration of finished ones."""
    done = F.col("success").isNotNull()
    return tasks.join(durations, "task_id", "left").groupBy("task_type").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.count_if(~done).alias("n_open"), F.count_if(done).alias("n_done"),
        r6(F.avg(F.when(done, F.when(F.col("success"), 1.0).otherwise(0.0)))).alias("success_rate"),
        r6(F.avg(F.when(done, F.col("duration_ms")))).alias("mean_duration_ms"),
    )


def token_totals(steps: DataFrame, sessions: DataFrame) -> DataFrame:
    """Tokens per step of every session with the running total over its tasks and steps."""
    per_step = steps.groupBy("task_id", "step_index").agg(F.sum("tokens").alias("tokens"))
    placed = per_step.join(sessions.select("task_id", "session_id"), "task_id")
    return running_total(placed, ["session_id"], ["task_id", "step_index"], "tokens")


def claims(attempts: DataFrame) -> DataFrame:
    """Every claim, with whether it was the first for its task; one small struct per task is compared."""
    first = attempts.groupBy("task_id").agg(F.min(F.struct("claimed_at", "order_key", "agent_id")).alias("_first"))
    mine = F.struct("claimed_at", "order_key", "agent_id")
    return join_null_safe(attempts, first, ["task_id"]).withColumn("is_winner", mine == F.col("_first")).drop("_first")


def stage_progress(stages: DataFrame) -> DataFrame:
    """Stages reached of the declared total, and how many before the furthest were skipped."""
    distinct = stages.select("task_id", "stage_index", "total_stages").groupBy("task_id", "stage_index").agg(
        F.max("total_stages").alias("total_stages")
    )
    return distinct.groupBy("task_id").agg(
        (F.max("stage_index") + 1).cast("bigint").alias("reached"),
        F.max("total_stages").cast("bigint").alias("total_stages"),
        F.count(F.lit(1)).alias("n_seen"),
    ).withColumns({
        "n_skipped": F.col("reached") - F.col("n_seen"),
        "progress": r6(F.col("reached") / F.col("total_stages")),
    })


def plan_steps(steps: DataFrame) -> DataFrame:
    """Step counts per plan, and the share of its repairs that worked."""
    return steps.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n_steps"), F.count_if(F.col("is_repair")).alias("n_repairs"),
        r6(F.avg(F.when(F.col("is_repair"), F.when(F.col("repaired"), 1.0).otherwise(0.0)))).alias("repair_success"),
    )


def answer_consistency(scores: DataFrame) -> DataFrame:
    return scores.groupBy("session_id").agg(
        F.count("score").alias("n_scores"), r6(F.avg("score")).alias("mean_score"), F.min("score").alias("min_score")
    )


def handoffs(turns: DataFrame) -> DataFrame:
    """Counts of (from agent, to agent) between neighbouring turns.

    Turns are numbered densely, so gaps in their own numbers don't matter and the
    previous turn is an equi-join on the number before; unlike a lag window this
    does not gather a long session.
    """
    placed = dense_number(turns.select("session_id", "seq", "agent_id"), ["seq", "agent_id"], ["session_id"], "_i")
    earlier = placed.select("session_id", (F.col("_i") + 1).alias("_i"), F.col("agent_id").alias("from_agent_id"))
    return join_null_safe(placed, earlier, ["session_id", "_i"]).groupBy(
        "from_agent_id", F.col("agent_id").alias("to_agent_id")
    ).agg(F.count(F.lit(1)).alias("n_handoffs"))


def store_metrics(events: DataFrame, storage: bool = False) -> DataFrame:
    """Counts per workspace and event type; with ``storage`` also payload sizes."""
    measures = [F.count(F.lit(1)).alias("n_events"), F.count_distinct("agent_id").alias("n_agents")]
    if storage:
        size = F.octet_length("payload")
        measures += [F.sum(size).cast("bigint").alias("payload_bytes"), F.max(size).alias("largest_payload")]
        # exact, from counts per distinct size, which are few
        measures += [r6(F.percentile(size, p)).alias(f"payload_p{round(100 * p)}") for p in (0.5, 0.95)]
    return events.groupBy("workspace_id", "event_type").agg(*measures)


def visible_to(shared: DataFrame, requester: str) -> DataFrame:
    """Ids of the memories a requester may see, to be searched in; cutting hits down later would lose some."""
    return shared.where(F.col("viewer_agent_id") == requester).select("memory_id").distinct()


def aggregate_across_agents(hits_by_agent: DataFrame, k: int) -> DataFrame:
    """The best memories over all source agents, keeping the source; the hits are among visible memories already."""
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "memory_id")
    ranked = hits_by_agent.drop("rank").withColumn("rank", F.row_number().over(ranking).cast("bigint"))
    return ranked.where(F.col("rank") <= k)


def source_agents(hits: DataFrame) -> DataFrame:
    """``(query_id, source_agent_id, n_hits)``: which agents' memories an aggregate came from, as rows."""
    return hits.groupBy("query_id", F.col("agent_id").alias("source_agent_id")).agg(F.count(F.lit(1)).alias("n_hits"))


def retrieval_eval(retrieved: DataFrame, truth: DataFrame) -> DataFrame:
    """Recall per task: the share of expected ids that were retrieved, and whether any was."""
    found = truth.join(
        retrieved.select("task_id", "object_id").distinct().withColumn("_found", F.lit(1)), ["task_id", "object_id"], "left"
    )
    return found.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n_expected"), F.count("_found").alias("n_found"),
    ).withColumns({
        "recall": r6(F.col("n_found") / F.col("n_expected")), "hit": F.col("n_found") > 0,
    })
