"""Object tables, graph work and task analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.operators import filters, graph, ingest, sketches, tasks
from engrama.operators import text_search as ts
from engrama.operators import vector_search as vs
from engrama.plans.registry import query
from engrama.plans.text_queries import OVERLAP, QTERMS, WEIGHTS
from engrama.plans.views import Tables
from engrama.session import work_dir

# --- object tables: list, create or replace ---------------------------------


def _replaced(table: DataFrame, keys: list[str], column: str, value, when) -> DataFrame:
    """The table after some of its rows were posted again with a changed column."""
    stored = table.withColumn("_posted", F.lit(0))
    posted = table.where(when).withColumns({column: value, "_posted": F.lit(1)})
    return ingest.upsert_latest(stored, posted, keys, [F.desc("_posted")]).drop("_posted")


@query("""
SELECT agent_id, CASE WHEN role = 'MACHINERY' THEN 'planner' ELSE role END AS role, workspace_id, tenant_id FROM fx_agents
""")
def agents_table(t: Tables) -> DataFrame:
    """Agents of one role re-registered under another."""
    return _replaced(t.fx_agents, ["agent_id"], "role", F.lit("planner"), F.col("role") == "MACHINERY")


@query("""
SELECT session_id, max(seq) + 1 AS n_turns,
       CASE WHEN max(seq) >= 5 THEN 'long' ELSE 'open' END AS status FROM fx_turns GROUP BY 1
""")
def sessions_table(t: Tables) -> DataFrame:
    sessions = t.fx_turns.groupBy("session_id").agg((F.max("seq") + 1).alias("n_turns")).withColumn("status", F.lit("open"))
    return _replaced(sessions, ["session_id"], "status", F.lit("long"), F.col("n_turns") >= 6)


@query("""
SELECT state_key, state_id, state_value, event_time FROM fx_states
QUALIFY row_number() OVER (PARTITION BY state_key ORDER BY event_time DESC, state_id DESC) = 1
""")
def states_table(t: Tables) -> DataFrame:
    """The current state of every key."""
    nothing = t.fx_states.where("false")
    return ingest.upsert_latest(t.fx_states, nothing, ["state_key"], [F.desc("event_time"), F.desc("state_id")])


@query("""
SELECT page_id AS artifact_id, CASE WHEN url LIKE 'http:%' THEN concat('https', substring(url, 5)) ELSE url END AS uri,
       length(html) AS size FROM pages
""")
def artifacts_table(t: Tables) -> DataFrame:
    """Page artifacts, those on plain http posted again with a secure address."""
    artifacts = t.pages.select(
        F.col("page_id").alias("artifact_id"), F.col("url").alias("uri"), F.length("html").cast("bigint").alias("size")
    )
    secure = F.concat(F.lit("https"), F.substring("uri", 5, 1 << 30))
    return _replaced(artifacts, ["artifact_id"], "uri", secure, F.col("uri").startswith("http:"))


@query("""
SELECT src_id, dst_id, CASE WHEN edge_type = 'part_of' THEN 'located_in' ELSE edge_type END AS edge_type FROM fx_edges
""")
def edges_table(t: Tables) -> DataFrame:
    return _replaced(t.fx_edges, ["src_id", "dst_id"], "edge_type", F.lit("located_in"), F.col("edge_type") == "part_of")


@query("""
SELECT object_id, CASE WHEN workspace_id = 'en' THEN 'review' ELSE effect END AS effect
FROM fx_policies JOIN fx_memory ON memory_id = object_id
""")
def policies_table(t: Tables) -> DataFrame:
    english = t.fx_memory.where("workspace_id = 'en'").select(F.col("memory_id").alias("object_id"))
    known = t.fx_memory.select(F.col("memory_id").alias("object_id"))
    posted = t.fx_policies.join(english, "object_id", "left_semi").select("object_id", F.lit("review").alias("effect"))
    stored = t.fx_policies.join(known, "object_id", "left_semi")
    return ingest.upsert_latest(
        stored.withColumn("_posted", F.lit(0)), posted.withColumn("_posted", F.lit(1)), ["object_id"], [F.desc("_posted")]
    ).drop("_posted")


@query("""
SELECT DISTINCT owner_agent_id, grantee_agent_id, workspace_id FROM fx_share_contracts
""")
def share_contracts_table(t: Tables) -> DataFrame:
    """Contracts by their whole key; repeated posts of one contract leave one row."""
    keys = ["owner_agent_id", "grantee_agent_id", "workspace_id"]
    return ingest.upsert_latest(t.fx_share_contracts, t.fx_share_contracts, keys, [F.col("owner_agent_id")])


# --- graph ------------------------------------------------------------------


@query("""
WITH RECURSIVE tr AS (
  SELECT concat('o_', o_orderkey) AS root_id, concat('o_', o_orderkey) AS node_id, 0 AS depth FROM orders
  UNION ALL SELECT root_id, dst_id, depth + 1 FROM tr JOIN fx_edges ON src_id = node_id WHERE depth < 6)
SELECT root_id, node_id, CAST(min(depth) AS BIGINT) AS depth FROM tr GROUP BY 1, 2
""")
def proof_trace(t: Tables) -> DataFrame:
    """Traces of all orders: customer, nation, region."""
    roots = t.orders.select(F.concat(F.lit("o_"), "o_orderkey").alias("root_id"))
    return graph.proof_trace(roots, t.fx_edges)


@query("""
SELECT agent_id, role, workspace_id, tenant_id FROM fx_agents WHERE role = 'BUILDING' AND tenant_id = 'ASIA'
""")
def agent_list(t: Tables) -> DataFrame:
    return filters.listed(t.fx_agents, {"role": "BUILDING", "tenant_id": "ASIA"}, None, "agent_id")


@query("""
WITH k AS (SELECT * FROM fx_events QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY lsn DESC) <= 2)
SELECT session_id, event_id, event_type, row_number() OVER (PARTITION BY session_id ORDER BY lsn) AS position FROM k
""")
def session_context(t: Tables) -> DataFrame:
    """The last two events of every session."""
    return graph.session_context(t.fx_events, 2, order="lsn").select("session_id", "event_id", "event_type", "position")


@query("""
SELECT c.event_id, c.session_id, c.agent_id, c.event_time FROM fx_events c WHERE event_type = 'click' AND NOT EXISTS (
  SELECT 1 FROM fx_events r WHERE r.event_type = 'purchase' AND r.session_id = c.session_id AND r.event_time > c.event_time)
""")
def tool_state_pending(t: Tables) -> DataFrame:
    pending = graph.pending_calls(t.fx_events, "click", "purchase")
    return pending.select("event_id", "session_id", "agent_id", "event_time")


@query("""
SELECT c.event_id, c.session_id, c.event_time, r.event_id AS result_id, r.event_time AS result_time,
       (epoch_us(r.event_time) - epoch_us(c.event_time)) / 1000.0::double AS wait_ms
FROM (SELECT * FROM fx_events WHERE event_type = 'click') c LEFT JOIN (SELECT * FROM fx_events WHERE event_type = 'purchase') r
ON r.session_id = c.session_id AND r.event_time > c.event_time
QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY r.event_time, r.event_id) = 1
""")
def tool_call_results(t: Tables) -> DataFrame:
    """Every click with the first later purchase of its session and the wait."""
    return graph.matched_results(t.fx_events, "click", "purchase")


# --- tasks ------------------------------------------------------------------


@query("""
WITH d AS (SELECT l_orderkey AS task_id, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1),
j AS (SELECT t.*, (epoch_us(shipped) - epoch_us(started_at)) / 1000.0::double AS ms FROM fx_tasks t LEFT JOIN d USING (task_id))
SELECT task_type, count(*) AS n_tasks, count(*) FILTER (success IS NULL) AS n_open,
       count(*) FILTER (success IS NOT NULL) AS n_done,
       round(avg(CASE WHEN success THEN 1.0::double WHEN NOT success THEN 0.0::double END), 6) AS success_rate,
       round(avg(ms) FILTER (success IS NOT NULL), 6) AS mean_duration_ms
FROM j GROUP BY 1
""")
def task_summary(t: Tables) -> DataFrame:
    """Orders as tasks, finished by their last shipment."""
    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp"))

    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("task_id")).agg(F.max("l_shipdate").alias("shipped"))
    durations = shipped.join(t.fx_tasks.select("task_id", "started_at"), "task_id").select(
        "task_id", ((micros("shipped") - micros("started_at")) / 1000.0).alias("duration_ms")
    )
    return tasks.task_summary(t.fx_tasks, durations)


@query("""
WITH p AS (SELECT task_id, step_index, sum(tokens) AS tokens FROM fx_task_steps GROUP BY 1, 2)
SELECT session_id, task_id, step_index, tokens,
       sum(tokens) OVER (PARTITION BY session_id ORDER BY task_id, step_index ROWS UNBOUNDED PRECEDING) AS running_total
FROM p JOIN fx_tasks USING (task_id)
""")
def task_tokens(t: Tables) -> DataFrame:
    totals = tasks.token_totals(t.fx_task_steps, t.fx_tasks)
    return totals.select("session_id", "task_id", "step_index", "tokens", "running_total")


@query("""
SELECT l_orderkey AS task_id, l_suppkey AS agent_id, l_shipdate AS claimed_at, l_linenumber AS order_key,
       (l_shipdate, l_linenumber, l_suppkey) = min((l_shipdate, l_linenumber, l_suppkey)) OVER (PARTITION BY l_orderkey)
       AS is_winner
FROM lineitem
""")
def task_claims(t: Tables) -> DataFrame:
    """Suppliers claiming orders; the earliest shipment wins."""
    attempts = t.lineitem.select(
        F.col("l_orderkey").alias("task_id"), F.col("l_suppkey").alias("agent_id"),
        F.col("l_shipdate").alias("claimed_at"), F.col("l_linenumber").alias("order_key"),
    )
    return tasks.claims(attempts)


@query("""
WITH s AS (SELECT DISTINCT task_id, step_index - 1 AS stage_index FROM fx_task_steps)
SELECT task_id, CAST(max(stage_index) + 1 AS BIGINT) AS reached, CAST(7 AS BIGINT) AS total_stages, count(*) AS n_seen,
       max(stage_index) + 1 - count(*) AS n_skipped, round((max(stage_index) + 1) / 7.0::double, 6) AS progress
FROM s GROUP BY 1
""")
def task_stage_progress(t: Tables) -> DataFrame:
    """Order lines as stages of seven."""
    stages = t.fx_task_steps.select(
        "task_id", (F.col("step_index") - 1).alias("stage_index"), F.lit(7).alias("total_stages")
    )
    return tasks.stage_progress(stages)


@query("""
SELECT l_orderkey AS task_id, count(*) AS n_steps, count(*) FILTER (l_returnflag = 'R') AS n_repairs,
       round(avg(CASE WHEN l_linestatus = 'F' THEN 1.0::double ELSE 0.0::double END) FILTER (l_returnflag = 'R'), 6)
       AS repair_success
FROM lineitem GROUP BY 1
""")
def plan_steps(t: Tables) -> DataFrame:
    """Order lines as plan steps, returned ones being repairs."""
    steps = t.lineitem.select(
        F.col("l_orderkey").alias("task_id"), (F.col("l_returnflag") == "R").alias("is_repair"),
        (F.col("l_linestatus") == "F").alias("repaired"),
    )
    return tasks.plan_steps(steps)


@query("""
SELECT session_id, count(importance) AS n_scores, round(avg(importance), 6) AS mean_score, min(importance) AS min_score
FROM fx_events GROUP BY 1
""")
def answer_consistency(t: Tables) -> DataFrame:
    return tasks.answer_consistency(t.fx_events.select("session_id", F.col("importance").alias("score")))


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP},
vis AS (SELECT memory_id FROM fx_memory WHERE agent_id = 'a_2'
        UNION SELECT memory_id FROM fx_memory m JOIN fx_share_contracts c
        ON owner_agent_id = agent_id AND c.workspace_id = m.workspace_id WHERE grantee_agent_id = 'a_2'),
ha AS (SELECT * FROM sc JOIN (SELECT memory_id, agent_id FROM fx_memory SEMI JOIN vis USING (memory_id)) USING (memory_id)
       QUALIFY row_number() OVER (PARTITION BY query_id, agent_id ORDER BY score DESC, memory_id) <= 5)
SELECT query_id, agent_id, memory_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank FROM ha)
WHERE rank <= 5
""")
def mas_aggregate(t: Tables) -> DataFrame:
    """For one requester: the best of every source agent among what the requester may see."""
    seen = tasks.visible_to(graph.shared_view(t.fx_memory, t.fx_share_contracts), "a_2")
    visible = t.fx_memory.join(seen, "memory_id", "left_semi")
    hits = ts.text_search(t.fx_queries, visible, k=5, within=["agent_id"], corpus=t.fx_memory)
    return tasks.aggregate_across_agents(hits, 5)


@query("""
WITH l AS (SELECT agent_id, lag(agent_id) OVER (PARTITION BY session_id ORDER BY seq) AS prev FROM fx_turns)
SELECT prev AS from_agent_id, agent_id AS to_agent_id, count(*) AS n_handoffs FROM l WHERE prev IS NOT NULL GROUP BY 1, 2
""")
def handoff_matrix(t: Tables) -> DataFrame:
    return tasks.handoffs(t.fx_turns)


@query("""
SELECT workspace_id, event_type, count(*) AS n_events, count(DISTINCT agent_id) AS n_agents,
       CAST(sum(strlen(payload)) AS BIGINT) AS payload_bytes, CAST(max(strlen(payload)) AS INTEGER) AS largest_payload,
       round(quantile_cont(strlen(payload)::double, 0.5), 6) AS payload_p50, round(quantile_cont(strlen(payload)::double, 0.95), 6) AS payload_p95
FROM fx_events GROUP BY 1, 2
""")
def store_metrics(t: Tables) -> DataFrame:
    return tasks.store_metrics(t.fx_events, storage=True)


@query(name="metrics_of_range")
def metrics_of_range(t: Tables) -> DataFrame:
    """The second half of all days from stored sketches; estimates, so it has no SQL."""
    path = work_dir(t.spark, "sketches")
    sketches.sketched(t.fx_events).write.parquet(path)
    stored = t.spark.read.parquet(path)
    ends = stored.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
    return sketches.of_range(stored, F.lit(ends.first + (ends.last - ends.first) / 2), F.lit(ends.last))


_EXACT = """
v AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM
      (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
s AS (SELECT q.vec_id AS task_id, b.vec_id AS object_id, q.label = b.label AS same,
             CASE WHEN q.n * b.n = 0 THEN 0 ELSE round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) + 0.0 END AS score
      FROM v q, v b),
truth AS (SELECT task_id, object_id FROM s QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY score DESC, object_id) <= 10)"""


def _truth(t: Tables) -> DataFrame:
    queries = t.embeddings.select(F.col("vec_id").alias("task_id"), F.col("embedding").alias("query_vector"))
    exact = vs.top_k(queries, t.embeddings, k=10, query_id="task_id", base_id="vec_id")
    return exact.select("task_id", F.col("vec_id").alias("object_id"))


@query(f"""
WITH {_EXACT}
SELECT task_id, object_id AS expected FROM truth
""")
def ground_truth(t: Tables) -> DataFrame:
    """Expected answers registered twice; the second registration replaces the first."""
    truth = _truth(t).withColumnRenamed("object_id", "expected")
    stored = truth.withColumn("_posted", F.lit(0))
    again = truth.withColumn("_posted", F.lit(1))
    return ingest.upsert_latest(stored, again, ["task_id", "expected"], [F.desc("_posted")]).drop("_posted")


@query(f"""
WITH {_EXACT},
got AS (SELECT task_id, object_id FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY score DESC, object_id) <= 10)
SELECT task_id, count(*) AS n_expected, count(got.object_id) AS n_found,
       round(count(got.object_id) / count(*)::double, 6) AS recall, count(got.object_id) > 0 AS hit
FROM truth LEFT JOIN got USING (task_id, object_id) GROUP BY 1
""")
def retrieval_eval(t: Tables) -> DataFrame:
    """Search limited to the query's own segment, scored against the exact answers."""
    queries = t.embeddings.select(
        F.col("vec_id").alias("task_id"), "label", F.col("embedding").alias("query_vector")
    )
    got = vs.top_k(queries, t.embeddings, k=10, on=["label"], query_id="task_id", base_id="vec_id")
    return tasks.retrieval_eval(got.select("task_id", F.col("vec_id").alias("object_id")), _truth(t))
