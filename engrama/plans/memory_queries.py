"""Filters, listings and the memory lifecycle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.operators import filters, graph, ingest, lifecycle
from engrama.operators import text_search as ts
from engrama.operators.filters import QueryRequest
from engrama.plans.ingest_queries import _REDELIVERED, _redelivered
from engrama.plans.registry import query
from engrama.plans.text_queries import OVERLAP, QTERMS, WEIGHTS
from engrama.plans.views import Tables
from engrama.session import work_dir
from engrama.sources import snapshots

_COLUMNS = ["memory_id", "workspace_id", "agent_id", "dataset_name", "import_batch_id", "event_time", "importance",
            "is_active", "tier"]
_LIST = ", ".join(_COLUMNS)
_AGE = "((epoch_us(timestamp '2024-06-01 00:00:00')::double / 86400000000) - (epoch_us(event_time)::double / 86400000000))"

def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- filters ----------------------------------------------------------------


@query("""
SELECT event_id, session_id, agent_id FROM fx_events
WHERE tenant_id = 't_demo' AND workspace_id = 'w_3' AND agent_id = 'a_8'
""")
def scope_filter(t: Tables) -> DataFrame:
    request = QueryRequest(tenant_id="t_demo", workspace_id="w_3", agent_id="a_8")
    return filters.scoped(t.fx_events, request).select("event_id", "session_id", "agent_id")


@query("""
SELECT event_id, event_time FROM fx_events
WHERE event_time BETWEEN timestamp '2024-01-05 00:00:00' AND timestamp '2024-01-19 12:00:00'
""")
def time_window_filter(t: Tables) -> DataFrame:
    request = QueryRequest(window_from="2024-01-05 00:00:00", window_to="2024-01-19 12:00:00")
    return filters.scoped(t.fx_events, request).select("event_id", "event_time")


@query(f"""
SELECT {_LIST} FROM fx_memory WHERE dataset_name = 'src3' AND import_batch_id >= 'batch_000001' AND workspace_id = 'en'
""")
def dataset_filter(t: Tables) -> DataFrame:
    request = QueryRequest(dataset_name="src3", workspace_id="en", filter_expr="import_batch_id >= 'batch_000001'")
    return filters.scoped(t.fx_memory, request).select(*_COLUMNS)


@query(f"""
WITH n AS (SELECT workspace_id, dataset_name, max((event_time, import_batch_id))[2] AS import_batch_id
           FROM fx_memory GROUP BY 1, 2)
SELECT {_LIST} FROM fx_memory SEMI JOIN n USING (workspace_id, dataset_name, import_batch_id)
""")
def latest_batch_only(t: Tables) -> DataFrame:
    return filters.scoped(t.fx_memory, QueryRequest(latest_batch_only=True)).select(*_COLUMNS)


@query(f"""
WITH m AS (SELECT *, concat('part-', CAST(substr(memory_id, 5) AS BIGINT) % 7, '.fbin') AS file FROM fx_memory)
SELECT {_LIST} FROM m WHERE import_batch_id = 'batch_000001' AND file = 'part-3.fbin'
""")
def import_filter(t: Tables) -> DataFrame:
    """One file of one import batch."""
    file = F.concat(F.lit("part-"), F.substring("memory_id", 5, 20).cast("bigint") % 7, F.lit(".fbin"))
    request = QueryRequest(import_batch_id="batch_000001", source_file_name="part-3.fbin")
    return filters.scoped(t.fx_memory.withColumn("source_file_name", file), request).select(*_COLUMNS)


@query(f"""
SELECT 'hot_only' AS request, {_LIST} FROM fx_memory WHERE tier = 'hot'
UNION ALL SELECT 'with_cold', {_LIST} FROM fx_memory
""")
def include_cold(t: Tables) -> DataFrame:
    hot = filters.scoped(t.fx_memory, QueryRequest(include_cold=False)).withColumn("request", F.lit("hot_only"))
    every = filters.scoped(t.fx_memory, QueryRequest()).withColumn("request", F.lit("with_cold"))
    return hot.unionByName(every).select("request", *_COLUMNS)


def _linked(t: Tables) -> DataFrame:
    """Memories with the id of the graph object of the same number."""
    return t.fx_memory.withColumn("object_id", F.concat(F.lit("c_"), F.substring_index("memory_id", "_", -1)))


@query(f"""
SELECT {_LIST} FROM fx_memory
WHERE concat('c_', substring(memory_id, 5)) IN (SELECT src_id FROM fx_edges WHERE edge_type = 'member_of' AND dst_id = 'n_7')
  AND concat('c_', substring(memory_id, 5)) IN (SELECT src_id FROM fx_edges WHERE edge_type = 'member_of')
""")
def relation_constraints(t: Tables) -> DataFrame:
    request = QueryRequest(relation_constraints=[{"edge_type": "member_of", "dst_id": "n_7"}, {"edge_type": "member_of"}])
    return filters.scoped(_linked(t), request, t.fx_edges, "object_id").select(*_COLUMNS)


@query(f"""
SELECT {_LIST} FROM fx_memory WHERE importance > 0.1 AND (tier = 'hot' OR NOT is_active)
""")
def filter_expr(t: Tables) -> DataFrame:
    request = QueryRequest(filter_expr="importance > 0.1 AND (tier = 'hot' OR NOT is_active)")
    return filters.scoped(t.fx_memory, request).select(*_COLUMNS)


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('s_', doc_id)
                    WHEN source <> 'src7' THEN concat('ingest_', source, '_', lang, '.fbin')
                    ELSE concat('query_', lang) END AS session_id
FROM documents
""")
def session_alignment(t: Tables) -> DataFrame:
    given = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" s_"), "doc_id")).otherwise(" ")
    dataset = F.when(F.col("source") != "src7", F.col("source"))
    file_name = F.concat("lang", F.lit(".fbin"))
    return t.documents.select("doc_id", filters.session_for(F.col("lang"), dataset, file_name, given).alias("session_id"))


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP},
h AS (SELECT query_id, memory_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank
      FROM sc JOIN (SELECT memory_id, dataset_name FROM fx_memory WHERE dataset_name = 'src3') USING (memory_id))
SELECT query_id, memory_id, score, rank, text, importance, 'payload' AS mode
FROM h LEFT JOIN fx_memory USING (memory_id) WHERE rank <= 10
UNION ALL SELECT query_id, memory_id, score, rank, NULL, NULL, 'ids' FROM h WHERE rank <= 10
""")
def include_payload(t: Tables) -> DataFrame:
    """Hits with their content and, in the other mode, without the join."""
    scoped = filters.scoped(t.fx_memory, QueryRequest(filters={"dataset_name": "src3"}))
    hits = ts.text_search(t.fx_queries, scoped, k=10, corpus=t.fx_memory)
    payload = t.fx_memory.select("memory_id", "text", "importance")
    full = filters.with_payload(hits, payload, "memory_id", True).withColumn("mode", F.lit("payload"))
    ids = filters.with_payload(hits, payload, "memory_id", False).withColumn("mode", F.lit("ids"))
    return full.unionByName(ids, allowMissingColumns=True)


@query("""
SELECT memory_id, agent_id, dataset_name FROM fx_memory WHERE workspace_id = 'en' AND agent_id = 'a_2'
ORDER BY memory_id LIMIT 25
""")
def list_filter(t: Tables) -> DataFrame:
    listed = filters.listed(t.fx_memory, {"workspace_id": "en", "agent_id": "a_2"}, 25, "memory_id")
    return listed.select("memory_id", "agent_id", "dataset_name")


@query(f"""
SELECT {_LIST} FROM fx_memory WHERE workspace_id = 'fr'
""")
def memory_list(t: Tables) -> DataFrame:
    return filters.listed(t.fx_memory, {"workspace_id": "fr"}, None, "memory_id").select(*_COLUMNS)


# --- recall and upkeep ------------------------------------------------------


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP},
d AS (SELECT memory_id, workspace_id, round(importance * exp(-ln(2.0::double) * {_AGE} / 30), 6) AS weight
      FROM fx_memory WHERE is_active),
s AS (SELECT query_id, workspace_id, memory_id, round(score * weight, 6) AS score FROM sc JOIN d USING (memory_id))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, workspace_id ORDER BY score DESC, memory_id) AS rank FROM s)
WHERE rank <= 10
""")
def memory_recall(t: Tables) -> DataFrame:
    """Active memories by text score times what age has left of their importance."""
    active = lifecycle.decayed(t.fx_memory.where("is_active"), _at("2024-06-01 00:00:00"))
    return ts.text_search(
        t.fx_queries, active, k=10, within=["workspace_id"], corpus=t.fx_memory, boost=F.col("weight")
    )


@query(f"""
WITH {_REDELIVERED},
n AS (SELECT concat('mem_', event_id) AS memory_id, importance, version FROM r
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, event_time DESC) = 1),
o AS (SELECT concat('mem_', event_id) AS memory_id, importance, 1 AS version FROM fx_events WHERE event_type = 'purchase')
SELECT memory_id, importance, version FROM (SELECT * FROM n UNION ALL SELECT * FROM o)
QUALIFY row_number() OVER (PARTITION BY memory_id ORDER BY version DESC) = 1
""")
def memory_ingest(t: Tables) -> DataFrame:
    """New memories added over the ones stored from an earlier load."""
    stored = ingest.materialize_memory(t.fx_events.where("event_type = 'purchase'"))
    arriving = ingest.materialize_memory(_redelivered(t))
    merged = ingest.upsert_latest(stored, arriving, ["memory_id"], [F.desc("version"), F.desc("event_time")])
    return merged.select("memory_id", "importance", "version")


_COPIES = r"""
g AS (SELECT *, md5(regexp_replace(lower(trim(text)), '[ \t\n]+', ' ', 'g')) AS d FROM fx_memory),
k AS (SELECT *, min(memory_id) OVER (PARTITION BY workspace_id, agent_id, d) AS kept_id FROM g),
src AS (SELECT DISTINCT kept_id, unnest(source_event_ids) AS source_event_id FROM k)"""


@query(f"""
WITH {_COPIES}
SELECT kept_id, workspace_id, agent_id, max(importance) AS importance, count(*) AS n_merged,
       (SELECT count(*) FROM src WHERE src.kept_id = k.kept_id) AS n_sources
FROM k GROUP BY 1, 2, 3
""")
def memory_compress(t: Tables) -> DataFrame:
    return lifecycle.compressed(t.fx_memory)


@query(f"""
WITH {_COPIES}
SELECT kept_id, source_event_id FROM src
""")
def memory_compress_sources(t: Tables) -> DataFrame:
    return lifecycle.compressed_sources(t.fx_memory)


_TOKENS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '')"


@query(f"""
WITH df AS (SELECT token, count(*) AS df FROM
            (SELECT DISTINCT session_id, seq, unnest({_TOKENS.format('text')}) AS token FROM fx_turns) GROUP BY 1),
idf AS (SELECT token, ln(((SELECT count(*) FROM fx_turns)::double + 1) / (df + 1)) + 1 AS idf FROM df),
a AS (SELECT session_id, seq, list_filter(list_transform(regexp_split_to_array(text, '[.!?\\n]+'), lambda x: trim(x)),
             lambda x: x <> '') AS ss FROM fx_turns),
s AS (SELECT session_id, seq, unnest(ss) AS sentence, generate_subscripts(ss, 1) - 1 AS pos FROM a),
w AS (SELECT DISTINCT session_id, seq, pos, unnest({_TOKENS.format('sentence')}) AS token FROM s),
sc AS (SELECT session_id, seq, pos, round(avg(idf), 6) AS score FROM w JOIN idf USING (token) GROUP BY 1, 2, 3),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY score DESC, seq, pos) <= 3)
SELECT session_id, string_agg(sentence, '. ' ORDER BY seq, pos) AS summary
FROM b JOIN s USING (session_id, seq, pos) GROUP BY 1
""")
def memory_summarize(t: Tables) -> DataFrame:
    return lifecycle.session_summaries(t.fx_turns)


@query(f"""
SELECT memory_id, importance, round(importance * exp(-ln(2.0::double) * {_AGE} / 30), 6) AS weight FROM fx_memory
""")
def memory_decay(t: Tables) -> DataFrame:
    return lifecycle.decayed(t.fx_memory, _at("2024-06-01 00:00:00")).select("memory_id", "importance", "weight")


@query("""
SELECT agent_id AS viewer_agent_id, memory_id, agent_id, workspace_id FROM fx_memory
UNION
SELECT grantee_agent_id, memory_id, agent_id, m.workspace_id
FROM fx_memory m JOIN fx_share_contracts c ON owner_agent_id = agent_id AND c.workspace_id = m.workspace_id
""")
def memory_share(t: Tables) -> DataFrame:
    """Every (viewer, memory) pair the contracts allow."""
    return graph.shared_view(t.fx_memory, t.fx_share_contracts).select(
        "viewer_agent_id", "memory_id", "agent_id", "workspace_id"
    )


_RESOLVED = """
r AS (SELECT *, first_value(state_id) OVER (PARTITION BY state_key ORDER BY event_time DESC, state_id DESC) AS winner
      FROM fx_states)"""


@query(f"""
WITH {_RESOLVED}
SELECT state_key, state_id, state_value, event_time, state_id = winner AS is_active,
       CASE WHEN state_id <> winner THEN winner END AS superseded_by FROM r
""")
def conflict_resolve(t: Tables) -> DataFrame:
    """One active state per subject; the others name what replaced them."""
    return lifecycle.conflict_winners(t.fx_states, "state_key", "state_id", ["event_time"])


@query(f"""
WITH {_RESOLVED}
SELECT state_key, state_id, state_id <> winner
       OR ((epoch_us(timestamp '2001-12-01 00:00:00')::double / 86400000000) - (epoch_us(event_time)::double / 86400000000)) > 30
       AS is_stale FROM r
""")
def memory_stale(t: Tables) -> DataFrame:
    resolved = lifecycle.conflict_winners(t.fx_states, "state_key", "state_id", ["event_time"])
    now = _at("2001-12-01 00:00:00")
    return lifecycle.marked_stale(resolved, now).select("state_key", "state_id", "is_stale")


# --- deletion ---------------------------------------------------------------


@query("""
SELECT memory_id, workspace_id,
       is_active AND NOT (workspace_id = 'en' AND list_contains(source_event_ids, 'ref_3')) AS is_active
FROM fx_memory
""")
def delete_by_source(t: Tables) -> DataFrame:
    match = lifecycle.source_match("en", reference_id="ref_3")
    return lifecycle.soft_deleted(t.fx_memory, match).select("memory_id", "workspace_id", "is_active")


@query("""
SELECT count(*) AS n_matched, count(*) FILTER (is_active) AS n_active FROM fx_memory
WHERE workspace_id = 'en' AND list_contains(source_event_ids, 'ref_3')
""")
def delete_by_source_dry_run(t: Tables) -> DataFrame:
    return lifecycle.deletion_report(t.fx_memory, lifecycle.source_match("en", reference_id="ref_3"))


def _memory_versions(t: Tables) -> tuple[str, str]:
    table = work_dir(t.spark, "memory")
    snapshots.write_version(t.fx_memory, table, "workspace_id")
    return table, work_dir(t.spark, "audit")


@query("""
SELECT memory_id, workspace_id, is_active FROM fx_memory
WHERE NOT (workspace_id = 'en' AND list_contains(source_event_ids, 'ref_10') AND NOT is_active)
""")
def purge_by_source(t: Tables) -> DataFrame:
    """The purge run twice under one key: the repeat reports the first run and removes nothing more."""
    table, audit = _memory_versions(t)
    match = lifecycle.source_match("en", reference_id="ref_10")
    for _ in range(2):
        lifecycle.purge_job(t.spark, table, audit, match, "purge_by_source", "job-1")
    return snapshots.read_version(t.spark, table).select("memory_id", "workspace_id", "is_active")


@query("""
SELECT memory_id, is_active AND NOT (workspace_id = 'de' AND dataset_name = 'src5') AS is_active FROM fx_memory
""")
def dataset_delete(t: Tables) -> DataFrame:
    match = lifecycle.dataset_match("de", "src5")
    return lifecycle.soft_deleted(t.fx_memory, match).select("memory_id", "is_active")


@query("""
SELECT 'dry_run' AS step, count(*) FILTER (workspace_id = 'de' AND dataset_name = 'src5') AS n_removed,
       count(*) FILTER (NOT (workspace_id = 'de' AND dataset_name = 'src5')) AS n_left FROM fx_memory
UNION ALL
SELECT 'purge', count(*) FILTER (workspace_id = 'de' AND dataset_name = 'src5'),
       count(*) FILTER (NOT (workspace_id = 'de' AND dataset_name = 'src5')) FROM fx_memory
UNION ALL
SELECT 'after', 0, count(*) FILTER (NOT (workspace_id = 'de' AND dataset_name = 'src5')) FROM fx_memory
""")
def dataset_purge(t: Tables) -> DataFrame:
    """Dry run, purge, and the table afterwards."""
    table, audit = _memory_versions(t)
    match = lifecycle.dataset_match("de", "src5")
    settings = {"action": "dataset_purge", "idempotency_key": "job-1", "only_if_inactive": False}
    dry = lifecycle.purge_job(t.spark, table, audit, match, dry_run=True, **settings)
    dry = dry.withColumn("step", F.lit("dry_run"))
    done = lifecycle.purge_job(t.spark, table, audit, match, **settings).select("n_removed", "n_left", F.lit("purge").alias("step"))
    after = snapshots.read_version(t.spark, table).agg(
        F.count_if(match).alias("n_removed"), F.count_if(~match).alias("n_left")
    ).withColumn("step", F.lit("after"))
    return reduce(DataFrame.unionByName, [dry, done, after]).select("step", "n_removed", "n_left")


@query(f"""
SELECT {_LIST} FROM fx_memory WHERE tier <> 'cold'
""")
def cold_purge(t: Tables) -> DataFrame:
    return lifecycle.cold_purged(t.fx_memory, confirm=lifecycle.CONFIRM_COLD).select(*_COLUMNS)


@query("""
WITH m AS (SELECT min(memory_id) AS target FROM fx_memory WHERE NOT is_active)
SELECT memory_id, is_active OR memory_id = target AS is_active FROM fx_memory, m
""")
def memory_rollback(t: Tables) -> DataFrame:
    """The first inactive memory switched on again."""
    target = t.fx_memory.where("NOT is_active").agg(F.min("memory_id")).first()[0]
    return lifecycle.rolled_back(t.fx_memory, target, "reactivate").select("memory_id", "is_active")


# --- replay, visibility, governance -----------------------------------------


@query("""
SELECT concat('mem_', event_id) AS memory_id, workspace_id, importance, event_time FROM fx_events WHERE lsn >= 100
""")
def log_replay(t: Tables) -> DataFrame:
    return lifecycle.replayed(t.fx_events, from_lsn=100).select("memory_id", "workspace_id", "importance", "event_time")


@query("""
SELECT event_type, count(*) AS n_events, min(lsn) AS first_lsn, max(lsn) AS last_lsn FROM fx_events WHERE lsn >= 100 GROUP BY 1
""")
def log_replay_preview(t: Tables) -> DataFrame:
    return lifecycle.replay_preview(t.fx_events, from_lsn=100)


@query("""
SELECT event_type, count(*) AS n_events, min(lsn) AS first_lsn, max(lsn) AS last_lsn
FROM (SELECT * FROM fx_events WHERE lsn >= 50 ORDER BY lsn LIMIT 400) GROUP BY 1
""")
def log_replay_limited(t: Tables) -> DataFrame:
    """What a replay of at most 400 events would read."""
    return lifecycle.replay_preview(t.fx_events, from_lsn=50, limit=400)


@query(f"""
WITH e AS (SELECT *, 0 AS extra FROM fx_events
           UNION ALL BY NAME SELECT * REPLACE (version + 1 AS version, visible_time + interval '2' day AS visible_time), 0 AS extra
           FROM fx_events WHERE event_type = 'purchase')
SELECT event_id, version, event_time FROM e WHERE visible_time <= timestamp '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, event_time DESC) = 1
""")
def visibility_asof(t: Tables) -> DataFrame:
    """Events as they looked at a point in time; second versions became visible two days later."""
    later = t.fx_events.where("event_type = 'purchase'").withColumns(
        {"version": F.col("version") + 1, "visible_time": F.expr("visible_time + interval '2' day")}
    )
    as_of = _at("2024-01-15 00:00:00")
    seen = lifecycle.visible_asof(t.fx_events.unionByName(later), as_of)
    return seen.select("event_id", "version", "event_time")


@query(f"""
SELECT {_LIST} FROM fx_memory ANTI JOIN (SELECT object_id AS memory_id FROM fx_policies WHERE effect = 'deny') USING (memory_id)
""")
def governance_filter(t: Tables) -> DataFrame:
    return lifecycle.governed(t.fx_memory, t.fx_policies).select(*_COLUMNS)
