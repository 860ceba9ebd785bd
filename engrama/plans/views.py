"""The test tables seen as the engine's own tables: events, memories, vectors, graph, tasks.

One text per view serves both engines; the Spark form reads the base tables as
DataFrames, the DuckDB form as registered views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_VIEWS = {
    "fx_events": """
        SELECT concat('evt_', cast(event_id AS string)) AS event_id,
               't_demo' AS tenant_id,
               concat('w_', cast(user_id % 5 AS string)) AS workspace_id,
               concat('a_', cast(user_id AS string)) AS agent_id,
               concat('s_', cast(user_id AS string), '_', cast(cast(ts AS date) AS string)) AS session_id,
               event_type, ts AS event_time,
               ts + (event_id % 60) * interval '1' second AS ingest_time,
               ts + (event_id % 600) * interval '1' second AS visible_time,
               value AS importance, props AS payload, 1 AS version, event_id + 1 AS lsn
        FROM {events}""",
    "fx_memory": """
        SELECT concat('mem_', cast(doc_id AS string)) AS memory_id,
               lang AS workspace_id,
               concat('a_', cast(doc_id % 7 AS string)) AS agent_id,
               source AS dataset_name,
               concat('batch_', lpad(cast(cast(floor(doc_id / 50.0) AS bigint) AS string), 6, '0'))
                   AS import_batch_id,
               text, timestamp_ntz '2024-01-01 00:00:00' + doc_id * interval '1' minute AS event_time,
               n_chars / 20000.0D AS importance,
               doc_id % 10 <> 0 AS is_active,
               CASE WHEN doc_id % 3 = 0 THEN 'cold' ELSE 'hot' END AS tier,
               array(concat('evt_', cast(doc_id AS string)), concat('ref_', cast(doc_id % 20 AS string)))
                   AS source_event_ids
        FROM {documents}""",
    "fx_vectors": """
        SELECT concat('warm.c', cast(label AS string)) AS segment_id,
               concat('vec_', cast(vec_id AS string)) AS object_id,
               vec_id, embedding
        FROM {embeddings}""",
    "fx_agents": """
        SELECT concat('c_', cast(c_custkey AS string)) AS agent_id,
               c_mktsegment AS role, n_name AS workspace_id, r_name AS tenant_id
        FROM {customer}
        JOIN {nation} ON c_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_states": """
        SELECT concat('c_', cast(o_custkey AS string)) AS state_key,
               concat('o_', cast(o_orderkey AS string)) AS state_id,
               o_orderstatus AS state_value, o_orderdate AS event_time
        FROM {orders}""",
    "fx_edges": """
        SELECT concat('o_', cast(o_orderkey AS string)) AS src_id,
               concat('c_', cast(o_custkey AS string)) AS dst_id, 'derived_from' AS edge_type
        FROM {orders}
        UNION ALL SELECT concat('c_', cast(c_custkey AS string)), concat('n_', cast(c_nationkey AS string)),
                         'member_of' FROM {customer}
        UNION ALL SELECT concat('n_', cast(n_nationkey AS string)), concat('r_', cast(n_regionkey AS string)),
                         'part_of' FROM {nation}""",
    "fx_tasks": """
        SELECT concat('c_', cast(o_custkey AS string)) AS session_id,
               o_orderkey AS task_id, o_orderpriority AS task_type, o_orderdate AS started_at,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus = 'F' END AS success
        FROM {orders}""",
    "fx_task_steps": """
        SELECT l_orderkey AS task_id, l_linenumber AS step_index, l_quantity AS tokens,
               l_linestatus = 'F' AS repaired
        FROM {lineitem}""",
    "fx_turns": """
        SELECT concat('conv_', cast(conv_id AS string)) AS session_id, turn AS seq, role AS agent_id, text
        FROM {conversations}""",
    "fx_policies": """
        SELECT concat('mem_', cast(doc_id AS string)) AS object_id, 'deny' AS effect
        FROM {labels} WHERE toxic = 1""",
    "fx_share_contracts": """
        SELECT concat('a_', cast(n_nationkey % 7 AS string)) AS owner_agent_id,
               concat('a_', cast((n_nationkey + 1 + n_regionkey) % 7 AS string)) AS grantee_agent_id,
               CASE n_regionkey WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'es' END
                   AS workspace_id
        FROM {nation}""",
    "fx_queries": """
        SELECT item_id AS query_id, text AS query_text FROM {benchmark}""",
}


def _for_duckdb(text: str) -> str:
    text = re.sub(r"\barray\(", "list_value(", text).replace("20000.0D", "20000.0::double").replace("timestamp_ntz", "timestamp")
    return text.format(**{t: t for t in BASE_TABLES})


VIEW_SQL = {name: {"spark": text, "duckdb": _for_duckdb(text)} for name, text in _VIEWS.items()}


class Tables:
    """Base tables and views as attributes, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._seen = spark, sf_dir.rstrip("/"), {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # all times here are UTC

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in BASE_TABLES and name not in _VIEWS):
            raise AttributeError(name)
        if name not in self._seen:
            if name in BASE_TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                used = re.findall(r"\{(\w+)\}", _VIEWS[name])
                frame = self.spark.sql(_VIEWS[name], **{t: getattr(self, t) for t in used})
            self._seen[name] = frame
        return self._seen[name]
