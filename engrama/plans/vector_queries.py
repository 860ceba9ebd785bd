"""Vector search queries: exact top-k in its variants, result shaping, fusion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.defaults import MMR_FETCH, MMR_K
from engrama.operators import filters
from engrama.operators import vector_search as vs
from engrama.plans.registry import query
from engrama.plans.views import Tables

_VECTORS = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
_NORMED = (
    "v AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM "
    "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))"
)
_COSINE = "CASE WHEN q.n * b.n = 0 THEN 0 ELSE round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) + 0.0 END"


def _queries(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query_vector"))


_IDS = {"query_id": "qid", "base_id": "vec_id"}


@query(f"""
WITH {_NORMED},
s AS (SELECT q.vec_id AS qid, b.vec_id, {_COSINE} AS score FROM v q, v b)
SELECT qid, vec_id, score, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rnk FROM s)
WHERE rnk <= 10
""")
def vector_batch_topk(t: Tables) -> DataFrame:
    """Every stored vector as a query row against the whole table."""
    return vs.top_k(_queries(t), t.embeddings, k=10, **_IDS).withColumnRenamed("rank", "rnk")


def _mmr_sql(k: int, fetch: int) -> str:
    steps = ["p1 AS (SELECT qid, vec_id, score, score AS gain, 1 AS pick FROM c QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) = 1)"]
    for i in range(2, k + 1):
        steps.append(f"""g{i} AS (SELECT c.qid, c.vec_id, c.score, round(0.5 * c.score - 0.5 * max(s.score), 9) AS gain
            FROM c JOIN p{i - 1} p ON p.qid = c.qid JOIN s ON s.qid = c.vec_id AND s.vec_id = p.vec_id
            WHERE NOT EXISTS (SELECT 1 FROM p{i - 1} x WHERE x.qid = c.qid AND x.vec_id = c.vec_id) GROUP BY c.qid, c.vec_id, c.score),
        p{i} AS (SELECT * FROM p{i - 1} UNION ALL SELECT qid, vec_id, score, gain, {i} FROM g{i}
            QUALIFY row_number() OVER (PARTITION BY qid ORDER BY gain DESC, vec_id) = 1)""")
    return f"""
WITH {_NORMED},
s AS (SELECT q.vec_id AS qid, b.vec_id, {_COSINE} AS score FROM v q, v b),
c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) <= {fetch}),
{", ".join(steps)}
SELECT qid, vec_id, score, round(gain, 6) + 0.0 AS gain, CAST(pick AS BIGINT) AS pick FROM p{k}
"""


@query(_mmr_sql(MMR_K, MMR_FETCH))
def mmr_search(t: Tables) -> DataFrame:
    """Every stored vector as a query: near rows that also differ from each other."""
    return vs.mmr(_queries(t), t.embeddings, **_IDS).withColumn("gain", vs.r6("gain") + 0.0)


@query(f"""
WITH {_NORMED},
q AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
s AS (SELECT concat('warm.c', b.label) AS segment_id, q.vec_id AS qid, b.vec_id, {_COSINE} AS score
      FROM q JOIN v b ON q.label = b.label)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rnk FROM s)
WHERE rnk <= 10
""")
def vector_topk(t: Tables) -> DataFrame:
    """One vector per segment (its first), searched in that segment only."""
    first = t.fx_vectors.groupBy("segment_id").agg(
        F.min("vec_id").alias("qid"), F.min_by("embedding", "vec_id").alias("query_vector")
    )
    hits = vs.top_k(first, t.fx_vectors, k=10, on=["segment_id"], **_IDS)
    return hits.withColumnRenamed("rank", "rnk")


@query(f"""
WITH {_NORMED},
s AS (SELECT q.vec_id AS qid, concat('warm.c', b.label) AS source_id, b.vec_id, {_COSINE} AS score FROM v q, v b),
m AS (SELECT *, row_number() OVER (PARTITION BY qid, source_id ORDER BY score DESC, vec_id) AS rnk FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rnk FROM s)
SELECT 'multi_agent' AS agent_mode, qid, source_id, vec_id, score, rnk FROM m WHERE rnk <= 10
UNION ALL SELECT 'single_agent', qid, source_id, vec_id, score, rnk FROM o WHERE rnk <= 10
""")
def batch_by_source(t: Tables) -> DataFrame:
    """Batch search grouped by source (several agents) and as one list (a single agent)."""
    base = t.fx_vectors.withColumnRenamed("segment_id", "source_id")
    hits = vs.top_k(_queries(t), base, k=10, within=["source_id"], **_IDS)
    modes = [
        vs.by_source(hits, mode, 10, "qid", "vec_id").select(
            F.lit(mode).alias("agent_mode"), "qid", "source_id", "vec_id", "score", F.col("rank").alias("rnk")
        )
        for mode in ("multi_agent", "single_agent")
    ]
    return reduce(DataFrame.unionByName, modes)


@query(f"""
WITH {_NORMED},
s AS (SELECT q.vec_id AS qid, b.vec_id, {_COSINE} AS score FROM v q, v b)
SELECT qid, vec_id, round(1 - score, 6) AS distance, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rnk FROM s)
WHERE rnk <= 10
""")
def batch_raw(t: Tables) -> DataFrame:
    """The same batch search as raw ids and distances."""
    hits = vs.top_k(_queries(t), t.embeddings, k=10, **_IDS)
    return vs.distances(hits).withColumnRenamed("rank", "rnk")


@query("""
WITH v AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM
           (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
p AS (SELECT q.vec_id AS qid, b.vec_id, list_dot_product(q.e, b.e) AS d, q.n * b.n AS nn,
             list_distance(q.e, b.e) AS l2 FROM v q, v b),
s AS (SELECT 'COSINE' AS metric, qid, vec_id, CASE WHEN nn = 0 THEN 0 ELSE round(d / nn, 6) END AS score,
             -(CASE WHEN nn = 0 THEN 0 ELSE round(d / nn, 6) END) AS o FROM p
      UNION ALL SELECT 'IP', qid, vec_id, round(d, 6), -round(d, 6) FROM p
      UNION ALL SELECT 'L2', qid, vec_id, round(l2, 6), round(l2, 6) FROM p)
SELECT metric, qid, vec_id, score, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, qid ORDER BY o, vec_id) AS rnk FROM s)
WHERE rnk <= 10
""")
def metric_types(t: Tables) -> DataFrame:
    """Cosine, inner product and Euclidean distance over the same table."""
    found = [
        vs.top_k(_queries(t), t.embeddings, k=10, metric=metric, **_IDS).select(
            F.lit(metric.upper()).alias("metric"), "qid", "vec_id", "score", F.col("rank").alias("rnk")
        )
        for metric in ("cosine", "ip", "l2")
    ]
    return reduce(DataFrame.unionByName, found)


@query(f"""
WITH {_NORMED},
s AS (SELECT q.vec_id AS qid, b.vec_id, {_COSINE} AS score FROM v q, v b),
h AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rnk FROM s),
k AS (SELECT * FROM h WHERE rnk <= 10)
SELECT qid, vec_id, rnk, round(1 - (rnk - 1) / greatest(count(*) OVER (PARTITION BY qid), 1)::double, 6)
       AS position_score FROM k
""")
def rank_position_score(t: Tables) -> DataFrame:
    """Scores for answers that carry only ids in order."""
    hits = vs.top_k(_queries(t), t.embeddings, k=10, **_IDS).drop("score")
    return vs.position_scores(hits, "qid").withColumnRenamed("rank", "rnk")


@query("""
WITH x AS (SELECT vec_id, unnest(embedding) AS distance, generate_subscripts(embedding, 1) - 1 AS pos
           FROM embeddings)
SELECT vec_id AS frame_id, CAST(pos // 8 AS BIGINT) AS query_idx, CAST(pos % 8 AS BIGINT) AS rank,
       CAST(vec_id * 64 + pos AS BIGINT) AS id, distance::double AS distance
FROM x
""")
def batch_result_explode(t: Tables) -> DataFrame:
    """Each stored vector read as one flat 8 x 8 result frame."""
    frames = t.embeddings.select(
        F.col("vec_id").alias("frame_id"),
        F.transform("embedding", lambda x, i: F.col("vec_id") * 64 + i).alias("ids"),
        F.col("embedding").alias("dists"),
    )
    return vs.explode_flat_result(frames, "frame_id", "ids", "dists", topk=8)


@query("""
SELECT segment_id, object_id FROM fx_vectors
""")
def output_fields(t: Tables) -> DataFrame:
    """Only the asked-for columns; the scan then reads nothing else."""
    return filters.output_fields(t.fx_vectors, ["segment_id", "object_id"])


@query("""
SELECT workspace_id, count(*) AS n_objects, count(DISTINCT memory_id) AS n_distinct
FROM fx_memory GROUP BY 1
""")
def result_counts(t: Tables) -> DataFrame:
    """Object counts per workspace, exact; the sketch form is for large tables."""
    return filters.result_counts(t.fx_memory, ["workspace_id"], "memory_id", exact=True)


@query(name="result_counts_approx")
def result_counts_approx(t: Tables) -> DataFrame:
    """The same counts by a distinct-count sketch."""
    return filters.result_counts(t.fx_memory, ["workspace_id"], "memory_id", exact=False)
