"""Text weighting, text search, fusion and evidence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.operators import graph, text_index
from engrama.operators import text_search as ts
from engrama.operators import vector_search as vs
from engrama.functions.vectors import r6
from engrama.plans.registry import query
from engrama.plans.views import Tables
from engrama.session import work_dir

# reusable SQL pieces for the TF-IDF checks
TOK = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '')"
WEIGHTS = f"""
tc AS (SELECT memory_id, token, count(*) AS tf FROM
       (SELECT memory_id, unnest({TOK.format('text')}) AS token FROM fx_memory) GROUP BY 1, 2),
idf AS (SELECT token, ln(((SELECT count(*) FROM fx_memory)::double + 1) / (count(*) + 1)) + 1 AS idf
        FROM tc GROUP BY 1),
w AS (SELECT memory_id, token, tf, tf * idf AS w FROM tc JOIN idf USING (token)),
len AS (SELECT memory_id, sqrt(sum(w * w)) AS len FROM w GROUP BY 1)"""
QTERMS = f"""
qt AS (SELECT query_id, token, count(*) AS qtf FROM
       (SELECT query_id, unnest({TOK.format('query_text')}) AS token FROM fx_queries) GROUP BY 1, 2)"""
OVERLAP = """
sc AS (SELECT query_id, memory_id, round(sum(qtf * w) / any_value(len), 6) AS score
       FROM w JOIN qt USING (token) JOIN len USING (memory_id) GROUP BY 1, 2)"""


@query(f"""
WITH {WEIGHTS}
SELECT memory_id, token, tf, round(w, 6) AS w FROM w
""")
def tfidf_weights(t: Tables) -> DataFrame:
    weights = ts.tfidf_weights(t.fx_memory, ["memory_id"], "text")
    return weights.withColumn("w", r6(F.col("w")))


@query(f"""
WITH {WEIGHTS},
b AS (SELECT memory_id, ('0x' || md5(token)[1:2])::INT AS bucket, sum(w) AS s FROM w GROUP BY 1, 2)
SELECT memory_id, bucket, round(s / sqrt(sum(s * s) OVER (PARTITION BY memory_id)), 6) AS value FROM b
""")
def tfidf_dense_256(t: Tables) -> DataFrame:
    """Fixed-length text vectors, shown as their non-zero cells."""
    vectors = ts.dense_text_vectors(t.fx_memory, "memory_id", "text")
    exact = ts.dense_text_cells(t.fx_memory, "memory_id", "text").withColumnRenamed("value", "exact")
    # the stored vector is float32: check it against the double cells it was made from; both lie by id
    joined = exact.join(vectors, "memory_id").withColumn("value", F.get("embedding", F.col("bucket"))).where(F.col("value") != 0)
    close = F.abs(F.col("value") - F.col("exact")) < 1e-6
    return joined.where(close).select("memory_id", "bucket", r6(F.col("exact")).alias("value"))


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP}
SELECT query_id, workspace_id, memory_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, workspace_id ORDER BY score DESC, memory_id) AS rank
  FROM sc JOIN (SELECT memory_id, workspace_id FROM fx_memory) USING (memory_id))
WHERE rank <= 10
""")
def text_search(t: Tables) -> DataFrame:
    """Every query text against every workspace, ten best memories in each."""
    return ts.text_search(t.fx_queries, t.fx_memory, k=10, within=["workspace_id"])


def _text_index(t: Tables) -> tuple[str, DataFrame]:
    path = work_dir(t.spark, "text-index")
    return path, text_index.build(t.fx_memory, path, carried=["workspace_id"])


@query(f"""
WITH {WEIGHTS}
SELECT (SELECT count(*) FROM len) AS n_texts, (SELECT count(*) FROM idf) AS n_tokens, (SELECT count(*) FROM tc) AS n_postings
""")
def text_index_build(t: Tables) -> DataFrame:
    """The sizes of a text index written to tables."""
    return _text_index(t)[1].select("n_texts", "n_tokens", "n_postings")


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP}
SELECT query_id, workspace_id, memory_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, workspace_id ORDER BY score DESC, memory_id) AS rank
  FROM sc JOIN (SELECT memory_id, workspace_id FROM fx_memory) USING (memory_id))
WHERE rank <= 10
""")
def text_index_search(t: Tables) -> DataFrame:
    """The same search over the stored index."""
    path, _ = _text_index(t)
    return text_index.search(t.spark, path, t.fx_queries, 10, within=["workspace_id"])


@query(f"""
WITH {WEIGHTS}, {QTERMS}, {OVERLAP},
bodies AS (SELECT query_id, CASE query_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'es' END
                  AS workspace_id, 3 + query_id % 5 AS top_k FROM fx_queries)
SELECT query_id AS query_idx, memory_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank
  FROM sc JOIN (SELECT memory_id, workspace_id FROM fx_memory) USING (memory_id)
       JOIN bodies USING (query_id, workspace_id))
WHERE rank <= top_k
""")
def multi_query(t: Tables) -> DataFrame:
    """Many query bodies, each with its own workspace and size, answered in one job."""
    workspace = (
        F.when(F.col("query_id") % 4 == 0, "en").when(F.col("query_id") % 4 == 1, "de")
        .when(F.col("query_id") % 4 == 2, "fr").otherwise("es")
    )
    bodies = t.fx_queries.withColumn("workspace_id", workspace)
    wanted = bodies.select("query_id", (3 + F.col("query_id") % 5).alias("top_k"))
    largest = wanted.agg(F.max("top_k")).first()[0]
    found = ts.text_search(bodies, t.fx_memory, k=largest, scope=["workspace_id"])
    return found.join(wanted, "query_id").where(F.col("rank") <= F.col("top_k")).select(
        F.col("query_id").alias("query_idx"), "memory_id", "score", "rank"
    ).orderBy("query_idx", "rank")


HYBRID = f"""{WEIGHTS}, {QTERMS}, {OVERLAP},
tl AS (SELECT query_id, memory_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank
       FROM sc),
v AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM
      (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
vs AS (SELECT query_id, concat('mem_', b.vec_id) AS memory_id,
              CASE WHEN q.n * b.n = 0 THEN 0 ELSE round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) END AS score
       FROM fx_queries JOIN v q ON q.vec_id = query_id, v b),
vl AS (SELECT query_id, memory_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank
       FROM vs),
fused AS (SELECT query_id, memory_id, round(sum(1.0::double / (60 + rank)), 6) AS score FROM
          (SELECT * FROM tl WHERE rank <= 20 UNION ALL SELECT * FROM vl WHERE rank <= 20) GROUP BY 1, 2),
hits AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, memory_id) AS rank FROM fused)
  WHERE rank <= 10)"""


def _hybrid_hits(t: Tables) -> DataFrame:
    text_list = ts.text_search(t.fx_queries, t.fx_memory, k=20)
    vectors = t.embeddings.select(F.concat(F.lit("mem_"), F.col("vec_id")).alias("memory_id"), "vec_id", "embedding")
    query_vectors = t.fx_queries.join(
        vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")), "query_id"
    )
    vector_list = vs.top_k(query_vectors, vectors, k=20, base_id="memory_id")
    return ts.rrf_fusion([text_list, vector_list], "query_id", "memory_id", 10)


@query(f"""
WITH {HYBRID}
SELECT * FROM hits
""")
def rrf_fusion(t: Tables) -> DataFrame:
    """Text results and vector results of different dimensions fused by rank."""
    return _hybrid_hits(t)


@query(f"""
WITH RECURSIVE {HYBRID},
chunks AS (
  SELECT memory_id, CAST(i.i AS BIGINT) AS position, substring(text, CAST(i.i * 450 + 1 AS BIGINT), 500) AS evidence
  FROM fx_memory, LATERAL unnest(range(0, greatest(length(text) - 50 - 1, 0) // 450 + 1)) AS i(i)),
trace AS (
  SELECT root, root AS node, 0 AS depth FROM (SELECT DISTINCT concat('o_', substring(memory_id, 5)) AS root FROM hits)
  UNION ALL
  SELECT root, dst_id, depth + 1 FROM trace JOIN fx_edges ON src_id = node WHERE depth < 6),
nodes AS (SELECT root, node AS evidence, CAST(min(depth) AS BIGINT) AS position FROM trace WHERE depth > 0 GROUP BY 1, 2)
SELECT query_id, memory_id, score, rank, 'chunk' AS evidence_kind, position, evidence FROM hits JOIN chunks USING (memory_id)
UNION ALL
SELECT query_id, memory_id, score, rank, 'trace', position, evidence
FROM hits JOIN nodes ON root = concat('o_', substring(memory_id, 5))
""")
def structured_evidence(t: Tables) -> DataFrame:
    """Fused hits with, as one row each, their chunk texts and the provenance nodes behind them."""
    hits = _hybrid_hits(t).withColumn("object_id", F.concat(F.lit("o_"), F.substring_index("memory_id", "_", -1)))
    return graph.evidence(hits, t.fx_memory, t.fx_edges, "memory_id", "text", "object_id").drop("object_id")
