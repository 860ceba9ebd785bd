"""Index, collection and embedding-model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.functions.provenance import runtime_info
from engrama.functions.vectors import r6
from engrama.operators import collections, embedding, ivf
from engrama.plans.registry import query
from engrama.plans.views import Tables
from engrama.session import materialize, work_dir

# --- approximate search -----------------------------------------------------

NLIST_SQL = "(SELECT CAST(floor(sqrt(count(*))) AS BIGINT) FROM embeddings)"
_IDS = {"query_id": "qid", "base_id": "vec_id"}


def _base(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "embedding")


def _queries(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query_vector"))


def _sizes(t: Tables) -> tuple[int, int]:
    """How many lists there are and how many are probed, by the size of the table."""
    lists = ivf.list_count(t.embeddings.count())
    return lists, ivf.probe_count(lists)


def _lists(t: Tables) -> tuple[DataFrame, DataFrame, int]:
    """Centroids and assigned vectors, pinned as a stored index would be, and how many lists to probe."""
    lists, probed = _sizes(t)
    centroids = materialize(ivf.sampled_centroids(_base(t), lists, "vec_id"))
    return centroids, materialize(ivf.assign_lists(_base(t), centroids, "vec_id")), probed


def _search_stored(t: Tables, index_type: str) -> DataFrame:
    """Build an index of the type as tables and search it."""
    lists, probed = _sizes(t)
    path = work_dir(t.spark, "index")
    centroids = materialize(ivf.sampled_centroids(_base(t), lists, "vec_id"))
    ivf.build_index(_base(t), centroids, path, "warm.default", index_type, id_column="vec_id")
    return ivf.search_index(t.spark, path, _queries(t), probed, 10, **_IDS)


_LISTS = f"""
v AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM
      (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
c AS (SELECT * FROM (SELECT row_number() OVER (ORDER BY md5(vec_id::varchar)) - 1 AS list_id, e FROM v) WHERE list_id < {NLIST_SQL}),
near AS (SELECT vec_id, list_id, row_number() OVER (
           PARTITION BY vec_id ORDER BY round(list_dot_product(v.e, c.e), 6) DESC, list_id) AS r FROM v, c),
assigned AS (SELECT vec_id, list_id FROM near WHERE r = 1),
probe AS (SELECT vec_id AS qid, list_id FROM near WHERE r <= greatest(1, {NLIST_SQL} // 4))"""
_TOP = """
SELECT qid, vec_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""


@query(f"""
WITH {_LISTS},
s AS (SELECT qid, a.vec_id, round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) + 0.0 AS score
      FROM probe JOIN assigned a USING (list_id) JOIN v q ON q.vec_id = qid JOIN v b ON b.vec_id = a.vec_id)
{_TOP}
""")
def ivf_flat_search(t: Tables) -> DataFrame:
    """As many lists as the root of the vectors, a quarter probed, exact scores inside them."""
    centroids, assigned, probed = _lists(t)
    return ivf.ivf_search(_queries(t), assigned, centroids, probed, 10, **_IDS)


_CODES = """
x AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM v),
r AS (SELECT d, min(x) AS lo, max(x) AS hi FROM x GROUP BY 1),
codes AS (SELECT vec_id, d, lo, hi, CASE WHEN hi > lo THEN floor(255 * (x - lo) / (hi - lo) + 0.5) ELSE 0 END AS code
          FROM x JOIN r USING (d))"""


@query(f"""
WITH {_LISTS}, {_CODES}
SELECT vec_id, CAST(d - 1 AS INTEGER) AS dim, CAST(code AS INTEGER) AS code FROM codes
""")
def ivf_sq8_codes(t: Tables) -> DataFrame:
    """The one-byte codes of every vector."""
    low, high = ivf.dimension_ranges(_base(t))
    coded = ivf.sq8_encode(_base(t), low, high)
    return coded.select("vec_id", F.posexplode("codes").alias("dim", "code")).withColumn("code", F.col("code").cast("int"))


@query(f"""
WITH {_LISTS}, {_CODES},
dv AS (SELECT vec_id, list(lo + code * (hi - lo) / 255 ORDER BY d) AS e FROM codes GROUP BY 1),
dn AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM dv),
s AS (SELECT qid, a.vec_id, round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) + 0.0 AS score
      FROM probe JOIN assigned a USING (list_id) JOIN v q ON q.vec_id = qid JOIN dn b ON b.vec_id = a.vec_id)
{_TOP}
""")
def ivf_sq8_search(t: Tables) -> DataFrame:
    """The same lists, stored and read as one-byte codes."""
    return _search_stored(t, "IVF_SQ8")


@query(f"""
WITH {_LISTS},
p AS (SELECT vec_id, i.i AS part, e[i.i * 8 + 1 : i.i * 8 + 8] AS x FROM v, LATERAL unnest(range(0, 8)) AS i(i)),
book AS (SELECT part, x AS c, row_number() OVER (PARTITION BY part ORDER BY md5(vec_id::varchar)) - 1 AS code FROM p
         QUALIFY row_number() OVER (PARTITION BY part ORDER BY md5(vec_id::varchar)) <= 16),
enc AS (SELECT vec_id, part, c FROM p JOIN book USING (part)
        QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY round(list_distance(x, c) ** 2, 6), code) = 1),
dv AS (SELECT vec_id, flatten(list(c ORDER BY part)) AS e FROM enc GROUP BY 1),
rough AS (SELECT qid, a.vec_id, round(list_distance(q.e, b.e), 6) AS d
          FROM probe JOIN assigned a USING (list_id) JOIN v q ON q.vec_id = qid JOIN dv b ON b.vec_id = a.vec_id),
cand AS (SELECT * FROM rough QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d, vec_id) <= 40),
s AS (SELECT qid, cand.vec_id, round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) + 0.0 AS score
      FROM cand JOIN v q ON q.vec_id = qid JOIN v b ON b.vec_id = cand.vec_id)
{_TOP}
""")
def ivf_pq_search(t: Tables) -> DataFrame:
    """Eight parts of four bits, stored and read as codes, forty candidates per query ranked exactly."""
    return _search_stored(t, "IVF_PQ")


@query(name="ivf_kmeans_search")
def ivf_kmeans_search(t: Tables) -> DataFrame:
    """Lists around fitted centers; the fit is iterative, so there is no SQL for it."""
    lists, probed = _sizes(t)
    centroids = ivf.kmeans_centroids(_base(t), lists)
    assigned = ivf.assign_lists(_base(t), centroids, "vec_id", "L2")  # as the fit measures
    return ivf.ivf_search(_queries(t), assigned, centroids, probed, 10, list_metric="L2", **_IDS)


@query(f"""
WITH {_LISTS}
SELECT list_id, count(*) AS n_vectors, 'IVF_FLAT' AS index_type,
       (SELECT count(DISTINCT list_id) FROM assigned) AS n_lists FROM assigned GROUP BY 1
""")
def index_build(t: Tables) -> DataFrame:
    """An index written to tables: its registry row and the sizes of its lists."""
    base = t.embeddings.select(F.col("vec_id").alias("object_id"), "embedding")
    path = work_dir(t.spark, "index")
    centroids = ivf.sampled_centroids(_base(t), _sizes(t)[0], "vec_id")
    registry = ivf.build_index(base, centroids, path, "warm.default")
    sizes = ivf.read_lists(t.spark, path).groupBy("list_id").agg(F.count(F.lit(1)).alias("n_vectors"))
    return sizes.crossJoin(F.broadcast(registry.select("index_type", "n_lists")))


# --- collections ------------------------------------------------------------


@query("""
WITH c AS (SELECT p_partkey AS collection_id,
                  CASE p_size % 7 WHEN 0 THEN ' hnsw' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'Ivf_Flat ' WHEN 4 THEN 'IVF_PQ'
                                  WHEN 5 THEN 'btree' ELSE 'diskann' END AS raw,
                  CASE WHEN p_size > 25 THEN p_size ELSE 0 END AS ivf_nlist,
                  CASE WHEN p_size > 40 THEN ' INT8 ' ELSE '' END AS sq FROM part),
n AS (SELECT *, CASE WHEN trim(coalesce(raw, '')) = '' THEN 'HNSW' WHEN upper(trim(raw)) = 'BTREE' THEN NULL
                     ELSE upper(trim(raw)) END AS index_name FROM c)
SELECT collection_id, index_name, index_name IS NULL AS index_error,
       CASE WHEN index_name IS NOT NULL THEN concat_ws(',',
         CASE WHEN trim(coalesce(raw, '')) <> '' OR ivf_nlist <> 0 OR trim(sq) <> '' THEN concat('index_type=', index_name) END,
         CASE WHEN ivf_nlist <> 0 THEN concat('ivf_nlist=', ivf_nlist) END,
         CASE WHEN trim(sq) <> '' THEN concat('ivf_sq_type=', trim(sq)) END) END AS index_fields
FROM n
""")
def index_type_normalize(t: Tables) -> DataFrame:
    """Index settings of a catalog with one collection per part."""
    kind = F.col("p_size") % 7
    raw = (
        F.when(kind == 0, " hnsw").when(kind == 1, "").when(kind == 2, F.lit(None)).when(kind == 3, "Ivf_Flat ")
        .when(kind == 4, "IVF_PQ").when(kind == 5, "btree").otherwise("diskann")
    )
    unset = F.lit(0)
    catalog = t.part.select(
        F.col("p_partkey").alias("collection_id"), raw.alias("index_type"),
        F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(0).alias("ivf_nlist"),
        unset.alias("ivf_nprobe"), unset.alias("ivf_m"), unset.alias("ivf_nbits"),
        F.when(F.col("p_size") > 40, " INT8 ").otherwise("").alias("ivf_sq_type"),
    )
    return collections.index_settings(catalog).select("collection_id", "index_name", "index_error", "index_fields")


@query("""
WITH c AS (SELECT DISTINCT concat('c', label) AS collection_name, concat('warm.c', label) AS segment_id,
                  concat('c', label) AS workspace_id, CASE WHEN label = 3 THEN 32 ELSE 64 END AS dimension FROM embeddings
           UNION ALL SELECT 'empty', 'warm.empty', 'empty', 64)
SELECT collection_name, segment_id, workspace_id, dimension, 'HNSW' AS index_type, 'COSINE' AS metric_type,
       count(vec_id) AS n_vectors, coalesce(bool_and(dimension = len(embedding)), true) AS dimension_ok
FROM c LEFT JOIN fx_vectors USING (segment_id) GROUP BY 1, 2, 3, 4
""")
def collection_stats(t: Tables) -> DataFrame:
    """A collection per label, one of them declared too narrow, and one without vectors."""
    named = t.embeddings.select(
        F.concat(F.lit("c"), "label").alias("collection_name"), F.when(F.col("label") == 3, 32).otherwise(64).alias("dimension")
    ).distinct()
    empty = t.spark.range(1).select(F.lit("empty").alias("collection_name"), F.lit(64).alias("dimension"))
    catalog = named.unionByName(empty).withColumns({
        "segment_id": F.concat(F.lit("warm."), "collection_name"), "workspace_id": F.col("collection_name"),
        "index_type": F.lit("HNSW"), "metric_type": F.lit("COSINE"),
    })
    return collections.collection_stats(catalog, t.fx_vectors)


@query("""
WITH d AS (SELECT segment_id, CASE WHEN vec_id % 137 = 0 THEN 63 ELSE len(embedding) END AS dim FROM fx_vectors)
SELECT segment_id, CAST(min(dim) AS INTEGER) AS min_dim, CAST(max(dim) AS INTEGER) AS max_dim, 64 AS query_dim,
       min(dim) = 64 AND max(dim) = 64 AS matches
FROM d GROUP BY 1
""")
def dimension_check(t: Tables) -> DataFrame:
    """Segments with damaged vectors fail the check against a 64-dimensional query."""
    short = F.when(F.col("vec_id") % 137 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    rows = t.fx_vectors.withColumn("embedding", short)
    expected = t.fx_vectors.select("segment_id").distinct().withColumn("query_dim", F.lit(64))
    return collections.dimension_check(rows, expected)


# --- embedding models -------------------------------------------------------


class LetterModel:
    """A stand-in model SQL can repeat: the share of every letter in the text."""

    letters = "abcdefghijklmnopqrstuvwxyz"

    def embed_documents(self, texts: list[str]) -> list[list[float]]:
        return [self.embed_query(text) for text in texts]

    def embed_query(self, text: str) -> list[float]:
        return [(text.count(c) + text.count(c.upper())) / max(1, len(text)) for c in self.letters]


_LETTERS = (
    "list_transform(range(97, 123), lambda c: ((length({0}) - length(replace(replace({0}, chr(c::int), ''), chr(c::int - 32), '')))"
    " / greatest(length({0}), 1)::double)::float::double)"
)


def _cells(vectors: DataFrame, id_column: str) -> DataFrame:
    return vectors.select(id_column, F.posexplode("embedding").alias("dim", "value")).withColumn(
        "value", r6(F.col("value").cast("double"))
    )


@query(f"""
WITH e AS (SELECT memory_id, {_LETTERS.format('text')} AS e FROM fx_memory)
SELECT memory_id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS dim, round(unnest(e), 6) AS value FROM e
""")
def embed_batch(t: Tables) -> DataFrame:
    """Every memory text through the plugged-in model."""
    made = embedding.embed_documents(LetterModel, F.col("text"))
    return _cells(t.fx_memory.select("memory_id", made.alias("embedding")), "memory_id")


@query(f"""
WITH e AS (SELECT query_id, {_LETTERS.format('query_text')} AS e FROM fx_queries)
SELECT query_id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS dim, round(unnest(e), 6) AS value FROM e
""")
def embed_query(t: Tables) -> DataFrame:
    made = embedding.embed_queries(LetterModel, F.col("query_text"))
    return _cells(t.fx_queries.select("query_id", made.alias("embedding")), "query_id")


@query(f"""
SELECT doc_id, vec_id IS NOT NULL AS had_vector,
       round(list_sum(CASE WHEN vec_id IS NULL THEN {_LETTERS.format('text')} ELSE CAST(embedding AS DOUBLE[]) END), 6) + 0.0 AS vector_sum
FROM documents LEFT JOIN embeddings ON vec_id = doc_id
""")
def embed_if_missing(t: Tables) -> DataFrame:
    """Documents that already have a stored vector keep it."""
    rows = t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id"), "left").select(
        "doc_id", "text", F.col("vec_id").isNotNull().alias("had_vector"), "embedding"
    )
    full = embedding.embed_if_missing(rows, LetterModel, "text", "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return full.select("doc_id", "had_vector", r6(total).alias("vector_sum"))


def _texts(t: Tables) -> DataFrame:
    return t.documents.select(
        F.concat(F.lit("doc_"), "doc_id").alias("id"), F.col("text").alias("page_content"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"),
    )


def _store(t: Tables, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    vectors, events = work_dir(t.spark, "vectors"), work_dir(t.spark, "events")
    embedding.add_texts(texts, LetterModel, vectors, events, workspace_id="w_demo")
    return t.spark.read.parquet(vectors), t.spark.read.parquet(events)


@query(f"""
SELECT concat('doc_', doc_id) AS object_id, 'warm.default' AS segment_id, 'document' AS event_type, text AS page_content, lang,
       round(list_sum({_LETTERS.format('text')}), 6) AS vector_sum
FROM documents
""")
def add_texts(t: Tables) -> DataFrame:
    """Texts stored as vectors and as document events, joined back on the id."""
    vectors, events = _store(t, _texts(t))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return vectors.join(events, F.col("object_id") == F.col("event_id")).select(
        "object_id", "segment_id", "event_type", "payload.page_content",
        F.col("payload.metadata")["lang"].alias("lang"), r6(total).alias("vector_sum"),
    )


@query("""
SELECT lang <> 'en' AS own_id, count(*) AS n_documents, count(*) AS n_distinct, count(*) AS n_in_both FROM documents GROUP BY 1
""")
def add_documents(t: Tables) -> DataFrame:
    """Documents of one language bring no id and get a generated one, the same in both tables."""
    documents = _texts(t).withColumn("id", F.when(F.col("metadata")["lang"] != "en", F.col("id")))
    vectors, events = _store(t, documents)
    joined = vectors.join(events, F.col("object_id") == F.col("event_id"), "left")
    return joined.groupBy(F.col("object_id").startswith("doc_").alias("own_id")).agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_distinct("object_id").alias("n_distinct"),
        F.count("event_id").alias("n_in_both"),
    )


@query(f"""
WITH b AS (SELECT concat('doc_', doc_id) AS object_id, text, lang, e, sqrt(list_dot_product(e, e)) AS n FROM
           (SELECT *, {_LETTERS.format('text')} AS e FROM documents)),
q AS (SELECT query_id, e, sqrt(list_dot_product(e, e)) AS n FROM (SELECT query_id, {_LETTERS.format('query_text')} AS e FROM fx_queries)),
s AS (SELECT query_id, object_id, text AS page_content, lang,
             CASE WHEN q.n * b.n = 0 THEN 0 ELSE round(list_dot_product(q.e, b.e) / (q.n * b.n), 6) END AS score FROM q, b)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, object_id) AS rank FROM s) WHERE rank <= 4
""")
def similarity_search_with_score(t: Tables) -> DataFrame:
    """Query texts to documents through the model and the stored tables."""
    vectors, events = _store(t, _texts(t))
    found = embedding.similarity_search(t.fx_queries, vectors, events, LetterModel, k=4)
    return found.withColumn("lang", F.col("metadata")["lang"]).drop("metadata")


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN '' ELSE text END AS page_content,
       CASE doc_id % 5 WHEN 0 THEN concat('obj_', doc_id) WHEN 1 THEN concat('mem_', doc_id) WHEN 2 THEN concat('evt_', doc_id)
                       WHEN 3 THEN NULL ELSE concat('plain_', doc_id) END AS id,
       CASE WHEN doc_id % 5 < 4 THEN lang END AS lang,
       CASE doc_id % 5 WHEN 0 THEN round(n_chars / 7.0::double, 6) WHEN 1 THEN round(n_chars / 9.0::double, 6) ELSE 0.0::double END AS score
FROM documents
""")
def hit_projection(t: Tables) -> DataFrame:
    """Answer objects of every shape: with object, memory or event id, without any, and a bare id."""
    shape, number = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    body = F.to_json(F.struct(
        F.when(shape == 0, F.concat(F.lit("obj_"), number)).alias("object_id"),
        F.when(shape <= 1, F.concat(F.lit("mem_"), number)).alias("memory_id"),
        F.when(shape <= 2, F.concat(F.lit("evt_"), number)).alias("event_id"),
        F.when(shape == 0, F.col("n_chars") / 7.0).alias("score"),
        F.when(shape <= 1, F.col("n_chars") / 9.0).alias("distance"),
        F.struct(F.col("text").alias("page_content"), F.create_map(F.lit("lang"), F.col("lang")).alias("metadata")).alias("payload"),
    ))
    hits = t.documents.select("doc_id", F.when(shape == 4, F.concat(F.lit("plain_"), number)).otherwise(body).alias("body"))
    return embedding.project_hits(hits, "body").select(
        "doc_id", "page_content", F.col("metadata")["id"].alias("id"), F.col("metadata")["lang"].alias("lang"), "score"
    )


@query("""
SELECT doc_id, CASE WHEN lang = 'es' THEN '' WHEN lang = 'fr' THEN concat('onnx:', source) ELSE concat('tfidf:', lang) END AS family,
       CASE WHEN lang = 'es' THEN '' WHEN lang = 'fr' THEN 'onnx' ELSE 'tfidf' END AS provider,
       CASE WHEN lang = 'de' THEN NULL ELSE 256 END AS dim, lang = 'en' AS cross_dim_fusion
FROM documents
""")
def provenance_parse(t: Tables) -> DataFrame:
    """Markers per document: one language has no family, one no dimension, one names the family twice."""
    lang, none = F.col("lang"), F.lit(None).cast("string")
    lines = F.array(
        F.lit("  "),
        F.when(lang != "es", F.concat(F.lit(" embedding_runtime_family=tfidf:"), lang, F.lit("\t"))).otherwise(none),
        F.when(lang == "de", "embedding_runtime_dim=wide").otherwise("embedding_runtime_dim=256"),
        F.when(lang == "en", "cross_dim_fusion=rrf_result_layer").otherwise("no_fusion"),
        F.when(lang == "fr", F.concat(F.lit("embedding_runtime_family=onnx:"), "source")).otherwise(none),
    )
    info = t.documents.select("doc_id", runtime_info(lines).alias("i"))
    return info.select("doc_id", "i.family", "i.provider", "i.dim", "i.cross_dim_fusion")
