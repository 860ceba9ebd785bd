"""Sources, sinks, ingest, validation and accounting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.defaults import DEFAULT_BATCH_SIZE
from engrama.functions.vectors import r6
from engrama.operators import ingest
from engrama.plans.registry import query
from engrama.plans.views import Tables
from engrama.session import work_dir
from engrama.sources import bulk_load, fbin, snapshots, wal

# --- vector files -----------------------------------------------------------


def _vector_files(t: Tables, **options) -> str:
    """All stored vectors, in id order, as vector files in a fresh folder."""
    path = work_dir(t.spark, "fbin")
    fbin.write(t.embeddings, path, "embedding", order="vec_id", **options)
    return path


_SCANNED = """
SELECT row_number() OVER (ORDER BY vec_id) - 1 AS global_row, 64 AS dim,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vector_sum,
       embedding[1]::double AS first_value, embedding[64]::double AS last_value
FROM embeddings
"""


def _scanned(t: Tables, path: str, **options) -> DataFrame:
    rows = fbin.read(t.spark, path, **options)
    offsets = fbin.file_offsets(fbin.read(t.spark, path, mode="header"))
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.join(offsets, "path").select(
        (F.col("first_row") + F.col("row_index")).alias("global_row"), "dim", r6(total).alias("vector_sum"),
        F.element_at("vector", 1).cast("double").alias("first_value"),
        F.element_at("vector", -1).cast("double").alias("last_value"),
    )


@query(_SCANNED)
def fbin_scan(t: Tables) -> DataFrame:
    """Vector files read back in row ranges much smaller than a file."""
    return _scanned(t, _vector_files(t), splitBytes=16 * 1024)


@query(_SCANNED)
def fbin_sink(t: Tables) -> DataFrame:
    """Vector files closed at a small size, so every task writes several."""
    return _scanned(t, _vector_files(t, fileBytes=16 * 1024))


@query("""
SELECT count(*) AS n, count(*) AS n_loaded, 64 AS dim, true AS complete FROM embeddings
""")
def fbin_row_count(t: Tables) -> DataFrame:
    """Rows promised by the headers against rows loaded, over all files."""
    path = _vector_files(t)
    per_file = fbin.reconcile(fbin.read(t.spark, path, mode="header"), fbin.read(t.spark, path))
    return per_file.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("n_loaded").alias("n_loaded"), F.bool_and("complete").alias("complete")
    )


@query("""
WITH r AS (SELECT embedding, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings)
SELECT concat('evt_my_data_vectors_', lpad(i::varchar, 8, '0')) AS event_id,
       'ingest_my data_vectors.fbin' AS session_id,
       concat('dataset=vectors.fbin dataset_name:my data row:', i, ' dim:64 dtype:float32 head:',
              array_to_string(list_transform(embedding[1:8], lambda x: (x::double)::varchar), ' ')) AS text,
       i AS row_index, 'batch_one' AS import_batch_id
FROM r
""")
def fbin_event_build(t: Tables) -> DataFrame:
    """Every row of a folder of vector files as an event; rows count on over the files, as those of one table."""
    path = _vector_files(t)
    offsets = fbin.file_offsets(fbin.read(t.spark, path, mode="header"))
    rows = fbin.read(t.spark, path).join(offsets, "path").withColumns(
        {"row_index": F.col("first_row") + F.col("row_index"), "file_name": F.lit("vectors.fbin")}
    )
    events = bulk_load.vector_events(rows, "my data", "w_demo", "batch_one")
    return events.select("event_id", "session_id", "payload.text", "payload.row_index", "payload.import_batch_id")


@query("""
SELECT count(*) AS n_rows, count(*) AS n_events, count(*) AS n_distinct, 1 AS dry_run, 1 AS n_batches FROM embeddings
""")
def bulk_upload(t: Tables) -> DataFrame:
    """Load all vector files into an event table and count what arrived."""
    path, table = _vector_files(t), work_dir(t.spark, "events")
    dry = bulk_load.bulk_upload(t.spark, "vectors", "w_demo", path, table, dry_run=True)
    n = bulk_load.bulk_upload(t.spark, "vectors", "w_demo", path, table)
    return t.spark.read.parquet(table).agg(
        F.lit(n).cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("event_id").alias("n_distinct"), F.lit(dry).alias("dry_run"),
        F.count_distinct("payload.import_batch_id").cast("int").alias("n_batches"),
    )


@query("""
SELECT segment_id, object_id, 'IVF_FLAT' AS index_type, 16 AS ivf_nlist,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vector_sum
FROM fx_vectors
""")
def vector_matrix_ingest(t: Tables) -> DataFrame:
    """Vectors written as a segment table, one folder per segment, and read back."""
    from engrama.operators.collections import segment_table

    table = work_dir(t.spark, "segments")
    segment_table(t.fx_vectors, index_type=" ivf_flat ", ivf_nlist=16, write_to=table)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return t.spark.read.parquet(table).select(
        "segment_id", "object_id", "index_type", "ivf_nlist", r6(total).alias("vector_sum")
    )


@query("""
WITH r AS (SELECT coalesce(vec_id, doc_id) AS k, embedding AS vector, text,
                  CASE WHEN label < 3 THEN concat('id_', vec_id) END AS id,
                  CASE WHEN label < 6 THEN concat('obj_', vec_id) END AS object_id
           FROM embeddings FULL JOIN documents ON vec_id = doc_id),
n AS (SELECT *, row_number() OVER (ORDER BY k) - 1 AS i FROM r)
SELECT 'vector' AS route, coalesce(id, object_id, concat('notes_', i)) AS object_id, NULL AS text
FROM n WHERE vector IS NOT NULL
UNION ALL SELECT 'document', id, text FROM n WHERE vector IS NULL AND text <> ''
""")
def record_insert_route(t: Tables) -> DataFrame:
    """Mixed records split into vectors and documents, with default ids."""
    label = F.col("label")
    records = t.embeddings.join(t.documents, F.col("vec_id") == F.col("doc_id"), "full").select(
        F.coalesce("vec_id", "doc_id").alias("k"), F.col("embedding").alias("vector"), "text",
        F.when(label < 3, F.concat(F.lit("id_"), "vec_id")).alias("id"),
        F.when(label < 6, F.concat(F.lit("obj_"), "vec_id")).alias("object_id"),
    )
    vectors, documents = ingest.route_records(records, "notes", ["k"])
    return vectors.select(F.lit("vector").alias("route"), "object_id", F.lit(None).cast("string").alias("text")).unionByName(
        documents.select(F.lit("document").alias("route"), F.col("id").alias("object_id"), "text")
    )


# --- event log --------------------------------------------------------------


def _log(t: Tables) -> str:
    path = work_dir(t.spark, "log")
    wal.write_log(t.fx_events.select("lsn", "event_id", "event_type", "payload"), path)
    return path


@query("""
SELECT lsn, event_id, event_type, (payload::json ->> 'k')::int AS k FROM fx_events
""")
def wal_log_scan(t: Tables) -> DataFrame:
    """The whole log written as frames and scanned back."""
    events = wal.scan_log(t.spark, _log(t)).where(~F.col("parse_error"))
    event = F.from_json("event", "event_id string, event_type string, payload string")
    return events.select("lsn", event.alias("e")).select(
        "lsn", "e.event_id", "e.event_type", F.get_json_object("e.payload", "$.k").cast("int").alias("k")
    )


@query("""
WITH m AS (SELECT CAST(floor(median(lsn)) AS BIGINT) AS from_lsn FROM fx_events)
SELECT lsn, event_id FROM fx_events, m WHERE lsn >= from_lsn
""")
def wal_tail(t: Tables) -> DataFrame:
    """The log from the middle position on, in order."""
    middle = t.fx_events.agg(F.floor(F.median("lsn")).cast("bigint")).first()[0]
    tail = wal.scan_log(t.spark, _log(t), from_lsn=middle)
    return tail.select("lsn", F.get_json_object("event", "$.event_id").alias("event_id")).orderBy("lsn")


@query("""
SELECT workspace_id, count(*) AS n_rows, count(*) AS n_read, true AS verified FROM fx_memory GROUP BY 1
""")
def snapshot_export(t: Tables) -> DataFrame:
    """A partitioned export checked by count and checksum after reading it back."""
    return snapshots.export_snapshot(t.fx_memory, work_dir(t.spark, "export"), "workspace_id")


# --- events -----------------------------------------------------------------


@query("""
SELECT CASE WHEN event_type IN ('signup', 'view') THEN concat('evt_emb_w_', user_id % 5, '_', epoch_us(ts) // 1000)
            ELSE concat('evt_', event_id) END AS event_id,
       't_demo' AS tenant_id, concat('w_', user_id % 5) AS workspace_id,
       CASE WHEN event_type = 'error' THEN concat('ingest_w_', user_id % 5) ELSE concat('s_', user_id) END AS session_id,
       CASE WHEN event_type = 'view' THEN 'observation' ELSE event_type END AS event_type,
       date_trunc('second', ts) AS event_time, true AS times_equal,
       CASE WHEN event_type = 'purchase' THEN 'bought' ELSE event_type END AS text, props AS props,
       'text_ingest' AS source, 1 AS version
FROM events
""")
def event_canonicalize(t: Tables) -> DataFrame:
    """Raw events with gaps in every optional field."""
    kind = F.col("event_type")
    props = F.create_map(F.lit("props"), F.col("props"))
    raw = t.events.select(
        F.when(kind == "signup", "  ").when(kind != "view", F.concat(F.lit(" evt_"), "event_id", F.lit(" "))).alias("event_id"),
        F.lit(None).cast("string").alias("tenant_id"),
        F.concat(F.lit("w_"), (F.col("user_id") % 5).cast("string")).alias("workspace_id"),
        F.lit(None).cast("string").alias("agent_id"),
        F.when(kind == "error", "").otherwise(F.concat(F.lit("s_"), "user_id")).alias("session_id"),
        F.when(kind != "view", kind).alias("event_type"),
        kind.alias("text"),
        F.when(kind == "purchase", F.map_concat(props, F.create_map(F.lit("text"), F.lit("bought")))).otherwise(props).alias("payload"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("version"), "ts",
    )
    events = ingest.canonical_events(raw, F.col("ts"), default_source="text_ingest", default_agent="text_agent")
    same = (F.col("event_time") == F.col("ingest_time")) & (F.col("event_time") == F.col("visible_time"))
    return events.select(
        "event_id", "tenant_id", "workspace_id", "session_id", "event_type", "event_time", same.alias("times_equal"),
        F.col("payload")["text"].alias("text"), F.col("payload")["props"].alias("props"), "source", "version",
    )


@query("""
WITH s AS (SELECT page_id, trim(regexp_replace(url, '[^A-Za-z0-9_-]+', '_', 'g'), '_') AS d,
                  trim(regexp_replace(html, '[^A-Za-z0-9_-]+', '_', 'g'), '_') AS f FROM pages)
SELECT page_id, concat('evt_', CASE d WHEN '' THEN 'dataset' ELSE d END, '_',
                       CASE f WHEN '' THEN 'file' ELSE f END, '_', lpad(page_id::varchar, 8, '0')) AS event_id,
       concat('evt_', CASE d WHEN '' THEN 'dataset' ELSE d END, '_batch_', CASE f WHEN '' THEN 'file' ELSE f END,
              '_', lpad(page_id::varchar, 8, '0')) AS batch_event_id
FROM s
""")
def event_id_slug(t: Tables) -> DataFrame:
    """Event ids from page addresses; the empty batch name falls back to its word."""
    stem = F.col("html")
    return t.pages.select(
        "page_id",
        ingest.event_slug_id(F.col("url"), stem, F.col("page_id")).alias("event_id"),
        ingest.event_slug_id(F.col("url"), stem, F.col("page_id"), F.lit("//")).alias("batch_event_id"),
    )


_REDELIVERED = """
r AS (SELECT event_id, workspace_id, agent_id, session_id, event_time, importance, version FROM fx_events
      UNION ALL SELECT event_id, workspace_id, agent_id, session_id, event_time, importance + 1, version + 1
      FROM fx_events WHERE event_type = 'purchase')"""


def _redelivered(t: Tables) -> DataFrame:
    again = t.fx_events.where("event_type = 'purchase'").withColumns(
        {"importance": F.col("importance") + 1, "version": F.col("version") + 1}
    )
    return t.fx_events.unionByName(again)


@query(f"""
WITH {_REDELIVERED}
SELECT concat('mem_', event_id) AS memory_id, workspace_id, agent_id, session_id, importance, event_id AS source_event,
       true AS is_active, 'hot' AS tier, version, event_time
FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, event_time DESC) = 1
""")
def materialize_memory(t: Tables) -> DataFrame:
    """Memories from an event log in which purchases were delivered again as a second version."""
    memory = ingest.materialize_memory(_redelivered(t))
    return memory.withColumn("source_event", F.element_at("source_event_ids", 1)).drop("source_event_ids")


@query("""
SELECT state_key, state_id, state_value, event_time FROM fx_states
QUALIFY row_number() OVER (PARTITION BY state_key ORDER BY event_time DESC, state_id DESC) = 1
""")
def upsert_latest(t: Tables) -> DataFrame:
    """Finished states as the stored table, all others as the incoming batch."""
    stored = t.fx_states.where("state_value = 'F'")
    incoming = t.fx_states.where("state_value <> 'F'")
    return ingest.upsert_latest(stored, incoming, ["state_key"], [F.desc("event_time"), F.desc("state_id")])


# --- documents --------------------------------------------------------------


@query("""
SELECT doc_id, CAST(i.i AS BIGINT) AS segment_index,
       greatest(length(text) - 51, 0) // 450 + 1 AS segment_total,
       substring(text, CAST(i.i * 450 + 1 AS BIGINT), 500) AS chunk
FROM documents, LATERAL unnest(range(0, greatest(length(text) - 51, 0) // 450 + 1)) AS i(i)
""")
def document_chunk(t: Tables) -> DataFrame:
    return ingest.document_chunks(t.documents, ["doc_id"], "text")


_PARTS = """
d AS (SELECT l_orderkey AS upload_batch_id, l_linenumber - 1 AS segment_index,
             max(l_linenumber) OVER (PARTITION BY l_orderkey) AS segment_total,
             concat(l_partkey, ':', l_suppkey) AS text, l_shipdate FROM lineitem),
p AS (SELECT * FROM d QUALIFY row_number() OVER (
        PARTITION BY upload_batch_id, segment_index ORDER BY l_shipdate DESC, text DESC) = 1)"""


def _parts(t: Tables) -> DataFrame:
    """Order lines as parts of an upload: lines repeat and numbers have gaps."""
    totals = t.lineitem.groupBy(F.col("l_orderkey").alias("upload_batch_id")).agg(
        F.max("l_linenumber").alias("segment_total")
    )
    delivered = t.lineitem.select(
        F.col("l_orderkey").alias("upload_batch_id"), (F.col("l_linenumber") - 1).alias("segment_index"),
        F.concat("l_partkey", F.lit(":"), "l_suppkey").alias("text"), "l_shipdate",
    )
    return ingest.distinct_parts(
        delivered.join(totals, "upload_batch_id"), [F.desc("l_shipdate"), F.desc("text")]
    )


@query(f"""
WITH {_PARTS}
SELECT upload_batch_id, count(*) AS n_received, CAST(max(segment_total) AS BIGINT) AS segment_total,
       CAST(max(segment_index) AS BIGINT) AS last_index, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       max(segment_total) - count(*) AS n_missing, count(*) = max(segment_total) AS complete
FROM p GROUP BY 1
""")
def document_parts(t: Tables) -> DataFrame:
    """Which uploads are complete, and how many parts the others lack."""
    return ingest.upload_status(_parts(t))


@query(f"""
WITH {_PARTS},
e AS (SELECT upload_batch_id, unnest(range(0, max(segment_total))) AS segment_index FROM p GROUP BY 1)
SELECT upload_batch_id, CAST(segment_index AS BIGINT) AS segment_index FROM e
ANTI JOIN p USING (upload_batch_id, segment_index)
""")
def document_parts_missing(t: Tables) -> DataFrame:
    return ingest.missing_parts(_parts(t))


@query(f"""
WITH {_PARTS}
SELECT upload_batch_id, page, string_agg(text, chr(10) ORDER BY segment_index) AS text FROM (
  SELECT *, CAST(floor((sum(length(text) + 1) OVER w - length(text) - 1) / 1000000) AS BIGINT) AS page
  FROM p SEMI JOIN (SELECT upload_batch_id FROM p GROUP BY 1 HAVING count(*) = max(segment_total)) USING (upload_batch_id)
  WINDOW w AS (PARTITION BY upload_batch_id ORDER BY segment_index)) GROUP BY 1, 2
""")
def document_parts_text(t: Tables) -> DataFrame:
    """Ordered text pages of the complete uploads."""
    return ingest.assembled_text(_parts(t))


# --- batches ----------------------------------------------------------------


@query("""
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT i // 500 AS batch_index, min(i) AS batch_start, max(i) + 1 AS batch_end,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM n GROUP BY 1
""")
def batch_split(t: Tables) -> DataFrame:
    """Consecutive batches of 500 in key order."""
    batched = ingest.batch_ranges(t.orders.select("o_orderkey"), ["o_orderkey"], DEFAULT_BATCH_SIZE)
    return batched.groupBy("batch_index").agg(
        F.min("row_index").alias("batch_start"), (F.max("row_index") + 1).alias("batch_end"),
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"),
    )


_BAD = """
bad AS (SELECT *, CASE WHEN vec_id % 137 = 0 THEN embedding[1:63] ELSE embedding END AS e FROM fx_vectors),
nb AS (SELECT *, len(e) AS dim, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM bad),
ck AS (SELECT *, i // 30 AS batch_index, first_value(dim) OVER (PARTITION BY i // 30 ORDER BY i) AS first_dim FROM nb),
er AS (SELECT *, CASE WHEN dim <> first_dim THEN 'dimension differs from the batch' END AS err FROM ck),
vb AS (SELECT batch_index, min(i) AS batch_start, max(i) + 1 AS batch_end, max(err) AS error FROM er GROUP BY 1),
va AS (SELECT *, CASE WHEN error IS NULL THEN batch_end - batch_start ELSE 0 END AS accepted_count,
              CASE WHEN error IS NULL THEN 0 ELSE batch_end - batch_start END AS failed_count,
              CASE WHEN error IS NOT NULL THEN 'ValueError' END AS error_type FROM vb)"""


def _damaged(t: Tables) -> DataFrame:
    """All vectors, some of them one value short."""
    short = F.when(F.col("vec_id") % 137 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    return t.fx_vectors.withColumn("embedding", short)


def _vector_batches(t: Tables) -> DataFrame:
    batched = ingest.batch_ranges(_damaged(t), ["vec_id"], 30)
    checked = ingest.validate_vectors(batched, ["batch_index"], "row_index")
    return ingest.whole_batch_accounting(checked, "reject_reason")


@query(f"""
WITH {_BAD}
SELECT * FROM va
""")
def vector_batch_accounting(t: Tables) -> DataFrame:
    """One bad vector fails its whole batch of 30; the other batches load."""
    return _vector_batches(t)


_EVENT_BATCHES = """
ne AS (SELECT event_type, row_number() OVER (ORDER BY lsn) - 1 AS i FROM fx_events),
ea AS (SELECT i // 500 AS batch_index, min(i) AS batch_start, max(i) + 1 AS batch_end,
              count(*) FILTER (event_type <> 'error') AS accepted_count,
              count(*) FILTER (event_type = 'error') AS failed_count,
              min(i) FILTER (event_type = 'error') AS first_error_index
       FROM ne GROUP BY 1)"""


def _event_batches(t: Tables) -> DataFrame:
    batched = ingest.batch_ranges(t.fx_events.select("lsn", "event_type"), ["lsn"], DEFAULT_BATCH_SIZE)
    failing = batched.withColumn("error", F.when(F.col("event_type") == "error", "event refused"))
    return ingest.row_accounting(failing, "error")


@query(f"""
WITH {_EVENT_BATCHES}
SELECT * FROM ea
""")
def event_batch_accounting(t: Tables) -> DataFrame:
    """Only the refused events fail, wherever they sit in their batch."""
    return _event_batches(t)


def _failing_events(t: Tables) -> DataFrame:
    batched = ingest.batch_ranges(t.fx_events.select("lsn", "event_id", "event_type"), ["lsn"], DEFAULT_BATCH_SIZE)
    return batched.withColumn("error", F.when(F.col("event_type") == "error", "event refused"))


_NUMBERED_EVENTS = "SELECT event_id, event_type, row_number() OVER (ORDER BY lsn) - 1 AS i FROM fx_events"


@query(f"""
SELECT i // 500 AS batch_index, i AS event_index, 'ValueError' AS error_type, 'event refused' AS error
FROM ({_NUMBERED_EVENTS}) WHERE event_type = 'error'
""")
def event_batch_errors(t: Tables) -> DataFrame:
    """Every refused event as a row."""
    return ingest.error_rows(_failing_events(t), "error")


@query(f"""
SELECT i // 500 AS batch_index, event_id AS accepted_id FROM ({_NUMBERED_EVENTS}) WHERE event_type <> 'error'
""")
def event_batch_accepted(t: Tables) -> DataFrame:
    """The ids that were taken, by batch."""
    return ingest.accepted_ids(_failing_events(t), "error", "event_id")


@query(f"""
WITH {_BAD}
SELECT 0 AS operation, batch_index, i AS event_index, err AS error FROM er WHERE err IS NOT NULL
UNION ALL
SELECT 1, i // 500, i, 'event refused' FROM ({_NUMBERED_EVENTS}) WHERE event_type = 'error'
""")
def batch_errors_merge(t: Tables) -> DataFrame:
    """The errors of the vector load and of the event load in one table."""
    checked = ingest.validate_vectors(ingest.batch_ranges(_damaged(t), ["vec_id"], 30), ["batch_index"], "row_index")
    parts = [ingest.error_rows(checked, "reject_reason"), ingest.error_rows(_failing_events(t), "error")]
    return ingest.merge_rows(parts).select("operation", "batch_index", "event_index", "error")


@query(f"""
WITH {_BAD}, {_EVENT_BATCHES},
pooled AS (SELECT accepted_count, failed_count FROM va UNION ALL SELECT accepted_count, failed_count FROM ea)
SELECT CAST(sum(accepted_count + failed_count) AS BIGINT) AS total_count,
       CAST(sum(accepted_count) AS BIGINT) AS accepted_count, CAST(sum(failed_count) AS BIGINT) AS failed_count,
       count(*) AS batch_count, sum(failed_count) = 0 AS success
FROM pooled
""")
def batch_result_merge(t: Tables) -> DataFrame:
    """The vector load and the event load as one result."""
    return ingest.merge_totals([ingest.batch_totals(_vector_batches(t)), ingest.batch_totals(_event_batches(t))])


@query(f"""
WITH {_BAD},
f AS (SELECT *, row_number() OVER (ORDER BY batch_index) AS n FROM va WHERE error IS NOT NULL)
SELECT concat('Batch operation failed: ', sum(failed_count), ' items failed across ', count(*), ' batches. Errors: ',
              string_agg(concat('batch ', batch_index, ': ', error), '; ' ORDER BY batch_index) FILTER (n <= 5),
              CASE WHEN count(*) > 5 THEN concat(' ... and ', count(*) - 5, ' more errors') ELSE '' END) AS message
FROM f HAVING count(*) > 0
""")
def error_summary(t: Tables) -> DataFrame:
    """The message shown for the failed vector batches."""
    return ingest.error_summary(_vector_batches(t).where("failed_count > 0"))


@query("""
WITH b AS (SELECT *, CASE WHEN vec_id % 137 = 0 THEN embedding[1:63] ELSE embedding END AS e FROM fx_vectors),
n AS (SELECT *, (row_number() OVER (PARTITION BY segment_id ORDER BY vec_id) - 1) // 4194304 AS frame FROM b),
f AS (SELECT *, len(e) AS dim, first_value(len(e)) OVER (PARTITION BY segment_id, frame ORDER BY vec_id) AS fd FROM n)
SELECT segment_id, object_id, CAST(dim AS INTEGER) AS dim,
       CASE WHEN dim <> fd THEN 'dimension differs from the batch' END AS reject_reason
FROM f
""")
def vector_validate(t: Tables) -> DataFrame:
    """Per-row verdicts, each segment being cut into frames; rows with a reason go to quarantine."""
    framed = ingest.framed(_damaged(t), ["segment_id"], "vec_id")
    checked = ingest.validate_vectors(framed, ["segment_id", "frame"], "vec_id")
    return checked.select("segment_id", "object_id", "dim", "reject_reason")


@query("""
WITH g AS (SELECT segment_id, vec_id, CASE WHEN segment_id IN ('warm.c0', 'warm.c1') THEN object_id
                                           WHEN segment_id = 'warm.c2' THEN '' END AS object_id FROM fx_vectors),
n AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY vec_id) - 1 AS i FROM g)
SELECT segment_id, vec_id,
       CASE WHEN coalesce(object_id, '') <> '' THEN object_id ELSE concat(segment_id, '_', i) END AS object_id
FROM n
""")
def default_object_ids(t: Tables) -> DataFrame:
    """Two segments bring ids, one brings empty ids, the others none."""
    segment = F.col("segment_id")
    given = F.when(segment.isin("warm.c0", "warm.c1"), F.col("object_id")).when(segment == "warm.c2", "")
    rows = t.fx_vectors.select("segment_id", "vec_id", given.alias("object_id"))
    return ingest.default_object_ids(rows, ["vec_id"])
