"""Ingest: canonical events, document chunks and parts, record routing, upserts, accounting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import (
    CHUNK_OVERLAP, CHUNK_SIZE, DEFAULT_BATCH_SIZE, DEFAULT_EVENT_TYPE, DEFAULT_TENANT, ERRORS_SHOWN,
    MAX_BATCH_VECTORS, MAX_ID_BYTES, MAX_QUERY_BATCH, MAX_VECTOR_DIM,
)
from engrama.functions.text import blank_to, slug
from engrama.operators.numbering import batch_of, dense_number, running_total
from engrama.session import join_null_safe

# fixed values: texts and id formats callers see
EVENT_ID_FORMAT = "evt_%s_%s_%08d"
BATCH_EVENT_ID_FORMAT = "evt_%s_%s_%s_%08d"
EVENT_TEXT_FORMAT = "dataset=%s dataset_name:%s row:%d dim:%d dtype:float32 head:%s"
FAILURE_FORMAT = "Batch operation failed: %d items failed across %d batches. Errors: %s"

PAGE_CHARS = 1_000_000  # text pages of an assembled upload hold about so many characters


# --- events -----------------------------------------------------------------

def merge_maps(base: Column, extra: Column) -> Column:
    """Map union where ``extra`` wins; a null ``extra`` adds nothing."""
    extra = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra)


def canonical_events(raw: DataFrame, now: Column, default_source: str, default_agent: str) -> DataFrame:
    """Fill the event defaults; ``raw`` has nullable id, scope, type, text, payload map, source and version."""
    stamp = F.date_trunc("second", now).cast("timestamp_ntz")
    generated = F.concat(F.lit("evt_emb_"), F.col("workspace_id"), F.lit("_"), epoch_millis(now).cast("string"))
    session = F.when(F.coalesce(F.col("session_id"), F.lit("")) == "", F.concat(F.lit("ingest_"), "workspace_id"))
    payload = merge_maps(F.create_map(F.lit("text"), F.col("text")), F.col("payload"))
    return raw.select(
        blank_to(F.col("event_id"), generated).alias("event_id"),
        F.coalesce("tenant_id", F.lit(DEFAULT_TENANT)).alias("tenant_id"),
        "workspace_id",
        F.coalesce("agent_id", F.lit(default_agent)).alias("agent_id"),
        session.otherwise(F.col("session_id")).alias("session_id"),
        F.coalesce("event_type", F.lit(DEFAULT_EVENT_TYPE)).alias("event_type"),
        stamp.alias("event_time"), stamp.alias("ingest_time"), stamp.alias("visible_time"),
        payload.alias("payload"),
        F.coalesce("source", F.lit(default_source)).alias("source"),
        F.coalesce("version", F.lit(1)).alias("version"),
    )


def epoch_millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def event_slug_id(dataset: Column, stem: Column, seq: Column, import_batch: Column | None = None) -> Column:
    """Stable event id of a bulk row; with ``import_batch`` it is unique per load, without it repeats."""
    parts = [slug(dataset, "dataset")]
    if import_batch is not None:
        parts.append(slug(import_batch, "batch"))
    parts.append(slug(stem, "file"))
    pattern = EVENT_ID_FORMAT if import_batch is None else BATCH_EVENT_ID_FORMAT
    return F.format_string(pattern, *parts, seq)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def materialize_memory(events: DataFrame) -> DataFrame:
    """Newest version of every event as a memory row."""
    newest = Window.partitionBy("event_id").orderBy(F.desc("version"), F.desc("event_time"))
    latest = events.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1)
    return latest.select(
        F.concat(F.lit("mem_"), "event_id").alias("memory_id"),
        "workspace_id", "agent_id", "session_id",
        F.coalesce("importance", F.lit(1.0)).alias("importance"),
        F.array("event_id").alias("source_event_ids"),
        F.lit(True).alias("is_active"), F.lit("hot").alias("tier"), "version", "event_time",
    )


def upsert_latest(current: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """Create or replace by key; each task first keeps one row per key, so hot keys shrink before the shuffle."""
    ranking = Window.partitionBy(*keys).orderBy(*newest)
    pooled = current.unionByName(incoming)
    return pooled.withColumn("_n", F.row_number().over(ranking)).where(F.col("_n") == 1).drop("_n")


# --- documents --------------------------------------------------------------

def document_chunks(
    documents: DataFrame, id_columns: Sequence[str], text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """``(*id_columns, segment_index, segment_total, chunk)`` of overlapping character windows."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than the chunk size")
    last_start = F.greatest(F.length(text) - (overlap + 1), F.lit(0))
    starts = F.sequence(F.lit(0), last_start, F.lit(size - overlap))
    exploded = documents.select(
        *id_columns, text, F.size(starts).cast("bigint").alias("segment_total"),
        F.posexplode(starts).alias("_i", "_start"),
    )
    return exploded.select(
        *id_columns, F.col("_i").cast("bigint").alias("segment_index"), "segment_total",
        F.substring(F.col(text), F.col("_start") + 1, F.lit(size)).alias("chunk"),
    )


def distinct_parts(parts: DataFrame, newest: Sequence[Column]) -> DataFrame:
    """One row per (upload, segment): the newest delivery."""
    ranking = Window.partitionBy("upload_batch_id", "segment_index").orderBy(*newest)
    return parts.withColumn("_n", F.row_number().over(ranking)).where(F.col("_n") == 1).drop("_n")


def upload_status(parts: DataFrame) -> DataFrame:
    """Received and missing parts of every upload; takes one row per part."""
    summary = parts.groupBy("upload_batch_id").agg(
        F.count(F.lit(1)).alias("n_received"), F.max("segment_total").cast("bigint").alias("segment_total"),
        F.max("segment_index").cast("bigint").alias("last_index"), F.sum(F.length("text")).alias("n_chars"),
    )
    return summary.withColumn("n_missing", F.col("segment_total") - F.col("n_received")).withColumn(
        "complete",
        (F.col("n_received") == F.col("segment_total")) & (F.col("last_index") == F.col("segment_total") - 1),
    )


def missing_parts(parts: DataFrame) -> DataFrame:
    """``(upload_batch_id, segment_index)`` of every part still to come."""
    expected = upload_status(parts).select(
        "upload_batch_id",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("segment_total") - 1)).alias("segment_index"),
    )
    received = parts.select("upload_batch_id", F.col("segment_index").cast("bigint").alias("segment_index"))
    return expected.join(received, ["upload_batch_id", "segment_index"], "left_anti")


def assembled_text(parts: DataFrame, page_chars: int = PAGE_CHARS) -> DataFrame:
    """``(upload_batch_id, page, text)`` of complete uploads: their parts in order, joined by newlines.

    A page takes neighbouring parts up to about ``page_chars`` characters (at least one part), so an
    upload of any size comes out whole and no row grows with it; pages joined by newlines are the text.
    """
    complete = upload_status(parts).where("complete").select("upload_batch_id")
    whole = parts.join(complete, "upload_batch_id", "left_semi").select("upload_batch_id", "segment_index", "text")
    sized = whole.withColumn("_chars", F.length("text").cast("bigint") + 1)
    placed = running_total(sized, ["upload_batch_id"], ["segment_index"], "_chars", "_upto")
    paged = placed.withColumn("page", F.floor((F.col("_upto") - F.col("_chars")) / F.lit(page_chars)).cast("bigint"))
    pieces = F.array_sort(F.collect_list(F.struct("segment_index", "text")))  # of one page
    pages = paged.groupBy("upload_batch_id", "page").agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text")
    )
    return pages


# --- records and ids --------------------------------------------------------

def numbered_rows(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """``dense_number`` where texts, vectors and other columns without a fixed size stay out of the sort and its checkpoint.

    They are joined back by ``keys + order``, which must then be unique.
    """
    taken = [*keys, *order]
    loose = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if not any(isinstance(f.dataType, loose) for f in rows.schema if f.name not in taken):
        return dense_number(rows, order, keys, name)
    return join_null_safe(rows, dense_number(rows.select(*taken), order, keys, name), taken)


def route_records(records: DataFrame, collection: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records with a vector go to the vector table, others with text become documents, the rest is dropped.

    A record's default id holds its place in ``order``, which must be unique. Places
    are joined only to vectors that bring no id.
    """
    given = F.coalesce("id", "object_id")
    held = records.where(F.col("vector").isNotNull())
    places = dense_number(records.select(*order), order, name="_i")
    default_id = F.concat(F.lit(f"{collection}_"), F.col("_i").cast("string"))
    own = held.where(given.isNotNull()).select(given.alias("object_id"), F.col("vector").alias("embedding"))
    named = join_null_safe(held.where(given.isNull()), places, list(order)).select(
        default_id.alias("object_id"), F.col("vector").alias("embedding")
    )
    vectors = own.unionByName(named)
    has_text = F.coalesce(F.col("text"), F.lit("")) != ""
    documents = records.where(F.col("vector").isNull() & has_text).select(
        F.lit(collection).alias("workspace_id"), "id", "text"
    )
    return vectors, documents


def default_object_ids(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``object_id`` where given, else the segment and the row's place in it.

    Only rows without an id are joined with their places; ``order`` must be unique within a segment.
    """
    taken = ["segment_id", *order]
    places = dense_number(rows.select(*taken), order, keys=["segment_id"], name="_i")
    given = F.coalesce(F.col("object_id"), F.lit("")) != ""
    generated = F.concat("segment_id", F.lit("_"), F.col("_i").cast("string"))
    named = join_null_safe(rows.where(~given), places, taken).withColumn("object_id", generated).drop("_i")
    return rows.where(given).unionByName(named)


# --- validation and accounting ----------------------------------------------

def framed(rows: DataFrame, keys: Sequence[str], order: str, frame_rows: int = MAX_BATCH_VECTORS) -> DataFrame:
    """Add ``frame``: the rows of each key in order, cut into frames of at most ``frame_rows``.

    ``order`` must be unique within a key.
    """
    numbered = numbered_rows(rows, [order], keys, "_i")
    return numbered.withColumn("frame", F.floor(F.col("_i") / frame_rows).cast("bigint")).drop("_i")


def check_query(dim: int, n_queries: int, n_ids: int | None = None) -> None:
    """Refuse a query frame that no server takes: its dimension, its size and its ids."""
    if not 0 < dim <= MAX_VECTOR_DIM:
        raise ValueError(f"a query needs 1 to {MAX_VECTOR_DIM} dimensions, not {dim}")
    if not 0 < n_queries <= MAX_QUERY_BATCH:
        raise ValueError(f"a frame takes 1 to {MAX_QUERY_BATCH} queries, not {n_queries}")
    if n_ids is not None and n_ids != n_queries:
        raise ValueError(f"{n_ids} ids for {n_queries} vectors")


def validate_vectors(rows: DataFrame, batch: Sequence[str], order: str) -> DataFrame:
    """Add ``dim`` and ``reject_reason`` (null when the row is good); ``batch`` names one frame, see ``framed``."""
    sized = rows.withColumn("dim", F.coalesce(F.size("embedding"), F.lit(0)))
    per_batch = sized.groupBy(*batch).agg(
        F.min_by("dim", order).alias("_first_dim"), F.count(F.lit(1)).alias("_rows")
    )
    reason = (
        F.when(F.col("_rows") > MAX_BATCH_VECTORS, "too many vectors in one batch")
        .when(F.col("dim") <= 0, "empty vector")
        .when(F.col("dim") > MAX_VECTOR_DIM, "dimension above the limit")
        .when(F.col("dim") != F.col("_first_dim"), "dimension differs from the batch")
        .when(F.octet_length("object_id") > MAX_ID_BYTES, "object id too long")
        .when(F.octet_length("segment_id") > MAX_ID_BYTES, "segment id too long")
    )
    checked = join_null_safe(sized, per_batch, list(batch)).withColumn("reject_reason", reason)
    return checked.drop("_first_dim", "_rows")


def batch_ranges(rows: DataFrame, order: Sequence[str], batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Rows with a dense ``row_index`` and the ``batch_index`` it falls into; ``order`` must be unique."""
    numbered = numbered_rows(rows, order)
    return numbered.withColumn("batch_index", batch_of(F.col("row_index"), batch_size, MAX_BATCH_VECTORS))


def whole_batch_accounting(batched: DataFrame, error: str) -> DataFrame:
    """One bad row fails its batch, the others go on; ``error`` is null on good rows."""
    per_batch = batched.groupBy("batch_index").agg(
        F.min("row_index").alias("batch_start"),
        (F.max("row_index") + 1).alias("batch_end"),
        F.min_by(error, F.when(F.col(error).isNotNull(), F.col("row_index"))).alias("error"),
    )
    size = F.col("batch_end") - F.col("batch_start")
    failed = F.col("error").isNotNull()
    return per_batch.withColumns({
        "accepted_count": F.when(failed, F.lit(0)).otherwise(size).cast("bigint"),
        "failed_count": F.when(failed, size).otherwise(F.lit(0)).cast("bigint"),
        "error_type": F.when(failed, "ValueError"),
    })


def row_accounting(batched: DataFrame, error: str) -> DataFrame:
    """Only the bad row fails; per batch counts with the first failing row."""
    bad = F.col(error).isNotNull()
    return batched.groupBy("batch_index").agg(
        F.min("row_index").alias("batch_start"),
        (F.max("row_index") + 1).alias("batch_end"),
        F.count_if(~bad).alias("accepted_count"),
        F.count_if(bad).alias("failed_count"),
        F.min(F.when(bad, F.col("row_index"))).alias("first_error_index"),
    )


def error_rows(batched: DataFrame, error: str, error_type: str = "ValueError") -> DataFrame:
    """``(batch_index, event_index, error_type, error)``: every refused row, whatever their number."""
    return batched.where(F.col(error).isNotNull()).select(
        "batch_index", F.col("row_index").alias("event_index"), F.lit(error_type).alias("error_type"), F.col(error).alias("error")
    )


def accepted_ids(batched: DataFrame, error: str, id_column: str) -> DataFrame:
    """``(batch_index, accepted_id)`` of every accepted row."""
    return batched.where(F.col(error).isNull()).select("batch_index", F.col(id_column).cast("string").alias("accepted_id"))


def merge_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Error or id rows of several operations as one table, numbered by ``operation``."""
    numbered = [p.withColumn("operation", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered)


def batch_totals(batches: DataFrame) -> DataFrame:
    """One row: sums over batches, and whether everything was accepted."""
    return batches.agg(
        F.coalesce(F.sum("accepted_count") + F.sum("failed_count"), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum("accepted_count"), F.lit(0)).alias("accepted_count"),
        F.coalesce(F.sum("failed_count"), F.lit(0)).alias("failed_count"),
        F.count(F.lit(1)).alias("batch_count"),
        (F.coalesce(F.sum("failed_count"), F.lit(0)) == 0).alias("success"),
    )


def merge_totals(totals: Sequence[DataFrame]) -> DataFrame:
    """Several operations as one result; ids and errors stay rows and are joined by ``unionByName``."""
    pooled = totals[0]
    for other in totals[1:]:
        pooled = pooled.unionByName(other)
    return pooled.agg(
        *[F.sum(c).alias(c) for c in ("total_count", "accepted_count", "failed_count", "batch_count")],
        F.bool_and("success").alias("success"),
    )


def error_summary(errors: DataFrame, shown: int = ERRORS_SHOWN) -> DataFrame:
    """One row with the first errors in batch order and how many more there are; none without errors."""
    line = F.format_string("batch %d: %s", F.col("batch_index"), F.col("error"))
    first = errors.orderBy("batch_index").limit(shown).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("batch_index", line.alias("line")))), lambda e: e["line"]), "; "
        ).alias("_first")
    )
    totals = errors.agg(F.count(F.lit(1)).alias("_n"), F.sum("failed_count").alias("_failed"))
    rest = F.when(
        F.col("_n") > shown, F.format_string(" ... and %d more errors", F.col("_n") - shown)
    ).otherwise("")
    message = F.format_string(FAILURE_FORMAT, F.col("_failed"), F.col("_n"), F.concat("_first", rest))
    return totals.where("_n > 0").crossJoin(first).select(message.alias("message"))


def raise_on_first(batches: DataFrame) -> DataFrame:
    """Strict mode: fail on the first failed batch, otherwise pass the batches through."""
    first = batches.where(F.col("failed_count") > 0).orderBy("batch_index").first()
    if first is not None:
        raise ValueError(
            f"Batch {first['batch_index']} failed (items {first['batch_start']}-{first['batch_end']}): {first['error']}"
        )
    return batches
