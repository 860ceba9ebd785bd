"""Plugging in an embedding model: any object with ``embed_documents`` and ``embed_query``.

The model is built once per task from a factory and fed slices of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import DEFAULT_SEGMENT, DEFAULT_STORE_K, EMBED_BATCH
from engrama.functions.vectors import r6
from engrama.operators import vector_search as vs
from engrama.operators.filters import with_payload
from engrama.session import materialize, spread

VECTOR = T.ArrayType(T.FloatType())


class EmbeddingModel(Protocol):
    def embed_documents(self, texts: list[str]) -> list[list[float]]: ...

    def embed_query(self, text: str) -> list[float]: ...


def embed_documents(make_model: Callable[[], EmbeddingModel], text: Column, batch: int = EMBED_BATCH) -> Column:
    @F.pandas_udf(VECTOR)
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            vectors = []
            for start in range(0, len(texts), batch):
                vectors += model.embed_documents(texts.iloc[start : start + batch].tolist())
            yield pd.Series(vectors, dtype=object)

    return embed(text)


def embed_queries(make_model: Callable[[], EmbeddingModel], text: Column) -> Column:
    @F.pandas_udf(VECTOR)
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            yield pd.Series([model.embed_query(x) for x in texts], dtype=object)

    return embed(text)


def embed_if_missing(rows: DataFrame, make_model: Callable[[], EmbeddingModel], text: str, vector: str) -> DataFrame:
    """Rows with text and no vector get one; the model never sees the others."""
    lacking = F.col(vector).isNull() & (F.coalesce(F.col(text), F.lit("")) != "")
    kept = rows.where(~lacking)
    made = spread(rows.where(lacking)).withColumn(vector, embed_documents(make_model, F.col(text)))
    return kept.unionByName(made)


def with_ids(documents: DataFrame, id_column: str = "id") -> DataFrame:
    """Own ids kept, missing ones made up, pinned so that both tables written from them agree."""
    return materialize(documents.withColumn(id_column, F.coalesce(id_column, F.uuid())))


def add_texts(
    texts: DataFrame, make_model: Callable[[], EmbeddingModel], vector_path: str, event_path: str,
    segment_id: str = DEFAULT_SEGMENT, workspace_id: str | None = None,
) -> DataFrame:
    """Store ``(id, page_content, metadata)`` as vectors and as ``document`` events; returns the ids."""
    identified = with_ids(texts)
    spread(identified).select(
        F.lit(segment_id).alias("segment_id"), F.col("id").alias("object_id"),
        embed_documents(make_model, F.col("page_content")).alias("embedding"),
    ).write.mode("append").parquet(vector_path)
    identified.select(
        F.col("id").alias("event_id"), F.lit("document").alias("event_type"),
        F.lit(workspace_id).cast("string").alias("workspace_id"),
        F.struct("page_content", "metadata").alias("payload"),
    ).write.mode("append").parquet(event_path)
    return identified.select("id")


def similarity_search(
    queries: DataFrame, vectors: DataFrame, events: DataFrame, make_model: Callable[[], EmbeddingModel],
    k: int = DEFAULT_STORE_K, with_score: bool = True,
) -> DataFrame:
    """Query texts to stored documents; a vector whose document never arrived still counts as a hit."""
    embedded = materialize(queries.withColumn("query_vector", embed_queries(make_model, F.col("query_text"))))
    hits = vs.top_k(embedded, vectors, k=k)
    documents = events.select(F.col("event_id").alias("object_id"), "payload.page_content", "payload.metadata")
    found = with_payload(hits, documents, "object_id", True)
    return found if with_score else found.drop("score")


HIT_SCHEMA = (
    "object_id string, memory_id string, event_id string, score double, distance double, "
    "payload struct<page_content: string, metadata: map<string, string>>"
)


def project_hits(hits: DataFrame, body: str) -> DataFrame:
    """Answer objects as documents: content, metadata with the id put in, and a score.

    An object may also be a plain id string; it then has neither content nor score.
    """
    parsed = F.from_json(body, HIT_SCHEMA)
    plain = F.when(~F.startswith(F.ltrim(F.col(body)), F.lit("{")), F.col(body))
    identifier = F.coalesce(parsed["object_id"], parsed["memory_id"], parsed["event_id"], plain)
    metadata = F.coalesce(parsed["payload"]["metadata"], F.create_map().cast("map<string,string>"))
    with_id = F.map_concat(
        F.map_filter(metadata, lambda key, _: key != "id"),
        F.when(identifier.isNotNull(), F.create_map(F.lit("id"), identifier))
        .otherwise(F.create_map().cast("map<string,string>")),
    )
    others = [c for c in hits.columns if c != body]
    return hits.select(
        *others,
        F.coalesce(parsed["payload"]["page_content"], F.lit("")).alias("page_content"),
        with_id.alias("metadata"),
        r6(F.coalesce(parsed["score"], parsed["distance"], F.lit(0.0))).alias("score"),
    )
