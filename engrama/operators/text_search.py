"""TF-IDF weights, text search over them, and rank fusion.

Tokens are counted inside each row and the texts never move.  Document
frequencies need only the vocabulary to shuffle, and a vocabulary of checked
size is broadcast, so no row goes to the task of a common word.  Searching
measures and scores texts where they lie and keeps the best per task, without
rows for (query, text) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import (
    BROADCAST_BYTES, DEFAULT_TOP_K, KEPT_ROWS, RRF_CONSTANT, SCORE_CELLS, TEXT_VECTOR_DIM,
)
from engrama.functions.text import TOKEN_SPLIT
from engrama.functions.vectors import Best, arrow_schema, r6, sortable
from engrama.session import materialize, spread

TERM_BYTES = 64  # room for one vocabulary entry or posting in memory


def term_counts(texts: DataFrame, id_columns: Sequence[str], text: str) -> DataFrame:
    """``(*id_columns, token, tf)``, counted inside the row: no shuffle, and a text's tokens stay together.

    The tokens are sorted; a token's count is the distance from where its run
    starts to where the next one does.
    """
    words = texts.select(*id_columns, F.sort_array(F.split(F.lower(text), TOKEN_SPLIT)).alias("_words"))
    word = F.col("_words")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(word) - 1), lambda i: (i == 0) | (F.get(word, i) != F.get(word, i - 1))
    )
    runs = words.select(*id_columns, "_words", starts.alias("_starts"))
    counted = F.transform("_starts", lambda start, n: F.struct(
        F.get(word, start).alias("token"),
        (F.coalesce(F.get(F.col("_starts"), n + 1), F.size(word)) - start).cast("bigint").alias("tf"),
    ))
    # the outer form keeps the optimizer from computing every array a second time just to test for emptiness
    return runs.select(*id_columns, F.explode_outer(counted).alias("_run")).select(
        *id_columns, "_run.token", "_run.tf"
    ).where(F.col("token") != "")


def idf(total: Column, df: Column) -> Column:
    return F.log((total + 1) / (df + 1)) + 1


def token_idf(texts: DataFrame, text: str) -> DataFrame:
    """``(token, df, idf)`` of a corpus, pinned: it is read by later joins and its size decides how."""
    words = spread(texts.select(text)).select(
        F.explode_outer(F.array_distinct(F.split(F.lower(text), TOKEN_SPLIT))).alias("token")
    )
    return corpus_idf(words.where(F.col("token") != ""), texts)


def corpus_idf(tokens: DataFrame, texts: DataFrame) -> DataFrame:
    """``(token, df, idf)``, pinned, from a row per text and distinct token."""
    frequencies = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    total = texts.agg(F.count(F.lit(1)).cast("double").alias("n_texts"))  # a single row
    return materialize(frequencies.crossJoin(F.broadcast(total)).select(
        "token", "df", idf(F.col("n_texts"), F.col("df")).alias("idf")
    ))


def small_enough(pinned: DataFrame, row_bytes: int = TERM_BYTES) -> bool:
    return pinned.count() * row_bytes <= BROADCAST_BYTES


def with_idf(counts: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Join frequencies by token: broadcast within the size bound, otherwise a skew-aware shuffle join."""
    side = F.broadcast(frequencies) if small_enough(frequencies) else frequencies.hint("shuffle_merge")
    return counts.join(side, "token")


def tfidf_weights(
    texts: DataFrame, id_columns: Sequence[str], text: str, corpus: DataFrame | None = None
) -> DataFrame:
    """``(*id_columns, token, tf, w)`` with unrounded weights; frequencies come from ``corpus`` if given."""
    frequencies = token_idf(texts if corpus is None else corpus, text)
    return with_idf(term_counts(spread(texts.select(*id_columns, text)), id_columns, text), frequencies).select(
        *id_columns, "token", "tf", (F.col("tf") * F.col("idf")).alias("w")
    )


def text_search(
    queries: DataFrame,
    texts: DataFrame,
    k: int = DEFAULT_TOP_K,
    scope: Sequence[str] = (),
    within: Sequence[str] = (),
    query_id: str = "query_id",
    query_text: str = "query_text",
    text_id: str = "memory_id",
    text: str = "text",
    corpus: DataFrame | None = None,
    boost: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, *scope, *within, text_id, score, rank)``: weighted term overlap over the text vector's length.

    ``scope``   columns queries and texts share: a query sees only texts that agree.
    ``within``  text columns: a query gets its own ``k`` texts for every value of them.
    ``corpus``  where document frequencies come from; default is ``texts``.
    ``boost``   factor on the score, an expression over the columns of ``texts``.
    """
    carried = [*dict.fromkeys([*scope, *within])]
    keys = [text_id, *carried, "_boost"]
    texts = texts.withColumn("_boost", F.lit(1.0) if boost is None else boost.cast("double")).select(*keys, text)
    frequencies = token_idf(texts if corpus is None else corpus, text)
    weights = with_idf(term_counts(spread(texts), keys, text), frequencies).select(
        *keys, "token", (F.col("tf") * F.col("idf")).alias("w")
    )
    if not small_enough(frequencies):
        # the shuffle join tore the texts apart
        weights = weights.repartition(*keys).sortWithinPartitions(*keys)
    terms = materialize(term_counts(queries, [query_id, *scope], query_text).withColumnRenamed("tf", "_query_tf"))
    # a task holds the best k of every query, in each group of texts
    size = terms.agg(F.count(F.lit(1)).alias("terms"), F.count_distinct(query_id, *scope).alias("queries")).first()
    groups = (texts.agg(F.count_distinct(*within)).first()[0] or 1) if within else 1
    if size["terms"] * TERM_BYTES <= broadcast_bytes and size["queries"] * k * groups <= KEPT_ROWS:
        found = _scored_in_tasks(terms, weights, query_id, text_id, scope, carried, k)
    else:
        found = _scored_by_join(terms, weights, query_id, text_id, scope, carried)
    return ranked(found, [query_id, *within], text_id, k)


def _scored_by_join(terms, weights, query_id, text_id, scope, carried) -> DataFrame:
    """Any number of query terms: join by token and sum per (query, text)."""
    own_tokens = Window.partitionBy(text_id, *carried, "_boost")
    measured = weights.withColumn("_length", F.sqrt(F.sum(F.col("w") * F.col("w")).over(own_tokens)))
    matched = measured.join(terms, ["token", *scope])
    scored = matched.groupBy(query_id, text_id, *carried, "_boost").agg(
        r6(F.sum(F.col("_query_tf") * F.col("w")) / F.first("_length")).alias("score")
    )
    return scored.select(query_id, *carried, text_id, r6(F.col("score") * F.col("_boost")).alias("score"))


def _scored_in_tasks(terms, weights, query_id, text_id, scope, carried, k) -> DataFrame:
    """Query terms of checked size: every task scores its own texts and keeps the best per query.

    All rows of a text arrive one after the other: they were made from one row,
    and only broadcast sides were joined since.
    """
    query_keys, vocabulary, postings = query_postings(terms, query_id, scope)
    spark = weights.sparkSession
    shared = spark.sparkContext.broadcast((query_keys, postings))
    term_numbers = spark.createDataFrame(list(vocabulary.items()), "token string, _term bigint")
    numbered = weights.join(F.broadcast(term_numbers), "token", "left")
    rows = numbered.select(text_id, *carried, "_boost", F.coalesce("_term", F.lit(-1)).alias("_term"), "w")
    out_schema = T.StructType(
        [terms.schema[query_id], *[weights.schema[c] for c in [*carried, text_id]], T.StructField("score", T.DoubleType())]
    )
    out_arrow = arrow_schema(out_schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, query_postings = shared.value
        best = Best(k, len(query_rows))
        for frame in whole_texts(batches, text_id):
            for group, q, ids, score in _score(frame, query_rows, query_postings, text_id, scope, carried):
                best.keep(group, q, ids, score)
        yield from best.batches(query_rows[query_id].to_numpy(), out_arrow)

    return rows.mapInArrow(search, out_schema)


def query_postings(terms: DataFrame, query_id: str, scope: Sequence[str]) -> tuple[pd.DataFrame, dict[str, int], tuple]:
    """Query terms of checked size, collected: (distinct queries, number per token, queries and counts by token)."""
    packed = terms.toPandas()
    query_keys = packed[[query_id, *scope]].drop_duplicates().reset_index(drop=True)
    vocabulary = {token: i for i, token in enumerate(packed["token"].unique())}
    packed = packed.merge(query_keys.reset_index(names="_row"), on=[query_id, *scope])
    packed["_term"] = packed["token"].map(vocabulary)
    packed = packed.sort_values("_term", kind="stable")
    starts = np.searchsorted(packed["_term"].to_numpy(dtype=np.int64), np.arange(len(vocabulary) + 1))
    postings = (starts, packed["_row"].to_numpy(dtype=np.int64), packed["_query_tf"].to_numpy(dtype=np.float64))
    if len(query_keys) * len(vocabulary) <= SCORE_CELLS:
        counts = np.bincount(
            packed["_term"].to_numpy(dtype=np.int64) * len(query_keys) + packed["_row"].to_numpy(dtype=np.int64),
            packed["_query_tf"].to_numpy(dtype=np.float64), minlength=len(query_keys) * len(vocabulary),
        ).reshape(len(vocabulary), -1)
    else:
        counts = None
    return query_keys, vocabulary, (*postings, counts)


def whole_texts(batches: Iterator[pa.RecordBatch], text_id: str) -> Iterator[pd.DataFrame]:
    """Batches cut at text boundaries: the rows of the last text wait for the next batch."""
    waiting = None
    for batch in batches:
        frame = batch.to_pandas(integer_object_nulls=True)
        if waiting is not None:
            frame = pd.concat([waiting, frame], ignore_index=True)
        if frame.empty:
            continue
        last = frame[text_id].iloc[-1]
        cut = int((frame[text_id] == last).to_numpy().argmax())
        waiting = frame.iloc[cut:]
        if cut:
            yield frame.iloc[:cut]
    if waiting is not None:
        yield waiting


def _score(frame, query_rows, postings, text_id, scope, carried):
    """``(group, query rows, text ids, scores)`` of all queries that share a term with these texts."""
    ids = frame[text_id].to_numpy()
    new_text = np.concatenate([[True], ids[1:] != ids[:-1]])
    text_of_row, first = np.cumsum(new_text) - 1, np.flatnonzero(new_text)
    terms, weights = frame["_term"].to_numpy(), frame["w"].to_numpy()
    n_queries = len(query_rows)
    per_text, lengths = frame.iloc[first], np.sqrt(np.add.reduceat(weights**2, first))
    for low, overlap in overlaps(text_of_row, terms, weights, postings, len(first), n_queries):
        chosen = np.flatnonzero(overlap)
        text, q = chosen // n_queries + low, chosen % n_queries
        score = np.round(np.round(overlap[chosen] / lengths[text], 6) * per_text["_boost"].to_numpy()[text], 6)
        for column in scope:
            agree = per_text[column].to_numpy()[text] == query_rows[column].to_numpy()[q]
            text, q, score = text[agree], q[agree], score[agree]
        if not carried:
            yield (), q, sortable(ids[first][text]), score
            continue
        groups = per_text[list(carried)].iloc[text]
        for group, where in groups.groupby(list(carried), sort=False, dropna=False).indices.items():
            yield (group if isinstance(group, tuple) else (group,)), q[where], sortable(ids[first][text[where]]), score[where]


def overlaps(
    text_of_row: np.ndarray, terms: np.ndarray, weights: np.ndarray, postings: tuple, n_texts: int, n_queries: int
) -> Iterator[tuple[int, np.ndarray]]:
    """``(first text, text by query sums of weight times query count)`` in slices of bounded size; rows lie by text.

    A small table of query counts is multiplied as a matrix, a large one is looked up by term.
    """
    starts, posting_query, posting_tf, counts = postings
    asked = terms >= 0
    terms, weights, text_of_row = terms[asked], weights[asked], text_of_row[asked]
    if counts is not None:
        step = max(1, SCORE_CELLS // max(1, *counts.shape))
        for low in range(0, n_texts, step):
            high = min(low + step, n_texts)
            a, b = np.searchsorted(text_of_row, [low, high])
            cells = (text_of_row[a:b] - low) * len(counts) + terms[a:b]
            held = np.bincount(cells, weights[a:b], minlength=(high - low) * len(counts)).reshape(high - low, -1)
            yield low, (held @ counts).ravel()
        return
    fan_out = starts[terms + 1] - starts[terms]
    step = max(1, SCORE_CELLS // max(1, n_queries))
    for low in range(0, n_texts, step):
        high = min(low + step, n_texts)
        a, b = np.searchsorted(text_of_row, [low, high])
        overlap = np.zeros((high - low) * n_queries)
        edges = np.flatnonzero(np.diff(np.cumsum(fan_out[a:b]) // SCORE_CELLS)) + 1
        for rows in np.split(np.arange(a, b), edges):
            size = fan_out[rows]
            repeated = np.repeat(rows, size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + starts[terms[repeated]]
            cells = (text_of_row[repeated] - low) * n_queries + posting_query[at]
            overlap += np.bincount(cells, weights[repeated] * posting_tf[at], minlength=len(overlap))
        yield low, overlap


def ranked(found: DataFrame, keys: Sequence[str], id_column: str, k: int) -> DataFrame:
    """Rank by score per key, ties by id, and keep ``k``; the filter becomes a partial limit per task."""
    ranking = Window.partitionBy(*keys).orderBy(F.desc("score"), id_column)
    numbered = found.withColumn("rank", F.row_number().over(ranking).cast("bigint"))
    return numbered.where(F.col("rank") <= k)


def rrf_fusion(lists: Sequence[DataFrame], key: str, id_column: str, k: int) -> DataFrame:
    """Reciprocal rank fusion of ranked lists, taken as long as they are given."""
    pooled = None
    for ranked_list in lists:
        part = ranked_list.select(key, id_column, "rank")
        pooled = part if pooled is None else pooled.unionByName(part)
    fused = pooled.groupBy(key, id_column).agg(r6(F.sum(1.0 / (RRF_CONSTANT + F.col("rank")))).alias("score"))
    return ranked(fused, [key], id_column, k)


def bucket_of(token: Column) -> Column:
    """Stable bucket 0..255 of a token: the first byte of its md5 digest."""
    return F.conv(F.substring(F.md5(token), 1, 2), 16, 10).cast("int")


def dense_text_cells(texts: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(id, bucket, value)``: weights summed per bucket, then scaled to unit length."""
    return packed_text_cells(texts, id_column, text).select(id_column, F.inline("_cells"))


def packed_text_cells(texts: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(id, _cells, embedding)``, a row per id: its buckets with their values, and all 256 values.

    Tokens that lie one after the other are summed where they are made, so a row per text
    is shuffled and none per token or bucket.
    """
    weights = tfidf_weights(texts, [id_column], text)
    rows = weights.select(id_column, bucket_of(F.col("token")).alias("bucket"), "w")
    cells = T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("value", T.DoubleType())]))
    schema = T.StructType([rows.schema[id_column], T.StructField("_part", cells)])
    out = arrow_schema(schema)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))
            spot, at = np.unique(run * TEXT_VECTOR_DIM + batch.column(1).to_numpy(), return_inverse=True)
            value = np.bincount(at, batch.column(2).to_numpy())
            offsets = np.searchsorted(spot, np.arange(len(first) + 1) * TEXT_VECTOR_DIM).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array((spot % TEXT_VECTOR_DIM).astype(np.int32)), pa.array(value)], ["bucket", "value"])
            parts = pa.ListArray.from_arrays(pa.array(offsets), entries)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first)), parts.cast(out.field(1).type)], schema=out)

    # several parts: a text cut between two batches, or rows of one id
    parts = rows.mapInArrow(sums, schema).repartition(id_column).sortWithinPartitions(id_column)
    vector = T.StructField("embedding", T.ArrayType(T.FloatType()))
    packed = T.StructType([rows.schema[id_column], T.StructField("_cells", cells), vector])
    packed_arrow = arrow_schema(packed)

    def finished(ids: pa.Array, dense: np.ndarray) -> pa.RecordBatch:
        unit = dense / np.sqrt((dense * dense).sum(axis=1, keepdims=True))
        run, bucket = np.nonzero(dense)
        offsets = np.searchsorted(run, np.arange(len(dense) + 1)).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(unit[run, bucket])], ["bucket", "value"])
        places = np.arange(len(dense) + 1, dtype=np.int32) * TEXT_VECTOR_DIM
        columns = [pa.ListArray.from_arrays(pa.array(offsets), entries), pa.ListArray.from_arrays(pa.array(places), pa.array(unit.astype(np.float32).ravel()))]
        return pa.RecordBatch.from_arrays([ids, *(c.cast(f.type) for c, f in zip(columns, list(packed_arrow)[1:]))], schema=packed_arrow)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = np.concatenate([[True], ids[1:] != ids[:-1]])
            names, run = batch.column(0).take(pa.array(np.flatnonzero(new))), np.cumsum(new) - 1
            held = batch.column(1)
            of_cell = np.repeat(run, pa.compute.list_value_length(held).to_numpy(zero_copy_only=False))
            entries = held.flatten()
            spots = of_cell * TEXT_VECTOR_DIM + entries.field("bucket").to_numpy()
            dense = np.bincount(spots, entries.field("value").to_numpy(), minlength=len(names) * TEXT_VECTOR_DIM).reshape(len(names), -1)
            if waiting is not None:
                if waiting[0][0].as_py() == names[0].as_py():
                    dense[0] += waiting[1][0]
                else:
                    yield finished(*waiting)
            if len(names) > 1:
                yield finished(names[:-1], dense[:-1])
            waiting = names[-1:], dense[-1:]
        if waiting is not None:
            yield finished(*waiting)

    return parts.mapInArrow(merge, packed)


def dense_text_vectors(texts: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(id, embedding)`` of 256 dimensions; a text without tokens gets the zero vector."""
    packed = packed_text_cells(texts, id_column, text).select(id_column, "embedding")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), TEXT_VECTOR_DIM)
    filled = F.coalesce("embedding", zeros)
    return texts.select(id_column).join(packed, id_column, "left").select(id_column, filled.alias("embedding"))
