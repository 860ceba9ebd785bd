"""A stored text index: vocabulary, postings and text lengths as tables that searches read.

``build`` weighs the corpus once.  Vocabulary and postings lie in folders by token
bucket, and a common word's postings in several files, so a search reads only the
buckets of its own terms, filtered to the terms at the scan, and brings them together by
text, once for all queries.  Scores equal those of ``text_search.text_search`` over the same corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import BROADCAST_BYTES, DEFAULT_TOP_K, KEPT_ROWS
from engrama.functions.vectors import Best, arrow_schema, r6, sortable
from engrama.operators.text_search import (
    TERM_BYTES, corpus_idf, overlaps, query_postings, ranked, term_counts, whole_texts, with_idf,
)
from engrama.session import materialize, spread
from engrama.sources.snapshots import ROWS_PER_FILE

BUCKETS = 64          # folders of tokens
FILTERED_TERMS = 10_000  # terms written into a filter; more are joined


def bucket_of(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def build(
    texts: DataFrame, path: str, text_id: str = "memory_id", text: str = "text", carried: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Write the index of ``texts`` below ``path`` and return its one-row registry.

    ``carried`` are columns of the texts that searches scope by.
    """
    spark = texts.sparkSession
    # the texts' own terms are read three times below
    counted = term_counts(spread(texts.select(text_id, *carried, text)), [text_id, *carried], text)
    counted.write.mode("overwrite").parquet(f"{path}/terms")
    counted = spark.read.parquet(f"{path}/terms")
    frequencies = corpus_idf(counted, texts)
    weighed = with_idf(counted, frequencies).select(text_id, *carried, "token", (F.col("tf") * F.col("idf")).alias("w"))
    lengths = weighed.groupBy(text_id, *carried).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    _by_bucket(frequencies, 1, buckets).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/vocabulary")
    # a token in very many texts fills several files
    pieces = F.ceil(F.col("df") / ROWS_PER_FILE).cast("int")
    postings = with_idf(counted, frequencies).select(text_id, "token", "tf", F.pmod(F.xxhash64(text_id), pieces).alias("_piece"))
    _by_bucket(postings, "_piece", buckets).drop("_piece").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    lengths.write.mode("overwrite").parquet(f"{path}/lengths")
    stored = spark.read.parquet(f"{path}/lengths").agg(F.count(F.lit(1)).alias("n_texts"))
    vocabulary = spark.read.parquet(f"{path}/vocabulary").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum("df").alias("n_postings"), F.lit(buckets).alias("buckets")
    )
    stored.crossJoin(vocabulary).write.mode("overwrite").parquet(f"{path}/registry")
    return spark.read.parquet(f"{path}/registry")


def _by_bucket(rows: DataFrame, piece: str | int, buckets: int) -> DataFrame:
    key = F.lit(piece) if isinstance(piece, int) else F.col(piece)
    return rows.withColumn("bucket", bucket_of(F.col("token"), buckets)).repartition("bucket", key)


def search(
    spark: SparkSession, path: str, queries: DataFrame, k: int = DEFAULT_TOP_K, scope: Sequence[str] = (), within: Sequence[str] = (),
    query_id: str = "query_id", query_text: str = "query_text", text_id: str = "memory_id", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, *scope, *within, text_id, score, rank)`` from a stored index; see ``text_search``."""
    buckets = spark.read.parquet(f"{path}/registry").first().buckets
    terms = materialize(term_counts(queries, [query_id, *scope], query_text).withColumnRenamed("tf", "_query_tf"))
    wanted = materialize(terms.select("token").distinct())
    vocabulary = only_terms(spark.read.parquet(f"{path}/vocabulary"), wanted, buckets)
    postings = only_terms(spark.read.parquet(f"{path}/postings"), wanted, buckets)
    weighed = materialize(terms.join(vocabulary.select("token", "idf"), "token"))
    lengths = spark.read.parquet(f"{path}/lengths").select(text_id, *dict.fromkeys([*scope, *within]), "length")
    # a task holds the best k of every query, in each group of texts
    size = weighed.agg(
        F.count(F.lit(1)).alias("terms"), F.count_distinct(query_id, *scope).alias("queries"),
        F.count_if(F.col(query_id).isNull()).alias("unnamed"),
    ).first()
    groups = (lengths.agg(F.count_distinct(*within)).first()[0] or 1) if within else 1
    small = size["terms"] * TERM_BYTES <= broadcast_bytes
    if small and size["queries"] * k * groups <= KEPT_ROWS and not size["unnamed"]:
        scored = _scored_in_tasks(weighed, postings, lengths, query_id, text_id, scope, within, k)
    else:
        scored = _scored_by_join(weighed, postings, lengths, query_id, text_id, scope, within, small)
    return ranked(scored, [query_id, *within], text_id, k)


def _scored_by_join(weighed, postings, lengths, query_id, text_id, scope, within, small) -> DataFrame:
    """Any number of query terms: a row per posting and query, summed per (query, text)."""
    if small:
        weighed = F.broadcast(weighed)  # the postings of a common word stay where they are read
    found = postings.join(weighed, "token").groupBy(query_id, *scope, text_id).agg(
        F.sum(F.col("_query_tf") * F.col("tf") * F.col("idf")).alias("_overlap")
    )
    return found.join(lengths, [text_id, *scope]).select(
        query_id, *dict.fromkeys([*scope, *within]), text_id, r6(r6(F.col("_overlap") / F.col("length"))).alias("score")
    )


def _scored_in_tasks(weighed, postings, lengths, query_id, text_id, scope, within, k) -> DataFrame:
    """Query terms of checked size: postings meet by text, once whatever the number of queries, and a task keeps the best.

    A text's lengths travel with its postings as rows without a term.
    """
    spark = weighed.sparkSession
    carried = [*dict.fromkeys([*scope, *within])]
    query_keys, vocabulary, asked = query_postings(weighed.drop("idf"), query_id, scope)
    shared = spark.sparkContext.broadcast((query_keys, asked))
    numbers = spark.createDataFrame(list(vocabulary.items()), "token string, _term bigint")
    numbers = numbers.join(weighed.select("token", "idf").distinct(), "token")  # a token has one idf
    nothing = [F.lit(None).cast(lengths.schema[c].dataType).alias(c) for c in carried]
    terms = postings.join(F.broadcast(numbers), "token").select(text_id, *nothing, "_term", (F.col("tf") * F.col("idf")).alias("w"))
    sizes = lengths.dropna(subset=list(scope)) if scope else lengths  # a missing scope agrees with none
    sizes = sizes.select(text_id, *carried, F.lit(-1).cast("bigint").alias("_term"), F.col("length").alias("w"))
    rows = terms.unionByName(sizes).where(F.col(text_id).isNotNull()).repartition(text_id).sortWithinPartitions(text_id)
    out_schema = T.StructType(
        [weighed.schema[query_id], *[lengths.schema[c] for c in [*carried, text_id]], T.StructField("score", T.DoubleType())]
    )
    out_arrow = arrow_schema(out_schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, query_terms = shared.value
        best = Best(k, len(query_rows))
        for frame in whole_texts(batches, text_id):
            for found in _best_of(frame, query_rows, query_terms, text_id, scope, carried):
                best.keep(*found)
        yield from best.batches(query_rows[query_id].to_numpy(), out_arrow)

    return rows.mapInArrow(search, out_schema)


def _best_of(frame, query_rows, query_terms, text_id, scope, carried):
    """``(group, query rows, text ids, scores)`` of all queries that share a term with these texts."""
    ids, terms = frame[text_id].to_numpy(), frame["_term"].to_numpy()
    text_of_row = np.cumsum(np.concatenate([[True], ids[1:] != ids[:-1]])) - 1
    sizes, size_text = frame[terms < 0], text_of_row[terms < 0]
    length, names, n_queries = sizes["w"].to_numpy(), sortable(sizes[text_id].to_numpy()), len(query_rows)
    groups = {(): np.arange(len(sizes))}
    if carried:
        found = sizes[carried].groupby(carried, sort=False, dropna=False).indices
        groups = {tuple(None if pd.isna(v) else v for v in (g if isinstance(g, tuple) else (g,))): rows for g, rows in found.items()}
    agreeing = {group: np.flatnonzero(_agree(query_rows, scope, group)) for group in groups}
    for low, overlap in overlaps(text_of_row, terms, frame["w"].to_numpy(), query_terms, text_of_row[-1] + 1, n_queries):
        overlap = overlap.reshape(-1, n_queries)
        for group, rows in groups.items():
            rows, queries = rows[(size_text[rows] >= low) & (size_text[rows] < low + len(overlap))], agreeing[group]
            matched = overlap[np.ix_(size_text[rows] - low, queries)]
            text, q = np.nonzero(matched)
            yield group, queries[q], names[rows[text]], np.round(matched[text, q] / length[rows[text]], 6)


def _agree(query_rows, scope, group) -> np.ndarray:
    """Which queries have the scope of a group; the scope's values come first in it."""
    same = np.ones(len(query_rows), bool)
    for column, value in zip(scope, group):
        same &= query_rows[column].to_numpy() == value
    return same


def only_terms(rows: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows of the wanted tokens: few of them become a filter on bucket and token, which prunes folders and files."""
    if wanted.count() <= FILTERED_TERMS:
        tokens = [r.token for r in wanted.collect()]
        numbers = [r.b for r in wanted.select(bucket_of(F.col("token"), buckets).alias("b")).distinct().collect()]
        return rows.where(F.col("bucket").isin(numbers) & F.col("token").isin(tokens))
    return rows.join(wanted, "token", "left_semi")
