"""Exact top-k vector search over a distributed base table.

The base table is scanned in Arrow batches.  A query set of checked size is
broadcast and every task keeps only its own best ``k`` rows per query, so one
small shuffle merges the results.  A larger query set is never collected:
both sides are cut into blocks of bounded rows and block pairs are co-grouped
(a fragment-and-replicate join), which also splits any hot segment or list.
No (query, base) pair is ever emitted as a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import BASE_BLOCK_BYTES, BROADCAST_BYTES, DEFAULT_TOP_K, KEPT_ROWS, LEAST_QUERY_ROWS, MMR_FETCH, MMR_K, MMR_WEIGHT, QUERY_BLOCK_BYTES, SEARCH_TASKS, SHARED_KEPT_ROWS
from engrama.functions import vectors
from engrama.functions.vectors import r6
from engrama.session import materialize


def _groups(batch, names: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Row positions of every distinct combination of the named columns."""
    if not names:
        yield (), np.arange(batch.num_rows)
        return
    if batch.num_rows == 0:
        return
    # codes of distinct values, so that large and missing integers keep their type
    codes, values = [], []
    for name in names:
        column = batch.column(name)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        coded = column.dictionary_encode(null_encoding="encode")
        codes.append(coded.indices.to_numpy(zero_copy_only=False)), values.append(coded.dictionary.to_pylist())
    frame = pd.DataFrame(dict(enumerate(codes)))
    for key, rows in frame.groupby(list(frame.columns), sort=False).indices.items():
        spots = key if isinstance(key, tuple) else (key,)
        yield tuple(v[i] for v, i in zip(values, spots)), rows


def top_k(
    queries: DataFrame,
    base: DataFrame,
    k: int = DEFAULT_TOP_K,
    metric: str = "COSINE",
    on: Sequence[str] = (),
    within: Sequence[str] = (),
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    base_id: str = "object_id",
    base_vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: tuple[int, int] = (BASE_BLOCK_BYTES, QUERY_BLOCK_BYTES),
    kept_rows: int = KEPT_ROWS,
    coding: vectors.Coding | None = None,
) -> DataFrame:
    """``(query_id, *on, *within, base_id, score, rank)`` of the ``k`` best base rows.

    ``on``      columns both sides carry; a query meets only base rows that agree on them.
    ``within``  base columns; a query gets its own ``k`` rows for every value of them.
    ``coding``  how ``base_vector`` is coded; codes stay codes in every shuffle.
    Ranks count per query, and per ``within`` value when that is given.
    """
    metric, coding = vectors.normalize_metric(metric), coding or vectors.Coding()
    queries = queries.where(F.col(query_vector).isNotNull()).select(query_id, *on, query_vector)
    base = base.where(F.col(base_vector).isNotNull()).select(*on, *within, base_id, base_vector)
    out_schema = T.StructType(
        [queries.schema[query_id], *[base.schema[c] for c in [*on, *within]], base.schema[base_id]]
        + [T.StructField("score", T.DoubleType())]
    )
    size = queries.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size(query_vector).cast("bigint")).alias("cells")
    ).first()
    # what a task holds, and hands over once: the best k of every query, in each group of base rows
    per_query = k * (base.agg(F.count_distinct(*within)).first()[0] or 1 if within else 1)
    if (size["cells"] or 0) * 8 <= broadcast_bytes and size["rows"] * per_query <= min(kept_rows, SHARED_KEPT_ROWS):
        partial = _broadcast_form(queries, base, k, metric, on, within, out_schema, coding)
    else:
        dim = size["cells"] / size["rows"]
        base_rows, query_rows = (max(1, int(limit / (8 * dim))) for limit in block_bytes)
        # fewer queries at once where each keeps much, but not so few that the base is copied without need
        block_rows = base_rows, min(query_rows, max(LEAST_QUERY_ROWS, kept_rows // per_query))
        partial = _block_form(queries, base, k, metric, on, within, out_schema, coding, *block_rows)
    best_first = F.col("score").asc() if metric == "L2" else F.col("score").desc()
    if metric == "L2":
        partial = partial.withColumn("score", F.abs("score"))
    ranking = Window.partitionBy(query_id, *within).orderBy(best_first, base_id)
    return partial.withColumn("rank", F.row_number().over(ranking).cast("bigint")).where(F.col("rank") <= k)


def _broadcast_form(queries, base, k, metric, on, within, out_schema, coding) -> DataFrame:
    query_id, query_vector = queries.columns[0], queries.columns[-1]
    base_id, base_vector = base.columns[-2:]
    packed = queries.toArrow()  # size checked by the caller
    ids = packed.column(query_id).to_numpy()
    matrix = vectors.matrix_of(packed.column(query_vector)) if len(ids) else np.empty((0, 0))
    by_group = {key: rows for key, rows in _groups(packed, on)}
    shared = base.sparkSession.sparkContext.broadcast((ids, matrix, by_group))
    arrow_schema = vectors.arrow_schema(out_schema)
    n_on = len(on)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_matrix, positions = shared.value
        best = vectors.Best(k, len(query_ids))
        for batch in batches:
            if not batch.num_rows or not len(query_ids):
                continue
            names = vectors.sortable(batch.column(base_id))
            for group, rows in _groups(batch, [*on, *within]):
                wanted = positions.get(group[:n_on])
                if wanted is None:
                    continue
                picked = batch.column(base_vector).take(pa.array(rows))
                stored = vectors.matrix_of(picked, coding.width(query_matrix.shape[1]))
                found = vectors.block_top_k(
                    metric, wanted, query_matrix[wanted], names[rows], stored, k, coding, best.bars_of(group, wanted)
                )
                best.keep(group, *found)
        yield from best.batches(query_ids, arrow_schema)

    return base.mapInArrow(search, out_schema)


def _block_form(queries, base, k, metric, on, within, out_schema, coding, base_rows, query_rows) -> DataFrame:
    query_id, query_vector = queries.columns[0], queries.columns[-1]
    base_id, base_vector = base.columns[-2:]

    def block_counts(df: DataFrame, rows: int, name: str) -> DataFrame:
        counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        return counted.select(*on, F.ceil(F.col("_n") / rows).cast("bigint").alias(name))

    base_blocks = block_counts(base, base_rows, "_base_blocks")
    query_blocks = block_counts(queries, query_rows, "_query_blocks")
    blocks = materialize(base_blocks.join(query_blocks, list(on)) if on else base_blocks.crossJoin(query_blocks))
    cells = blocks.agg(F.sum(F.col("_base_blocks") * F.col("_query_blocks"))).first()[0] or 1

    def with_blocks(df: DataFrame) -> DataFrame:
        # without `on` the block counts are a single row
        return df.join(blocks, list(on)) if on else df.crossJoin(F.broadcast(blocks))

    base_side = with_blocks(base).select(
        *on, *within, base_id, base_vector,
        F.pmod(F.xxhash64(base_id, base_vector), "_base_blocks").alias("_base_block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_query_blocks") - 1)).alias("_query_block"),
    )
    query_side = with_blocks(queries).select(
        # columns of their own where both sides are read from one table, or cogroup cannot tell them apart
        query_id, *[F.col(c).alias(c) for c in on], query_vector,
        F.pmod(F.xxhash64(query_id, query_vector), "_query_blocks").alias("_query_block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_base_blocks") - 1)).alias("_base_block"),
    )
    cell = [*on, "_base_block", "_query_block"]
    arrow_schema = vectors.arrow_schema(out_schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        best = vectors.Best(k, left.num_rows)
        if left.num_rows and right.num_rows:
            query_matrix = vectors.matrix_of(left.column(query_vector))
            rows_of_queries = np.arange(left.num_rows)
            names = vectors.sortable(right.column(base_id))
            for group, rows in _groups(right, [*on, *within]):
                block = vectors.matrix_of(right.column(base_vector).take(pa.array(rows)), coding.width(query_matrix.shape[1]))
                best.keep(group, *vectors.block_top_k(metric, rows_of_queries, query_matrix, names[rows], block, k, coding))
        found = list(best.batches(left.column(query_id).to_numpy(), arrow_schema))
        return pa.Table.from_batches(found, schema=arrow_schema)

    return _by_cell(query_side, base_side, cell, cells, search, out_schema)


def _by_cell(query_side, base_side, cell, cells, search, out_schema) -> DataFrame:
    """Search every pair of blocks; a task has few of them, as their work is the product of their rows, not their bytes."""
    tasks = max(1, min(SEARCH_TASKS, 4 * int(cells)))  # more than pairs, so that few of them share a task by their hash
    query_side, base_side = (side.repartition(tasks, *cell) for side in (query_side, base_side))
    return query_side.groupBy(*cell).cogroup(base_side.groupBy(*cell)).applyInArrow(search, out_schema)


def top_k_in_lists(
    queries: DataFrame, base: DataFrame, k: int = DEFAULT_TOP_K, metric: str = "COSINE", query_id: str = "query_id", base_id: str = "object_id",
    base_vector: str = "embedding", coding: vectors.Coding | None = None, broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: tuple[int, int] = (BASE_BLOCK_BYTES, QUERY_BLOCK_BYTES), kept_rows: int = KEPT_ROWS,
) -> DataFrame:
    """``top_k`` for ``queries`` ``(query_id, query_vector, lists)`` that each ask for several lists of ``base``.

    Lists are put together to blocks of bounded bytes.  A query goes once to each block with
    lists it asks for, not once per list, and keeps ``k`` rows there, whatever its lists.
    """
    metric, coding = vectors.normalize_metric(metric), coding or vectors.Coding()
    queries = queries.where(F.col("query_vector").isNotNull()).select(query_id, "query_vector", "lists")
    base = base.where(F.col(base_vector).isNotNull()).select("list_id", base_id, base_vector)
    size = queries.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size("lists").cast("bigint")).alias("asks"), F.max(F.size("query_vector")).alias("dim"),
        F.sum(F.size("lists") * F.size("query_vector").cast("bigint")).alias("cells"),
    ).first()
    if (size["cells"] or 0) * 8 <= broadcast_bytes and (size["asks"] or 0) * k <= min(kept_rows, SHARED_KEPT_ROWS):
        asks = queries.select(query_id, F.explode("lists").alias("list_id"), "query_vector")
        return top_k(asks, base, k, metric, ["list_id"], query_id=query_id, base_id=base_id, base_vector=base_vector, coding=coding)
    base_rows, query_rows = (max(1, int(limit / (8 * size["dim"]))) for limit in block_bytes)
    # codes are shorter than the vectors they stand for, which are made again in single precision, a list at a time
    base_rows = max(base_rows, min(4 * base_rows, int(block_bytes[0] / (8 * coding.width(size["dim"])))))
    a_core = -(-size["rows"] // base.sparkSession.sparkContext.defaultParallelism)  # a small table is work for all cores
    query_rows = min(query_rows, max(LEAST_QUERY_ROWS, min(kept_rows // k, a_core)))
    query_blocks = -(-size["rows"] // query_rows)
    # a row per list, no more than there are centroids: lists in order fill a block, a long one is cut into pieces
    lengths = base.where("list_id is not null").groupBy("list_id").agg(F.count(F.lit(1)).alias("n")).orderBy("list_id").toArrow()
    lists, n = lengths.column("list_id").to_numpy(), lengths.column("n").to_numpy()
    long = n > base_rows
    block = np.cumsum(np.where(long, base_rows, n)) // base_rows + np.cumsum(long | np.concatenate([[False], long[:-1]]))
    block = np.unique(block, return_inverse=True)[1] if len(n) else block
    pieces = np.where(long, -(-n // base_rows), 1)
    n_cells = int(np.unique(np.stack([block, pieces]), axis=1)[1].sum()) * query_blocks if len(n) else 1
    spark = base.sparkSession
    layout = spark.createDataFrame(
        [(int(a), int(b), int(c)) for a, b, c in zip(lists, block, pieces)], "list_id bigint, _block bigint, _pieces bigint"
    )
    base_side = base.join(F.broadcast(layout), "list_id").select(
        "list_id", base_id, base_vector, "_block", F.pmod(F.xxhash64(base_id, base_vector), "_pieces").alias("_piece"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))).alias("_query_block"),
    )
    numbered = queries.withColumn("_query_block", F.pmod(F.xxhash64(query_id, "query_vector"), F.lit(query_blocks)).cast("bigint"))
    query_side = _sent_to_blocks(numbered, lists, block, pieces)
    out_schema = T.StructType([queries.schema[query_id], base.schema["list_id"], base.schema[base_id], T.StructField("score", T.DoubleType())])
    arrow_schema = vectors.arrow_schema(out_schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return arrow_schema.empty_table()
        query_matrix = vectors.matrix_of(left.column("query_vector"))
        stored = vectors.matrix_of(right.column(base_vector), coding.width(query_matrix.shape[1]))
        names = vectors.sortable(right.column(base_id))
        by_name = np.argsort(names, kind="stable")
        place = np.empty(len(names), dtype=np.int64)
        place[by_name] = np.arange(len(names))  # rows in the order of their ids
        asked = left.column("lists").combine_chunks()
        asked_list = asked.flatten().to_numpy(zero_copy_only=False)
        asked_by = np.repeat(np.arange(left.num_rows), pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False))
        by_list = np.argsort(asked_list, kind="stable")
        asked_list, asked_by = asked_list[by_list], asked_by[by_list]
        list_of = right.column("list_id").to_numpy()
        best = vectors.Best(k, left.num_rows, wait=k * left.num_rows)
        order = np.argsort(list_of, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(list_of[order])) + 1):
            a, b = np.searchsorted(asked_list, list_of[rows[0]], "left"), np.searchsorted(asked_list, list_of[rows[0]], "right")
            if a < b:
                wanted = asked_by[a:b]
                bars = best.bars_of((), wanted)
                best.keep((), *vectors.block_top_k(metric, wanted, query_matrix[wanted], place[rows], stored[rows], k, coding, bars))
        best.sort(())
        if () not in best.kept:
            return arrow_schema.empty_table()
        query, found, score = best.kept[()]
        at = pa.array(by_name[found])
        columns = [left.column(query_id).take(pa.array(query)), right.column("list_id").take(at), right.column(base_id).take(at), pa.array(score)]
        return pa.Table.from_arrays(columns, schema=arrow_schema)

    partial = _by_cell(query_side, base_side, ["_block", "_piece", "_query_block"], n_cells, search, out_schema)
    best_first = F.col("score").asc() if metric == "L2" else F.col("score").desc()
    if metric == "L2":
        partial = partial.withColumn("score", F.abs("score"))
    ranking = Window.partitionBy(query_id).orderBy(best_first, base_id)
    return partial.withColumn("rank", F.row_number().over(ranking).cast("bigint")).where(F.col("rank") <= k)


def _sent_to_blocks(queries: DataFrame, lists: np.ndarray, block: np.ndarray, pieces: np.ndarray) -> DataFrame:
    """A row per query, block and piece, with the lists of the block the query asks for."""
    position = queries.columns.index("lists")
    schema = T.StructType([*queries.schema.fields, T.StructField("_block", T.LongType()), T.StructField("_piece", T.LongType())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(position)
            number = asked.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(lists, number), max(0, len(lists) - 1))
            held = lists[at] == number if len(lists) else np.zeros(len(number), bool)  # an empty list has no rows to find
            row, at = row[held], at[held]
            order = np.lexsort((at, block[at], row))
            row, at = row[order], at[order]
            if not len(row):
                continue
            first = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(block[at]) != 0)]))
            offsets = pa.array(np.append(first, len(row)).astype(np.int32))
            groups = pa.ListArray.from_arrays(offsets, pa.array(lists[at].astype(np.int64)))
            copies = pieces[at[first]]
            which = np.repeat(np.arange(len(first)), copies)
            piece = np.arange(len(which)) - np.repeat(np.cumsum(copies) - copies, copies)
            rows = pa.array(row[first][which])
            columns = [groups.take(pa.array(which)) if i == position else batch.column(i).take(rows) for i in range(batch.num_columns)]
            columns += [pa.array(block[at[first]][which].astype(np.int64)), pa.array(piece.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return queries.mapInArrow(send, schema)


def distances(hits: DataFrame) -> DataFrame:
    """Raw cosine search: ids and ``1 - cosine``, no payload, nearest first."""
    return hits.withColumn("distance", r6(1.0 - F.col("score"))).drop("score")


def by_source(hits_within_source: DataFrame, agent_mode: str, k: int, query_id: str, base_id: str) -> DataFrame:
    """Results per source (``multi_agent``) or one list over all sources (``single_agent``)."""
    if agent_mode == "multi_agent":
        return hits_within_source
    if agent_mode != "single_agent":
        raise ValueError("agent_mode must be single_agent or multi_agent")
    ranking = Window.partitionBy(query_id).orderBy(F.desc("score"), base_id)
    return hits_within_source.withColumn("rank", F.row_number().over(ranking).cast("bigint")).where(
        F.col("rank") <= k
    )


def position_scores(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Scores for a result list that has only an order: 1 for the first, falling by 1/n."""
    in_list = Window.partitionBy(query_id)
    size = F.greatest(F.count(F.lit(1)).over(in_list), F.lit(1))
    return hits.withColumn("position_score", r6(1.0 - (F.col("rank") - 1) / size))


def explode_flat_result(frames: DataFrame, query_offset: str, ids: str, dists: str, topk: int) -> DataFrame:
    """Row-major flat ``nq x topk`` arrays as one row per (query, rank); lengths must match exactly."""
    checked = frames.withColumn(
        "_pairs",
        F.when(
            (F.size(ids) == F.size(dists)) & (F.size(ids) % topk == 0), F.arrays_zip(ids, dists)
        ).otherwise(F.raise_error(F.lit("flat result arrays do not fit nq x topk"))),
    )
    return checked.select(query_offset, F.posexplode("_pairs").alias("_pos", "_pair")).select(
        query_offset,
        F.expr(f"cast(_pos div {topk} as bigint)").alias("query_idx"),
        F.expr(f"cast(_pos % {topk} as bigint)").alias("rank"),
        F.col(f"_pair.{ids}").alias("id"),
        F.col(f"_pair.{dists}").cast("double").alias("distance"),
    )


def _diverse(fetched_id: str, k: int, weight: float, metric: str):
    """Greedy picks among one query's fetched rows."""

    def pick(table: pa.Table) -> pa.Table:
        names = vectors.sortable(table.column(fetched_id))
        order = np.argsort(names, kind="stable")  # of equal rows the smallest id is picked
        table, names = table.take(pa.array(order)), names[order]
        nearness = table.column("score").to_numpy()
        nearness = -nearness if metric == "L2" else nearness
        matrix = vectors.matrix_of(table.column("_vector"))
        between = np.round(vectors.scores(metric, matrix, matrix), 6)
        between = -np.abs(between) if metric == "L2" else between
        value, covered = nearness.copy(), np.full(len(names), -np.inf)
        left, picked, gains = np.ones(len(names), bool), [], []
        for _ in range(min(k, len(names))):
            best = int(np.argmax(np.where(left, value, -np.inf)))
            picked.append(best), gains.append(float(value[best]))
            left[best] = False
            covered = np.maximum(covered, between[best])
            value = np.round(weight * nearness - (1 - weight) * covered, 9)
        out = table.take(pa.array(picked)).drop_columns(["_vector"])
        return out.append_column("gain", pa.array(gains)).append_column("pick", pa.array(range(1, len(picked) + 1), pa.int64()))

    return pick


def mmr(
    queries: DataFrame, base: DataFrame, k: int = MMR_K, fetch_k: int = MMR_FETCH, weight: float = MMR_WEIGHT, metric: str = "COSINE",
    query_id: str = "query_id", query_vector: str = "query_vector", base_id: str = "object_id", base_vector: str = "embedding",
) -> DataFrame:
    """``(query_id, base_id, score, gain, pick)``: of the ``fetch_k`` nearest rows, ``k`` that also differ from each other.

    The first pick is the nearest row.  Each next one has the most
    ``weight * nearness - (1 - weight) * (its largest nearness to a row picked before)``.
    A query's fetched rows meet in one group of at most ``fetch_k``; ids in ``base`` must be unique.
    """
    metric = vectors.normalize_metric(metric)
    if not 0 <= weight <= 1:
        raise ValueError("weight must be between 0 and 1")
    hits = top_k(queries, base, fetch_k, metric, query_id=query_id, query_vector=query_vector, base_id=base_id, base_vector=base_vector).drop("rank")
    fetched = hits.join(base.select(base_id, F.col(base_vector).alias("_vector")), base_id).select(query_id, base_id, "score", "_vector")
    kinds = {f.name: f.dataType.simpleString() for f in hits.schema}
    schema = f"`{query_id}` {kinds[query_id]}, `{base_id}` {kinds[base_id]}, score double, gain double, pick bigint"
    return fetched.groupBy(query_id).applyInArrow(_diverse(base_id, k, weight, metric), schema)
