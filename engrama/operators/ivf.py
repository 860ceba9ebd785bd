"""Inverted-list indexes: coarse lists, scalar and product quantization, index tables.

A query brings the numbers of the lists it probes and goes once to each block of
lists; a hot list is cut into blocks there.  Centroids and
codebooks are small, but grow with the data: their size is checked before they
are sent to the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import BROADCAST_BYTES, DEFAULT_TOP_K, PQ_BITS, PQ_PARTS, PQ_RERANK
from engrama.functions.vectors import ByteRanges, PartTables, block_top_k, distances_l2, matrix_of, nearest, normalize_metric, scores
from engrama.operators import vector_search as vs
from engrama.operators.filters import only_of
from engrama.session import materialize
from engrama.sources.snapshots import spread_by

CODES = T.ArrayType(T.ShortType())
FILTERED_LISTS = 4_096  # list numbers written into a filter
FOLDERS = 128  # folders of a stored index at most
LISTS_PER_FOLDER = 8


def list_count(n_vectors: int, nlist: int = 0) -> int:
    return nlist or max(1, math.isqrt(n_vectors))


def probe_count(nlist: int, nprobe: int = 0) -> int:
    return min(nlist, nprobe or max(1, nlist // 4))


# --- centroids and lists ----------------------------------------------------

def sampled_centroids(base: DataFrame, nlist: int, id_column: str = "object_id") -> DataFrame:
    """``(list_id, centroid)``: a random sample of the vectors, the first ``nlist`` by a digest of their id."""
    first = base.select(digest_of(id_column).alias("_digest"), "embedding").orderBy("_digest").limit(nlist)
    numbered = F.row_number().over(Window.orderBy("_digest")) - 1  # over nlist rows
    return first.select(numbered.cast("bigint").alias("list_id"), F.col("embedding").alias("centroid"))


def digest_of(id_column: str) -> Column:
    """An order of ids that has nothing to do with the vectors."""
    return F.md5(F.col(id_column).cast("string"))


def kmeans_centroids(base: DataFrame, nlist: int, sample: float = 1.0, iterations: int = 10, seed: int = 17) -> DataFrame:
    """``(list_id, centroid)`` fitted by k-means, on a sample for large tables."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = base.sample(sample, seed) if sample < 1 else base
    features = rows.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=nlist, maxIter=iterations, seed=seed).fit(features)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return base.sparkSession.createDataFrame(centers, "list_id bigint, centroid array<float>")


def assign_lists(base: DataFrame, centroids: DataFrame, id_column: str = "object_id", metric: str = "IP") -> DataFrame:
    """Add ``list_id``: the closest centroid by the index's metric, ties to the smaller id.

    For vectors of unequal length take the metric that searches will use, so that
    a long centroid doesn't attract everything.
    """
    metric = normalize_metric(metric)
    size = centroids.agg(F.sum(F.size("centroid").cast("bigint"))).first()[0] or 0
    if size * 8 > BROADCAST_BYTES:
        closest = vs.top_k(
            base, centroids, k=1, metric=metric, query_id=id_column, query_vector="embedding",
            base_id="list_id", base_vector="centroid",
        )
        return base.join(closest.select(id_column, "list_id"), id_column)
    packed = centroids.orderBy("list_id").toArrow()  # size checked above
    ids = packed.column("list_id").to_numpy()
    shared = base.sparkSession.sparkContext.broadcast((ids, matrix_of(packed.column("centroid"))))
    position = base.columns.index("embedding")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        list_ids, centers = shared.value
        for batch in batches:
            if batch.num_rows:
                rows = matrix_of(batch.column(position), centers.shape[1])
                chosen = nearest(rows, centers, lambda a, b: scores(metric, a, b))
                yield batch.append_column("list_id", pa.array(list_ids[chosen]))

    return base.mapInArrow(assign, T.StructType([*base.schema.fields, T.StructField("list_id", T.LongType())]))


def probes(queries: DataFrame, centroids: DataFrame, nprobe: int, query_id: str = "query_id", metric: str = "IP") -> DataFrame:
    """Queries with their best lists: ``(query_id, query_vector, lists)``, no row moved where ids are unique."""
    metric = normalize_metric(metric)
    size = centroids.agg(F.sum(F.size("centroid").cast("bigint"))).first()[0] or 0
    queries = queries.where(F.col("query_vector").isNotNull() & F.col(query_id).isNotNull()).select(query_id, "query_vector")
    if not 0 < size * 8 <= BROADCAST_BYTES or not queries.groupBy(query_id).count().where("count > 1").isEmpty():
        # rows of one id share its lists
        best = vs.top_k(queries, centroids, k=nprobe, metric=metric, query_id=query_id, base_id="list_id", base_vector="centroid")
        lists = best.groupBy(query_id).agg(F.collect_list("list_id").alias("lists"))
        return queries.join(lists, query_id).select(query_id, "query_vector", "lists")
    packed = centroids.orderBy("list_id").toArrow()  # size checked above
    ids = packed.column("list_id").to_numpy()
    shared = queries.sparkSession.sparkContext.broadcast((ids, matrix_of(packed.column("centroid"))))
    schema = T.StructType([*queries.schema.fields, T.StructField("lists", T.ArrayType(T.LongType()))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        list_ids, centers = shared.value
        for batch in batches:
            if batch.num_rows:
                rows = matrix_of(batch.column(1), centers.shape[1])
                row, chosen, _ = block_top_k(metric, np.arange(len(rows)), rows, list_ids, centers, nprobe)
                offsets = pa.array(np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32))
                yield batch.append_column("lists", pa.ListArray.from_arrays(offsets, pa.array(chosen, type=pa.int64())))

    return queries.mapInArrow(choose, schema)


def ivf_search(
    queries: DataFrame, assigned: DataFrame, centroids: DataFrame, nprobe: int, k: int = DEFAULT_TOP_K,
    metric: str = "COSINE", query_id: str = "query_id", base_id: str = "object_id", list_metric: str = "IP",
) -> DataFrame:
    """Exact search inside the probed lists; with every list probed it equals the full search."""
    probed = materialize(probes(queries, centroids, nprobe, query_id, list_metric))  # read three times below
    wanted = of_lists(assigned, asked_lists(probed))
    found = vs.top_k_in_lists(probed, wanted, k, metric, query_id, base_id)
    return found.drop("list_id")


def asked_lists(probed: DataFrame) -> DataFrame:
    return probed.select(F.explode("lists").alias("list_id"))


def of_lists(rows: DataFrame, probed: DataFrame, n_folders: int = 0) -> DataFrame:
    """Rows of the lists somebody asked for.

    List numbers, as long as they are few, become a filter: nothing is shuffled, and of a
    stored index (``n_folders`` of its registry row) only their folders are read, there
    only row groups that may hold them.
    """
    lists = materialize(probed.select("list_id").distinct())
    if n_folders:
        folders = lists.select(F.pmod("list_id", F.lit(n_folders)).alias("folder")).distinct().collect()  # FOLDERS at most
        rows = rows.where(F.col("folder").isin([r.folder for r in folders]))
    if lists.count() <= FILTERED_LISTS:
        return rows.where(F.col("list_id").isin([r.list_id for r in lists.collect()]))
    return rows.join(F.broadcast(lists), "list_id", "left_semi")  # no more numbers than centroids


# --- scalar quantization ----------------------------------------------------

def dimension_ranges(base: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every dimension: one row per task, then one per dimension."""
    schema = T.StructType([T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType()))])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                rows = matrix_of(batch.column(0))
                low = rows.min(axis=0) if low is None else np.minimum(low, rows.min(axis=0))
                high = rows.max(axis=0) if high is None else np.maximum(high, rows.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_pydict({"low": [low], "high": [high]})

    per_task = base.select("embedding").mapInArrow(ends, schema)
    cells = per_task.select(F.posexplode(F.arrays_zip("low", "high")).alias("dim", "ends"))
    merged = cells.groupBy("dim").agg(F.min("ends.low").alias("low"), F.max("ends.high").alias("high"))
    found = merged.orderBy("dim").toArrow()  # one row per dimension
    return found.column("low").to_numpy(), found.column("high").to_numpy()


def _map_vectors(df: DataFrame, source: str, target: str, kind: T.DataType, convert) -> DataFrame:
    """Replace column ``source`` by ``target``, computed on the matrix of every Arrow batch."""
    position = df.columns.index(source)
    schema = T.StructType([
        T.StructField(target, kind) if f.name == source else f for f in df.schema.fields
    ])
    value_type = pa.int16() if isinstance(kind.elementType, T.ShortType) else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = convert(matrix_of(batch.column(position)))
            offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
            column = pa.ListArray.from_arrays(offsets, pa.array(np.ravel(out), type=value_type))
            columns = [column if i == position else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def sq8_encode(base: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``embedding`` as one byte-sized ``codes`` entry per dimension."""
    width = high - low

    def encode(rows: np.ndarray) -> np.ndarray:
        scaled = np.divide(255 * (rows - low), width, out=np.zeros_like(rows), where=width > 0)
        return np.floor(scaled + 0.5).astype(np.int16)

    return _map_vectors(base, "embedding", "codes", CODES, encode)


# --- product quantization ---------------------------------------------------

def sampled_codebooks(base: DataFrame, parts: int = PQ_PARTS, bits: int = PQ_BITS, id_column: str = "object_id") -> np.ndarray:
    """``(parts, 2**bits, dim / parts)``: slices of a random sample of the vectors."""
    first = base.select(digest_of(id_column).alias("_digest"), "embedding").orderBy("_digest").limit(2**bits)
    rows = matrix_of(first.toArrow().column("embedding"))
    return _sliced(rows, parts).transpose(1, 0, 2)


def kmeans_codebooks(base: DataFrame, parts: int = PQ_PARTS, bits: int = PQ_BITS, sample: float = 1.0) -> np.ndarray:
    """The same shape, one k-means fit per part."""
    dim = base.select(F.size("embedding")).first()[0]
    if dim % parts:
        raise ValueError("the number of parts must divide the dimension")
    width, books = dim // parts, []
    for part in range(parts):
        piece = base.select(F.slice("embedding", part * width + 1, width).alias("embedding"))
        fitted = kmeans_centroids(piece, 2**bits, sample)
        books.append(matrix_of(fitted.orderBy("list_id").toArrow().column("centroid")))
    return np.stack(books)


def _sliced(rows: np.ndarray, parts: int) -> np.ndarray:
    if rows.shape[1] % parts:
        raise ValueError("the number of parts must divide the dimension")
    return rows.reshape(len(rows), parts, rows.shape[1] // parts)


def pq_encode(base: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``embedding`` as one codebook entry per part: the nearest, ties to the smaller number."""
    def encode(rows: np.ndarray) -> np.ndarray:
        sliced = _sliced(rows, len(codebooks))
        codes = [
            nearest(sliced[:, p], book, lambda a, b: -(distances_l2(a, b) ** 2)) for p, book in enumerate(codebooks)
        ]
        return np.stack(codes, axis=1).astype(np.int16)

    return _map_vectors(base, "embedding", "codes", CODES, encode)


def _pair_cosines(pairs: DataFrame) -> DataFrame:
    """``(query id, base id, score)`` from rows that hold both vectors in their last two columns."""
    schema = T.StructType([*pairs.schema.fields[:2], T.StructField("score", T.DoubleType())])

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = matrix_of(batch.column(2)), matrix_of(batch.column(3))
                lengths = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
                score = np.divide((a * b).sum(axis=1), lengths, out=np.zeros(len(a)), where=lengths > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.round(score, 6) + 0.0)], names=schema.names
                )

    return pairs.mapInArrow(cosines, schema)


# --- stored indexes ---------------------------------------------------------

def build_index(
    base: DataFrame, centroids: DataFrame, path: str, segment_id: str, index_type: str = "IVF_FLAT",
    codebooks: np.ndarray | None = None, id_column: str = "object_id", metric: str = "IP",
    nprobe: int = 0, sq_type: str = "INT8", parts: int = PQ_PARTS, bits: int = PQ_BITS,
) -> DataFrame:
    """Write an index as tables; returns the registry row, which keeps its settings for searches.

    ``IVF_FLAT`` stores vectors.  ``IVF_SQ8`` stores a byte per dimension and the
    dimensions' ranges, or vectors with ``sq_type="FP32"``.  ``IVF_PQ`` stores a code per
    part (``parts`` of ``bits``), the codebooks, and the vectors apart, which only the exact
    ranking of candidates reads.  Lists lie sorted in at most ``FOLDERS`` folders.
    """
    if sq_type not in ("INT8", "FP32"):
        raise ValueError("sq_type must be INT8 or FP32")
    spark = base.sparkSession
    assigned = assign_lists(base.select(id_column, "embedding"), centroids, id_column, metric)
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    nlist = spark.read.parquet(f"{path}/centroids").count()
    n_folders = max(1, min(FOLDERS, nlist // LISTS_PER_FOLDER))
    coded_as = {"IVF_SQ8": "bytes" if sq_type == "INT8" else "vectors", "IVF_PQ": "parts"}.get(index_type, "vectors")
    if coded_as != "vectors":
        assigned = materialize(assigned)  # read for the ranges, the codes and the vectors
    if coded_as == "bytes":
        low, high = dimension_ranges(assigned)
        ranges = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(low, high))]
        spark.createDataFrame(ranges, "dim int, low double, high double").write.mode("overwrite").parquet(f"{path}/ranges")
        stored = sq8_encode(assigned, low, high)
    elif coded_as == "parts":
        books = sampled_codebooks(base, parts, bits, id_column) if codebooks is None else codebooks
        entries = [(p, c, [float(x) for x in v]) for p, book in enumerate(books) for c, v in enumerate(book)]
        spark.createDataFrame(entries, "part int, code int, entry array<double>").write.mode("overwrite").parquet(f"{path}/codebooks")
        stored = pq_encode(assigned, books)
        _write_lists(assigned, f"{path}/vectors", n_folders)
    else:
        stored = assigned
    _write_lists(stored, f"{path}/lists", n_folders)
    registry = read_lists(spark, path).agg(
        F.lit(segment_id).alias("segment_id"), F.lit(index_type).alias("index_type"), F.lit(metric).alias("list_metric"),
        F.lit(coded_as).alias("coded_as"), F.lit(n_folders).alias("n_folders"), F.lit(probe_count(nlist, nprobe)).alias("nprobe"),
        F.count_distinct("list_id").alias("n_lists"), F.count(F.lit(1)).alias("n_vectors"), F.lit(path).alias("path"),
    )
    registry.write.mode("overwrite").parquet(f"{path}/registry")
    return spark.read.parquet(f"{path}/registry")


def _write_lists(rows: DataFrame, path: str, n_folders: int) -> None:
    """A folder holds every ``n_folders``-th list, its files sorted by list."""
    by_folder = spread_by(rows.withColumn("folder", F.pmod("list_id", F.lit(n_folders))), "folder")
    by_folder.sortWithinPartitions("folder", "list_id").write.mode("overwrite").partitionBy("folder").parquet(path)


def read_lists(spark: SparkSession, path: str, table: str = "lists") -> DataFrame:
    return spark.read.parquet(f"{path}/{table}")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, nprobe: int = 0, k: int = DEFAULT_TOP_K, metric: str = "COSINE",
    query_id: str = "query_id", base_id: str = "object_id", rerank: int = PQ_RERANK,
) -> DataFrame:
    """Search a stored index: only row groups of probed lists are read, and codes are compared as codes.

    Without ``nprobe`` as many lists are probed as the index was built for.  ``IVF_PQ`` finds
    ``k * rerank`` candidates by the queries' distance tables and ranks them by exact cosine.
    """
    registry = spark.read.parquet(f"{path}/registry").first()
    centroids = spark.read.parquet(f"{path}/centroids")
    probed = materialize(probes(queries, centroids, nprobe or registry.nprobe, query_id, registry.list_metric))
    rows = of_lists(read_lists(spark, path), asked_lists(probed), registry.n_folders)
    names = {"query_id": query_id, "base_id": base_id}
    if registry.coded_as == "parts":
        entries = spark.read.parquet(f"{path}/codebooks").orderBy("part", "code").toArrow()  # parts x codes rows
        parts = entries.column("part").to_numpy().max() + 1
        flat = matrix_of(entries.column("entry"))
        tables = PartTables(flat.reshape(parts, len(flat) // parts, -1))
        rough = materialize(vs.top_k_in_lists(probed, rows, k=k * rerank, metric="L2", base_vector="codes", coding=tables, **names))
        # a candidate's vector lies in the list it was found in
        stored = of_lists(read_lists(spark, path, "vectors"), rough, registry.n_folders).select(base_id, "list_id", "embedding")
        exact = rough.select(query_id, base_id, "list_id").join(only_of(stored, rough, base_id), [base_id, "list_id"])
        pairs = exact.join(queries.select(query_id, "query_vector"), query_id)
        ranking = Window.partitionBy(query_id).orderBy(F.desc("score"), base_id)
        scored = _pair_cosines(pairs.select(query_id, base_id, "query_vector", "embedding"))
        return scored.withColumn("rank", F.row_number().over(ranking).cast("bigint")).where(F.col("rank") <= k)
    if registry.coded_as == "bytes":
        ranges = spark.read.parquet(f"{path}/ranges").orderBy("dim").toArrow()  # one row per dimension
        coding = ByteRanges(ranges.column("low").to_numpy(), ranges.column("high").to_numpy())
        return vs.top_k_in_lists(probed, rows, k=k, metric=metric, base_vector="codes", coding=coding, **names).drop("list_id")
    return vs.top_k_in_lists(probed, rows, k=k, metric=metric, **names).drop("list_id")
