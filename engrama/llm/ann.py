"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a documented sample (``SAMPLE`` vectors, the first by a hash of
their id) and has ``BRANCHES`` children per node, down to leaves of about
``LEAF_ROWS`` vectors of the whole table, but of ``LEAST_SAMPLE`` of the sample at
least: the tree, which goes to every task, has no more than about a thousand leaves,
and beyond 262,144 vectors leaves grow with the table.  Every vector of the table is
put into the leaf its descent by nearest center ends in.

A query walks the tree with a priority queue: the node with the largest possible
inner product so far (center times query, plus the query's length times how far the
node's sample reached from its center) is opened next, until enough leaves came out.
How many are enough is calibrated: distinct sample vectors are compared with brute
force over the others, so that copies don't stand for all, and the visits widen until
``RECALL`` of the true neighbours lie in the leaves visited.  Leaves without vectors
don't count, a query goes on until its leaves hold ``k`` vectors besides its own rows,
and it always visits the leaf that copies of it are in.

Neighbouring leaves are bundled up to ``BLOCK_ROWS`` vectors, and a larger leaf, full
of copies, is cut into several such bundles.  A query goes once to each bundle that
holds leaves it visits, is compared with the vectors of those leaves and leaves its
best k, and a second step merges those.  Asks are counted per bundle: only a bundle
asked by more than ``BLOCK_ROWS`` queries is sent several times, once per that many
queries, and one that none asks isn't sent.  Scores are summed in double precision, one component after
another, so equal vectors get equal scores wherever they are.

Results for odd input: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; copies are candidates each, ties go
to the smaller id; an empty table gives no rows; rows with a null id take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engrama.llm.common import sized, text_batches
from engrama.llm.hashing import random_words
from engrama.session import materialize

K = 20
BRANCHES = 8
SAMPLE = 8192         # vectors the tree is fitted on
LEAF_ROWS = 256       # vectors of the table per leaf, on average
LEAST_SAMPLE = 8      # sample vectors per leaf at least
ROUNDS = 8            # of k-means per node
TRIALS = 200          # sample queries for the calibration
RECALL = 0.95         # share of true neighbours the visited leaves must hold
BLOCK_ROWS = 16_384   # vectors of neighbouring leaves, and queries, compared in one group
SCORE_CELLS = 4_000_000  # scores held at once


class Tree:
    """Centers, reaches and children of all nodes, root first."""

    def __init__(self, sample: np.ndarray, leaf_rows: int):
        self.centers, self.reach, self.children, self.leaf = [], [], [], []
        self.leaves = 0
        self.rows: list[np.ndarray] = []  # the sample's rows by leaf
        self._grow(sample, np.arange(len(sample)), max(LEAST_SAMPLE, leaf_rows))
        self.centers = np.array(self.centers)
        self.reach = np.array(self.reach)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, leaf_rows: int) -> int:
        node = len(self.centers)
        mine = sample[rows]
        center = mine.mean(axis=0)
        self.centers.append(center)
        # distances of a sample understate the table's, so the mean and three deviations stand for the farthest
        far = np.linalg.norm(mine - center, axis=1)
        self.reach.append(float(far.mean() / np.sqrt(sample.shape[1]) + far.std()))
        self.children.append(()), self.leaf.append(-1)
        groups = self._split(mine, node) if len(rows) > leaf_rows else []
        if len(groups) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            self.rows.append(rows)
        else:
            self.children[node] = tuple(self._grow(sample, rows[g], leaf_rows) for g in groups)
        return node

    @staticmethod
    def _split(rows: np.ndarray, seed: int) -> list[np.ndarray]:
        order = np.argsort(random_words(len(rows), 41 + seed))
        centers = np.unique(rows[order[:4 * BRANCHES]], axis=0)
        centers = centers[np.argsort(random_words(len(centers), 43 + seed))[:BRANCHES]]
        for _ in range(ROUNDS):
            near = nearest(rows, centers)
            centers = np.array([rows[near == c].mean(axis=0) for c in np.unique(near)])
        near = nearest(rows, centers)
        return [np.flatnonzero(near == c) for c in np.unique(near)]

    def descend(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest child at each node."""
        out = np.empty(len(vectors), dtype=np.int32)
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            near = nearest(vectors[rows], self.centers[kids])
            stack.extend((int(kids[c]), rows[near == c]) for c in np.unique(near))
        return out

    def best_first(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, most promising first."""
        promise = self.centers @ query + np.linalg.norm(query) * self.reach
        queue = [(-promise[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (-promise[child], child))

    def opened(self, query: np.ndarray, own: int, visits: int, rows: int, sizes: dict[int, int]) -> list[int]:
        """The leaf ``own``, and the first leaves with vectors until there are ``visits`` of them that hold ``rows``."""
        found, held = [], 0
        for leaf in self.best_first(query):
            if len(found) >= visits and held >= rows:
                break
            if leaf in sizes:
                found.append(leaf)
                held += sizes[leaf]
        return found if own in found or own not in sizes else [*found, own]


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(axis=1) - 2 * (rows @ centers.T), axis=1)


def calibrate(tree: Tree, sample: np.ndarray, k: int, recall: float) -> int:
    """The fewest leaf visits that reach ``recall`` over distinct trial vectors of the sample, among its distinct vectors."""
    leaf_of = np.empty(len(sample), dtype=np.int64)
    for leaf, rows in enumerate(tree.rows):
        leaf_of[rows] = leaf
    firsts = np.sort(np.unique(sample, axis=0, return_index=True)[1])
    sample, leaf_of = sample[firsts], leaf_of[firsts]
    trials = np.argsort(random_words(len(sample), 47))[:TRIALS]
    needed = []
    for q in trials:
        scores = sample @ sample[q]
        scores[q] = -np.inf
        best = np.argsort(-scores, kind="stable")[:min(k, len(sample) - 1)]
        place = np.empty(tree.leaves, dtype=np.int64)
        place[list(tree.best_first(sample[q]))] = np.arange(tree.leaves)
        needed.append(place[leaf_of[best]] + 1)
    if not needed or not len(needed[0]):
        return tree.leaves
    return int(np.quantile(np.concatenate(needed), recall, method="higher"))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): ids and double vectors that take part, of the most common length."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0"
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _leaves(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.descend(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

    return run


def bundles_of(sizes: dict[int, int], rows: int) -> dict[int, tuple[int, int]]:
    """(first bundle, bundles) of each leaf: neighbours in the tree share a bundle of about ``rows`` vectors,
    and a larger leaf has several of its own."""
    out, bundle, held = {}, 0, 0
    for leaf, size in sorted(sizes.items()):
        parts = -(-size // rows)
        if held and held + size > rows:
            bundle, held = bundle + 1, 0
        out[leaf] = (bundle, parts)
        held += size
        if parts > 1:
            bundle, held = bundle + parts, 0
    return out


def _visits(tree, visits: int, k: int, sizes: dict[int, int], bundles: dict[int, tuple[int, int]]):
    """Each query once per bundle it visits, with the leaves it visits there; ``own`` is how many rows of the table have its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, bundle, leaves = [], [], []
            queries, own = _matrix(batch.column(1)), batch.column(2).to_pylist()
            for i, (q, home) in enumerate(zip(queries, tree.value.descend(queries).tolist())):
                wanted: dict[int, list[int]] = {}
                for leaf in tree.value.opened(q, home, visits, k + own[i], sizes):
                    first, parts = bundles[leaf]
                    for part in range(parts):
                        wanted.setdefault(first + part, []).append(leaf)
                row.extend([i] * len(wanted)), bundle.extend(wanted), leaves.extend(wanted.values())
            asking = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bundle, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), asking], ["bundle", "leaves", "query_id"]
            )

    return run


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up in the order of components."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def best_of_block(query_ids, queries, ids, vectors, k: int, allowed=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, vec position, score) of the k best per query, among the allowed, the query's own row left out."""
    rough = queries @ vectors.T
    if allowed is not None:
        rough[~allowed] = -np.inf
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    n = min(k, len(ids))
    bar = np.partition(rough, len(ids) - n, axis=1)[:, len(ids) - n]
    slack = 1e-9 * (1 + np.abs(rough, where=np.isfinite(rough), out=np.zeros_like(rough)).max(axis=1))
    at, spot = np.nonzero((rough >= (bar - slack)[:, None]) & np.isfinite(rough))
    scores = exact_scores(queries[at], vectors[spot])
    order = np.lexsort((ids[spot], -scores, at))
    at, spot, scores = at[order], spot[order], scores[order]
    starts = np.searchsorted(at, np.arange(len(query_ids)))
    keep = np.arange(len(at)) - starts[at] < k
    return at[keep], spot[keep], scores[keep]


def _compare(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            qid, q = left.column("query_id").to_numpy(), _matrix(left.column("q").combine_chunks())
            ids, v = right.column("vec_id").to_numpy(), _matrix(right.column("v").combine_chunks())
            leaves, place = np.unique(right.column("leaf").to_numpy(), return_inverse=True)
            visited = [np.isin(leaves, x) for x in left.column("leaves").to_pylist()]
            step = max(1, SCORE_CELLS // len(ids))
            for a in range(0, len(qid), step):
                allowed = np.array(visited[a:a + step])[:, place]
                at, spot, scores = best_of_block(qid[a:a + step], q[a:a + step], ids, v, k, allowed)
                parts.append((qid[a:a + step][at], ids[spot], scores))
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def index(vectors: DataFrame, k: int = K) -> tuple[Tree | None, int, DataFrame]:
    """The fitted tree, calibrated visits, and every usable vector with its leaf."""
    rows = materialize(usable(vectors))
    total = rows.count()
    # ids alone are ordered for the sample; the vectors follow by the ids picked
    sample_ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    sample = np.array([r.v for r in rows.join(F.broadcast(sample_ids), "vec_id", "left_semi").dropDuplicates(["vec_id"]).collect()])
    if not len(sample):
        return None, 0, rows
    tree = Tree(sample, int(LEAF_ROWS * len(sample) / total))
    sent = rows.sparkSession.sparkContext.broadcast(tree)
    placed = materialize(text_batches(rows).mapInArrow(_leaves(sent), "leaf int, vec_id bigint, v array<double>"))
    return tree, calibrate(tree, sample, k, RECALL), placed


def search(queries: DataFrame, vectors: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each query (vec_id, embedding)."""
    tree, visits, placed = index(vectors, k)
    schema = "query_id bigint, vec_id bigint, score double"
    if tree is None:
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = usable(queries).dropDuplicates(["vec_id"]).where(F.size("v") == int(tree.centers.shape[1]))
    sent = queries.sparkSession.sparkContext.broadcast(tree)
    sizes = {r.leaf: r.rows for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).collect()}  # as many as leaves
    bundles = bundles_of(sizes, BLOCK_ROWS)
    # a query's own rows are no candidates; one is the rule, so only ids with more are looked up
    repeats = materialize(placed.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own")).where("own > 1"))
    asked = materialize(asked.join(sized(repeats, 16), "vec_id", "left").select("vec_id", "v", F.coalesce("own", F.lit(1)).alias("own")))
    # pinned without the query vectors, which would be stored once per bundle
    asks = materialize(text_batches(asked).mapInArrow(_visits(sent, visits, k, sizes, bundles), "bundle int, leaves array<int>, query_id bigint"))
    # both sides are cut: a group holds about BLOCK_ROWS vectors of neighbouring leaves and as many queries
    parts = {r.bundle: -(-r.rows // BLOCK_ROWS) for r in asks.groupBy("bundle").agg(F.count(F.lit(1)).alias("rows")).collect()}  # as many as bundles
    blocks = [(leaf, first, count) for leaf, (first, count) in bundles.items()]
    spark = queries.sparkSession
    leaf_table = F.broadcast(spark.createDataFrame(blocks, "leaf int, first int, blocks int"))
    part_table = F.broadcast(spark.createDataFrame(list(parts.items()), "bundle int, parts int"))
    blocked = placed.join(leaf_table, "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).alias("bundle"), "leaf", "vec_id", "v"
    ).join(part_table, "bundle").select("bundle", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "leaf", "vec_id", "v")
    asking = asks.join(part_table, "bundle").select(
        F.col("bundle").alias("ask_bundle"), F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("ask_part"), "leaves", "query_id"
    ).join(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
    best = asking.groupBy("ask_bundle", "ask_part").cogroup(blocked.groupBy("bundle", "part")).applyInArrow(_compare(k), schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def brute_force(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> dict[int, list[int]]:
    """For tests: the true neighbours."""
    at, spot, _ = best_of_block(query_ids, queries, ids, vectors, k)
    out: dict[int, list[int]] = {int(q): [] for q in query_ids}
    for a, s in zip(at, spot):
        out[int(query_ids[a])].append(int(ids[s]))
    return out
