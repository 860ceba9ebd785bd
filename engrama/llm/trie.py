"""A trie of conversation prefixes, kept as flat arrays behind minimal perfect hashes.

A node is a distinct sequence of first turns.  Its digest (128 bits) is the XOR of the
digests of its turns, each taken with its place, so digests of all prefixes are running
totals and a long conversation needs no task of its own.  A digest that stands for two
different last turns or parents raises an error, so digests that agree mean equal prefixes.

The smallest member of a node owns it.  A shard takes some conversations that own nodes,
enumerates the digests on their paths and gives each a slot by a minimal perfect hash,
verified against the digest stored in the slot.  What owned nodes bring - a child for the
parent, a leaf, saved tokens - is scattered into arrays and accumulated through the array
of parent slots, deepest first.  Shards meet in one sum per node, so a first turn shared
by a third of all conversations is one row of each shard.  A path longer than ``SPAN``
is cut into parts; what lies below a part is carried in at its last node.

Results for odd input: turns are ordered by turn (null first), then role and text; null
roles and texts are empty; repeated rows are turns of their own; rows without a conv_id
belong to no conversation and make no node; no rows give no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engrama.llm.hashing import mix
from engrama.operators.numbering import number_segments, pinned_segments
from engrama.session import materialize, ship_package

SPAN = 4096              # nodes of one path in one shard
SHARD_ROWS = 1_000_000   # rows of a shard, on the average
GROUP, MOST = 5, 9       # conversations that share a first one; its first turns are taken modulo MOST
NO_ENDS = hashlib.sha256(b"").hexdigest()


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests: every digest has a slot of its own in [0, n).

    Level by level, digests alone in their cell of a bitmap take it; the others go on to
    the next level.  A slot is the number of set bits before its cell.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.high, self.low = np.zeros(len(high), np.uint64), np.zeros(len(high), np.uint64)
        left, taken = np.arange(len(high)), 0
        while len(left):
            size = len(left) * 3 // 2 + 1
            cell = self._cell(high[left], low[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            self.levels.append(alone)
            self.before.append(taken + np.cumsum(alone) - alone)
            done = alone[cell]
            slot = self.before[-1][cell[done]]
            self.high[slot], self.low[slot] = high[left[done]], low[left[done]]
            taken += len(slot)
            left = left[~done]

    @staticmethod
    def _cell(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(mix(high + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) ^ low) % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (alone, before) in enumerate(zip(self.levels, self.before)):
            cell = self._cell(high[left], low[left], level, len(alone))
            hit = alone[cell]
            out[left[hit]] = before[cell[hit]]
            left = left[~hit]
        if len(left) or (self.high[out] != high).any() or (self.low[out] != low).any():
            raise ValueError("a digest that has no slot")
        return out


def _halves(hexed: Column, *names: str) -> list[Column]:
    """The first 16 hex digits, the next 16, as signed numbers."""
    return [F.conv(F.substring(hexed, 16 * i + 1, 16), 16, -10).cast("bigint").alias(n) for i, n in enumerate(names)]


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, i, k1, k2, bytes): the turns in order from 0, their digests, and the bytes of their texts."""
    own = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),  # equal rows spread over tasks
    )
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    segments = pinned_segments(
        own, ["conv_id"], ["turn", "role", "text", "row"],
        ["conv_id", digest.alias("digest"), F.octet_length("text").cast("bigint").alias("bytes")],
    ).select("*", *_halves(F.col("digest"), "k1", "k2")).drop("digest")
    return materialize(number_segments(segments, ["conv_id"], "i"))


def rebuild(numbered: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first one of their group, and the lengths.

    Conversation c takes the first h turns of conversation c - c mod ``group`` (mod as of
    a floor, from 0), h = crc32(c as text) mod ``most``, then its own turns after its first h.
    Returns turns (conv_id, depth from 1, length, k1, k2, bytes) and (conv_id, length).
    """
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = own.select(
        "conv_id", "own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
        (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("first"),
    ).join(own.select(F.col("conv_id").alias("first"), F.col("own").alias("first_own")), "first", "left")
    head = F.least("h", F.coalesce("first_own", F.lit(0)))
    convs = materialize(convs.select(
        "conv_id", "h", head.alias("head"), (head + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
    ))
    given = numbered.where((F.pmod("conv_id", F.lit(group)) == 0) & (F.col("i") < most - 1)).select(
        F.explode(F.sequence(F.col("conv_id"), F.col("conv_id") + (group - 1))).alias("conv_id"), "i", "k1", "k2", "bytes", F.lit(True).alias("given"),
    )
    both = given.unionByName(numbered.withColumn("given", F.lit(False)))
    place = F.when(F.col("given"), F.col("i") + 1).otherwise(F.col("i") - F.col("h") + F.col("head") + 1)
    turns = both.join(convs, "conv_id").where(
        (F.col("given") & (F.col("i") < F.col("head"))) | (~F.col("given") & (F.col("i") >= F.col("h")))
    )
    return turns.select("conv_id", place.alias("depth"), "length", "k1", "k2", "bytes"), convs.select("conv_id", "length")


def paths_of(turns: DataFrame) -> DataFrame:
    """Each turn with the digest of its prefix (n1, n2) and of the prefix before it (p1, p2); (0, 0) is none."""
    stepped = turns.select("*", *_halves(F.sha2(F.concat_ws(":", "k1", "k2", "depth"), 256), "s1", "s2"))
    segments = pinned_segments(stepped, ["conv_id"], ["depth"])
    upto = Window.partitionBy("_segment", "conv_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    inside = segments.select("*", F.bit_xor("s1").over(upto).alias("x1"), F.bit_xor("s2").over(upto).alias("x2"))
    ends = segments.groupBy("_segment", "conv_id").agg(F.bit_xor("s1").alias("b1"), F.bit_xor("s2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    # only the first conversation of a segment began in an earlier one: at most one row per segment
    begun = ends.select("_segment", "conv_id", F.bit_xor("b1").over(before).alias("b1"), F.bit_xor("b2").over(before).alias("b2")).where("b1 IS NOT NULL")
    joined = inside.join(F.broadcast(begun), ["_segment", "conv_id"], "left")
    n = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)]
    return materialize(joined.select(
        "conv_id", "depth", "length", "k1", "k2", "bytes", n[0].alias("n1"), n[1].alias("n2"),
        n[0].bitwiseXOR(F.col("s1")).alias("p1"), n[1].bitwiseXOR(F.col("s2")).alias("p2"),
    ))


def _nodes(paths: DataFrame) -> DataFrame:
    """The distinct prefixes: owner, members and what they bring; a digest of two prefixes raises."""
    same = F.xxhash64("k1", "k2", "p1", "p2", "depth", "bytes")
    found = paths.withColumn("same", same).groupBy("n1", "n2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("longest"), F.min("same").alias("low"),
        F.max("same").alias("high"), *(F.min(c).alias(c) for c in ("p1", "p2", "depth", "bytes")),
    )
    depth = F.when(F.col("low") == F.col("high"), F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes share a digest")))
    return materialize(found.select(
        "n1", "n2", "p1", "p2", "conv_id", depth.alias("depth"), "n_convs", (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    ))


def _carried(owned: DataFrame, paths: DataFrame, span: int) -> DataFrame:
    """What a path's owned nodes below a part bring, as rows at the part's last node; short paths have none."""
    part = F.floor((F.col("depth") - 1) / span)
    totals = owned.groupBy("conv_id", part.alias("part")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    parts = totals.groupBy("conv_id").agg(F.max("part").alias("last")).where("last > 0").select(
        "conv_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("part"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.join(totals, ["conv_id", "part"], "left").select(
        "conv_id", ((F.col("part") + 1) * span).alias("depth"), F.sum("leaf").over(below).alias("leaf"), F.sum("saved").over(below).alias("saved"))
    return sums.where("leaf IS NOT NULL").join(paths.select("conv_id", "depth", "n1", "n2", "p1", "p2"), ["conv_id", "depth"])


def shard_sums(rows: dict[str, np.ndarray], span: int) -> dict[str, np.ndarray]:
    """One shard: slots for all digests, then sums through the parent slots from the deepest nodes up."""
    unsigned = {c: rows[c].view(np.uint64) for c in ("n1", "n2", "p1", "p2")}
    high, low = np.concatenate([unsigned["n1"], unsigned["p1"]]), np.concatenate([unsigned["n2"], unsigned["p2"]])
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    table = SlotTable(high[first], low[first])
    n = len(table.high)
    node, above = table.slots(unsigned["n1"], unsigned["n2"]), table.slots(unsigned["p1"], unsigned["p2"])
    parent, depth = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    depth[above], depth[node] = rows["depth"] - 1, rows["depth"]
    linked = (rows["depth"] == 1) | ((rows["depth"] - 1) % span != 0)  # a part's first node hands nothing on
    parent[node[linked]] = above[linked]
    children, leaves, saved = (np.zeros(n, np.int64) for _ in range(3))
    np.add.at(children, above, rows["owned"])
    np.add.at(leaves, node, rows["leaf"])
    np.add.at(saved, node, rows["saved"])
    by_depth = np.argsort(-depth, kind="stable")
    for slots in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        slots = slots[parent[slots] >= 0]
        np.add.at(leaves, parent[slots], leaves[slots])
        np.add.at(saved, parent[slots], saved[slots])
    some = (children != 0) | (leaves != 0) | (saved != 0)
    return {
        "n1": table.high[some].view(np.int64), "n2": table.low[some].view(np.int64),
        "children": children[some], "leaves": leaves[some], "saved": saved[some],
    }


def _sum_shards(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            yield pa.RecordBatch.from_pydict(shard_sums({c: table[c].to_numpy() for c in table.column_names}, span))

    return run


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of conversations that end at one node: their ids, joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n1, n2, ids = (batch.column(i).to_numpy() for i in range(3))
        at = np.concatenate(([0], np.flatnonzero((n1[1:] != n1[:-1]) | (n2[1:] != n2[:-1])) + 1, [len(ids)]))
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_pydict({"n1": n1[at[:-1]], "n2": n2[at[:-1]], "first": ids[at[:-1]], "ids": texts})


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's runs, which come in order; only the open node's state is held."""
    node, state = None, None

    def done(nodes, digests):
        return pa.RecordBatch.from_pydict({
            "n1": pa.array([a for a, _ in nodes], pa.int64()), "n2": pa.array([b for _, b in nodes], pa.int64()), "ends": pa.array(digests, pa.string()),
        })

    for batch in batches:
        nodes, digests = [], []
        for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if (a, b) == node:
                state.update(b",")
            else:
                if node is not None:
                    nodes.append(node), digests.append(state.hexdigest())
                node, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        if nodes:
            yield done(nodes, digests)
    if node is not None:
        yield done([node], [state.hexdigest()])


def ends_of(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """(n1, n2, ends): the digest of the conversations that end at a node, in order of their ids."""
    ends = paths.where("depth = length").select("n1", "n2", "conv_id").unionByName(
        lengths.where("length = 0").select(F.lit(0).cast("bigint").alias("n1"), F.lit(0).cast("bigint").alias("n2"), "conv_id"))
    ordered = ends.repartitionByRange("n1", "n2", "conv_id").sortWithinPartitions("n1", "n2", "conv_id")
    runs = ordered.mapInArrow(_join_ids, "n1 bigint, n2 bigint, first bigint, ids string")
    return runs.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first").mapInArrow(_hash_ids, "n1 bigint, n2 bigint, ends string")


def build(turns: DataFrame, lengths: DataFrame, span: int = SPAN, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie over ``turns`` (conv_id, depth from 1, length, k1, k2, bytes); ``lengths`` names all conversations.

    A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    ship_package(spark)
    paths = paths_of(turns)
    nodes = _nodes(paths)
    zero = F.lit(0).cast("bigint")
    place = ["conv_id", "depth", "n1", "n2", "p1", "p2"]
    owned = nodes.select(*place, "leaf", "saved")
    tops = owned.groupBy("conv_id").agg(F.min("depth").alias("top"))
    borrowed = paths.join(tops, "conv_id").where("depth < top").select(*place, zero.alias("leaf"), zero.alias("saved"))
    rows = owned.withColumn("owned", F.lit(1).cast("bigint")).unionByName(
        borrowed.unionByName(_carried(owned, paths, span).select(*place, "leaf", "saved")).withColumn("owned", zero))
    shards = max(spark.sparkContext.defaultParallelism, math.ceil(paths.count() / shard_rows))
    sums = rows.withColumn("part", F.floor((F.col("depth") - 1) / span)).repartition(shards, "conv_id", "part").drop("conv_id", "part").mapInArrow(
        _sum_shards(span), "n1 bigint, n2 bigint, children bigint, leaves bigint, saved bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("n1"), zero.alias("n2"), "conv_id", zero.alias("depth"), "n_convs")
    known = nodes.select("n1", "n2", "p1", "p2", "conv_id", "depth", "n_convs").unionByName(root, allowMissingColumns=True)
    parts = known.unionByName(sums, allowMissingColumns=True).unionByName(ends_of(paths, lengths), allowMissingColumns=True)
    table = materialize(parts.groupBy("n1", "n2").agg(
        *(F.max(c).alias(c) for c in ("p1", "p2", "conv_id", "depth", "n_convs")),
        *(F.coalesce(F.sum(c), zero).alias(c) for c in ("children", "leaves", "saved")), F.max("ends").alias("ends"),
    ))
    parents = table.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return table.join(parents, ["p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.when(F.col("children") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, group: int = GROUP, most: int = MOST, **options) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), rebuilt as ``rebuild`` says."""
    return build(*rebuild(number_turns(conversations), group, most), **options)
