"""Benchmark decontamination: spaced seeds find substitution-tolerant overlaps with test items.

A text is its words (as in ``hashing``).  A mask selects six of the words at a
position and ignores those between, so a hash under a mask still agrees where words
between have been replaced.  Two masks together hit every placing of three
substitutions in 16 words (a test tries them all), and shorter items are given as
many substitutions as the masks prove to bear.

Test and training hashes are joined: items' seeds are made on Spark, a bitmap of
bounded size over them turns away almost all seeds of the documents, and those left
are joined with the items' by hash.  Each text and item that share a hash then meet in
a group of one text and at most ``GROUP_ITEMS`` items.  There, on each diagonal that a
seed lies on, the item is laid over the document and equal words are counted.  A
document is contaminated by an item if some window of ``WINDOW`` words (the whole
item, if shorter) agrees but for the tolerated substitutions.

Equal texts are compared once.  Item seeds are broadcast to the join if their measured
size fits; else both sides are shuffled, each hash over ``SALTS`` keys.  Documents
themselves are shuffled only where they share a hash with an item.

Results for odd input: null or empty texts and items match nothing; an item below
``LEAST_WORDS`` words can't be told from chance and matches nothing; a shorter item
than a mask must occur as it is; rows of one doc_id share one result, found over all
their texts; rows with a null id share one as well; rows of one item_id are one item
with several texts.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import BROADCAST_BYTES, map_arrow, sized, text_batches
from engrama.llm.hashing import mix, random_words, word_hashes
from engrama.session import materialize

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 8, 9, 10))
SHORT_MASK = (0, 1, 2, 3, 4)  # for items that no mask fits
WINDOW = 16
MISMATCHES = 3                # of WINDOW words; in proportion, rounded down, in shorter items
LEAST_WORDS = 5
SEED_BITS = 64                # of the bitmap for each seed of the benchmark, within the next two
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # a larger benchmark's bitmap turns fewer away; the join does the rest
SALTS = 16
GROUP_ITEMS = 256             # compared with one text in one group
CELLS = 1 << 20               # words compared at once

_STEPS = random_words(16, 31) | np.uint64(1)

@lru_cache(maxsize=None)
def tolerance(length: int) -> int:
    """Substitutions in ``length`` words that the masks are sure to bear, up to the share asked for."""
    if length >= WINDOW:
        return MISMATCHES
    for k in range(MISMATCHES * length // WINDOW, 0, -1):
        if all(
            any(all(s + i not in bad for i in mask) for mask in MASKS for s in range(length - mask[-1]))
            for bad in map(frozenset, itertools.combinations(range(length), k))
        ):
            return k
    return 0


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash under a mask at each position where it fits."""
    count = len(words) - mask[-1]
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(count, np.uint64(len(mask) * 131 + mask[-1]))
    for step, i in zip(_STEPS, mask):
        total += words[i:i + count] * step
    return mix(total)


def item_seeds(words: np.ndarray) -> dict[tuple[int, ...], np.ndarray]:
    """An item's seeds by mask; none for an item too short to be told from chance."""
    if len(words) < LEAST_WORDS:
        return {}
    return {m: seeds(words, m) for m in [m for m in MASKS if m[-1] < len(words)] or [SHORT_MASK]}


def shifts(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Diagonals (place in the text less place in the item) on which both have the same seed, ascending.

    They are marked in one array, so a phrase repeated in both costs no memory for its pairs.
    """
    marks = np.zeros(len(words) + len(item), dtype=bool)
    for mask, mine in item_seeds(item).items():
        theirs = seeds(words, mask)
        spots = np.flatnonzero(np.isin(theirs, mine))
        order = spots[np.argsort(theirs[spots], kind="stable")]
        keys = theirs[order]
        low, high = np.searchsorted(keys, mine, side="left"), np.searchsorted(keys, mine, side="right")
        for at in np.flatnonzero(high > low).tolist():
            marks[order[low[at]:high[at]] - at + len(item)] = True
    return np.flatnonzero(marks) - len(item)


def overlap(words: np.ndarray, item: np.ndarray) -> int:
    """The most words that agree on one diagonal with a window close enough to the item; 0 without one."""
    size, best = min(len(item), WINDOW), 0
    found = shifts(words, item)
    places = np.arange(len(item))
    step = max(1, CELLS // max(1, len(item)))
    for a in range(0, len(found), step):
        shift = found[a:a + step, None]
        at = places + shift
        inside = (at >= 0) & (at < len(words))
        same = inside & (words[np.where(inside, at, 0)] == item)
        total = np.concatenate((np.zeros((len(shift), 1), dtype=np.int64), np.cumsum(same, axis=1)), axis=1)
        whole = inside[:, :len(item) - size + 1] & inside[:, size - 1:]  # windows that lie in the text
        close = (whole & (total[:, size:] - total[:, :-size] >= size - tolerance(size))).any(axis=1)
        best = max(best, int(total[close, -1].max(initial=0)))
    return best


def _make_seeds(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(item, seed, short): an item's distinct seeds."""
    items, found, short = [], [], []
    with np.errstate(over="ignore"):
        for item, words in zip(batch.column(0).to_pylist(), word_hashes(batch.column(1).to_pylist())):
            for mask, mine in item_seeds(words).items():
                mine = np.unique(mine)
                items.append(np.full(len(mine), item)), found.append(mine.view(np.int64)), short.append(np.full(len(mine), mask == SHORT_MASK))
    columns = [np.concatenate([np.empty(0, t), *x]) for t, x in ((np.int64, items), (np.int64, found), (bool, short))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "seed", "short"])


def _pass_bitmap(bitmap, masks):
    """(k1, k2, seed): the distinct seeds of each text that the bitmap doesn't turn away."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = bitmap.value
        top = np.uint64(len(held) * 8 - 1)
        k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
        rows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        with np.errstate(over="ignore"):
            for row, words in enumerate(word_hashes(batch.column(2).to_pylist())):
                for mask in masks:
                    mine = seeds(words, mask)
                    bit = mine & top
                    mine = np.unique(mine[(held[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0])
                    rows.append(np.full(len(mine), row)), found.append(mine.view(np.int64))
        at = np.concatenate(rows)
        return pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array(np.concatenate(found))], ["k1", "k2", "seed"])

    return run


def _bitmap(made: DataFrame, rows: int) -> np.ndarray:
    """Bits of the low ends of all seeds, eight to a byte, low bit first; at most ``MOST_BITS``."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, rows * SEED_BITS):
        bits *= 2
    place = F.col("seed").bitwiseAND(F.lit(bits - 1)) + 1  # Spark counts bits from 1
    parts = made.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("part")
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in parts.collect():  # bits / 32,768 rows at most
        part = np.frombuffer(r.part, dtype=np.uint8)
        out[(r.bucket - 1) * len(part):r.bucket * len(part)] = part
    return out


def _verify(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """One text and some of the items it shares a hash with."""
    rows = {"k1": [], "k2": [], "item_id": [], "matched": [], "item_words": []}
    if left.num_rows and right.num_rows:
        with np.errstate(over="ignore"):
            words = next(word_hashes(left.column("text").to_pylist()))
            for item_id, item in zip(right.column("item_id").to_pylist(), word_hashes(right.column("item_text").to_pylist())):
                n = overlap(words, item)
                if n:
                    for name, value in zip(rows, (key[0].as_py(), key[1].as_py(), item_id, n, len(item))):
                        rows[name].append(value)
    return pa.table({name: pa.array(values, pa.int64()) for name, values in rows.items()})


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, item_words) of every contaminated pair."""
    text = F.col("text").cast("string")
    keys = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), "text").alias("k2")]  # equal texts have one key
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).where("text is not null").select("doc_id", "text", *keys)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text.alias("item_text")).where("item_text is not null")
    items = materialize(items.distinct().withColumn("item", F.monotonically_increasing_id()))
    item_bytes = items.agg(F.sum(F.octet_length("item_text").cast("bigint") + 24)).first()[0] or 0
    made = materialize(map_arrow(items.select("item", "item_text"), _make_seeds, "item bigint, seed bigint, short boolean"))
    size = made.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bool_or("short"), F.lit(False)).alias("short")).first()

    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(made, size.rows))
    masks = (*MASKS, SHORT_MASK) if size.short else MASKS
    passed = map_arrow(texts.select("k1", "k2", "text"), _pass_bitmap(sent, masks), "k1 bigint, k2 bigint, seed bigint")
    if size.rows * 24 <= BROADCAST_BYTES:
        shared = passed.join(F.broadcast(made), "seed")
    else:
        salted = made.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        shared = passed.distinct().withColumn("salt", F.pmod("k1", F.lit(SALTS)).cast("int")).join(salted, ["seed", "salt"])
    pairs = materialize(shared.select("k1", "k2", "item").distinct())

    # a text's items in groups of bounded size; the text goes once to each group
    found = pairs.groupBy("k1", "k2").agg(F.floor((F.count(F.lit(1)) - 1) / GROUP_ITEMS).cast("int").alias("last"))
    found = materialize(found)
    held = texts.join(sized(found.select("k1", "k2"), 24), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.any_value("text").alias("text"))
    held = held.join(found, ["k1", "k2"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
    asked = pairs.join(found, ["k1", "k2"]).withColumn("part", F.pmod(F.xxhash64("item"), F.col("last") + 1).cast("int")).drop("last")
    asked = asked.join(F.broadcast(items) if item_bytes <= BROADCAST_BYTES else items, "item").drop("item")
    group = ["k1", "k2", "part"]
    verified = text_batches(held).groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(
        _verify, "k1 bigint, k2 bigint, item_id bigint, matched bigint, item_words bigint"
    )
    verified = materialize(verified.groupBy("k1", "k2", "item_id").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words")))
    hit = texts.select("doc_id", "k1", "k2").join(sized(verified, 64), ["k1", "k2"])
    return materialize(hit.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, matched (most words that agree), items (ids, ascending)."""
    found = overlaps(docs, benchmark).groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("n_items"), F.max("matched").alias("matched"), F.sort_array(F.collect_list("item_id")).alias("items")
    )
    per_doc = materialize(found)
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(sized(per_doc, 96, "items", 8), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return out.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("matched", F.lit(0)).cast("bigint").alias("matched"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item."""
    gone = sized(materialize(overlaps(docs, benchmark).select(F.col("doc_id").alias("_id")).distinct()), 16)
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(gone["_id"]), "left_anti").select(*docs.columns)
