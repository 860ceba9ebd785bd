"""Near-duplicate documents: MinHash bands find candidates, odd sketches screen them, full sets confirm.

A document's set is its distinct five-word shingles (see ``hashing``).  Texts
with one and the same set form a class and are represented by their smallest id,
so copies never meet as pairs.  Each class has

* bands of five MinHash values, as many as the threshold needs (``bands_for``): two
  sets at the threshold share no band with probability (1 - t**5)**bands, below one
  in a million (25 bands at 0.85, 35 at 0.8);
* an odd sketch: the least shingle hash of each of ``BINS`` bins is one MinHash
  sample (one-permutation hashing), and each sample flips one bit of a bitmap.
  Bits differing between two bitmaps count the samples not shared, which tells
  high similarities apart closely.  Pairs five standard deviations below the
  threshold are dropped, all others are confirmed on their full sets.

Links are found in two rounds, so that a bucket of many near copies doesn't emit
all its pairs: first every member against its bucket's smallest id, then only
pairs of different components found so far, screened inside the join and emitted
in the first band they share.  Both rounds cover every bucket; none is capped.

Results for odd input: a null or blank text has an empty set and links with
nothing; a row with a null id is kept, with a null component; repeated rows of
one id and set count once; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import connected_components, map_arrow, released, sized, text_batches, unused
from engrama.llm.hashing import mix, random_words, shingle_set, word_hashes
from engrama.operators.numbering import dense_number
from engrama.session import join_null_safe, materialize

BANDS, BAND_ROWS = 25, 5  # bands at least
MISS = 1e-6          # probability that two sets at the threshold share no band, at most
BINS = 1024          # one-permutation MinHash samples of an odd sketch
SKETCH_BITS = 1024
SCREEN_SIGMAS = 5.0
THRESHOLD = 85       # percent, of near_duplicates
FIRST_ROUNDS = 2     # of components between the two rounds of links

_FACTORS = random_words(BAND_ROWS, 22) | np.uint64(1)
_PLACES = random_words(BINS, 23)


def bands_for(threshold: int) -> int:
    """The fewest bands, ``BANDS`` at least, that miss a pair at the threshold with a probability below ``MISS``."""
    together = (threshold / 100) ** BAND_ROWS
    return max(BANDS, math.ceil(math.log(MISS) / math.log1p(-together))) if together < 1 else BANDS


@lru_cache(maxsize=4)
def hash_functions(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and factors; those of fewer bands are the first of more."""
    return random_words(bands * BAND_ROWS, 21), random_words(bands * BAND_ROWS, 22) | np.uint64(1)


def min_hashes(shingles: np.ndarray, bands: int) -> np.ndarray:
    """The smallest value of each hash function over a set, in slices that stay in cache."""
    seeds, factors = hash_functions(bands)
    least = np.full(len(seeds), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 512):
        np.minimum(least, ((shingles[at:at + 512, None] ^ seeds) * factors).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    return mix((least.reshape(-1, BAND_ROWS) * _FACTORS).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> tuple[np.ndarray, int]:
    """Parity bitmap of the bins' smallest hashes, and how many bins hold any."""
    backwards = mix(shingles[::-1])
    order = np.argsort(backwards)[::-1]
    values = backwards[order]  # largest first, so the smallest of a bin is written last
    bins = (values & np.uint64(BINS - 1)).astype(np.int64)
    samples = np.zeros(BINS, dtype=np.uint64)
    samples[bins] = values
    used = np.flatnonzero(np.bincount(bins, minlength=BINS))
    spots = mix(samples[used] ^ _PLACES[used]) >> np.uint64(64 - int(math.log2(SKETCH_BITS)))
    parity = np.bincount(spots.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64), len(used)


def _lists(rows: list[np.ndarray], width: int) -> pa.Array:
    flat = np.concatenate([r if r is not None else np.empty(0, np.int64) for r in rows] or [np.empty(0, np.int64)])
    offsets = np.concatenate(([0], np.cumsum([0 if r is None else width for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sign(n_bands: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ones, twos, bands, sketches, used = [], [], [], [], [], []
        with np.errstate(over="ignore"):
            for words in word_hashes(batch.column(1).to_pylist()):
                shingles = shingle_set(words)
                sizes.append(len(shingles))
                ones.append(int(shingles.sum(dtype=np.uint64).view(np.int64)))
                twos.append(int(mix(shingles * _FACTORS[0]).sum(dtype=np.uint64).view(np.int64)))
                if not len(shingles):
                    bands.append(None), sketches.append(None), used.append(0)
                    continue
                bands.append(band_keys(min_hashes(shingles, n_bands)))
                sketch, n = odd_sketch(shingles)
                sketches.append(sketch), used.append(n)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
             _lists(bands, n_bands), _lists(sketches, SKETCH_BITS // 64), pa.array(used, pa.int32())],
            ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch", "bins"],
        )

    return run


def signatures(docs: DataFrame, bands: int) -> DataFrame:
    """One row per id and set: its size, digest, band keys and odd sketch."""
    signed = map_arrow(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), _sign(bands),
        "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>, bins int",
    )
    return signed


def _close(a: str, b: str, threshold: int) -> Column:
    """Whether two sketches leave room for the threshold, within ``SCREEN_SIGMAS`` of the estimate."""
    t = threshold / 100
    differing = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    bits = float(SKETCH_BITS)
    room = F.greatest(1 - 2 * differing / bits, F.lit(1e-3))
    unshared = -bits / 2 * F.log(room)                                       # samples in just one of the two
    shared = (F.col(f"{a}.bins") + F.col(f"{b}.bins") - unshared) / 2
    union = (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")) / (1 + t)  # of sets just at the threshold
    bins = BINS * (1 - F.exp(-union / BINS))
    sampling = bins * t * (1 - t) * (1 - bins / union)
    expected = F.col(f"{a}.bins") + F.col(f"{b}.bins") - 2 * t * bins
    spread = F.greatest(bits / 4 * (1 - F.exp(-4 * expected / bits)) - expected * F.exp(-4 * expected / bits), F.lit(1.0))
    noise = spread / F.exp(-4 * expected / bits) / 4
    # sets of very unlike sizes can't reach the threshold at all
    sizes = F.least(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")) >= t * F.greatest(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    return sizes & (shared >= t * bins - SCREEN_SIGMAS * F.sqrt(sampling + noise) - 1)


def _confirm(threshold: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, held, last = [], None, None
        left, right = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        others = word_hashes(right)
        for i, words in enumerate(others):
            if held is None or left[i] != last:
                last, held = left[i], shingle_set(next(word_hashes([left[i]])))
            mine = shingle_set(words)
            inter = len(np.intersect1d(held, mine, assume_unique=True))
            if inter and 100 * inter >= threshold * (len(held) + len(mine) - inter):
                kept.append(i)
        picked = batch.take(pa.array(kept, pa.int64()))
        return pa.RecordBatch.from_arrays([picked.column(1), picked.column(3)], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    joined = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return map_arrow(joined.select("text_a", "a", "text_b", "b"), _confirm(threshold), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked id), kept (the one that stays), class_id (smallest id with the same set)."""
    signed = released(signatures(docs, bands_for(threshold)).dropDuplicates(["doc_id", "n_shingles", "d1", "d2"]))
    keys = ["n_shingles", "d1", "d2"]
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy(*keys).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("bins").alias("bins")
    )
    classes = released(classes)

    rows = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = released(rows.join(buckets, ["band", "key"]))
    met = sized(materialize(members.select(F.col("rep").alias("doc_id")).distinct()), 16)
    texts = materialize(text_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                        .join(met, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    sketched = classes.select("rep", "n_shingles", "sketch", "bins", "bands")

    def side(name: str) -> DataFrame:
        return sketched.select(F.col("rep").alias(name), F.struct("n_shingles", "sketch", "bins").alias(f"of_{name}"))

    stars = members.where("center < rep").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b").where(_close("of_a", "of_b", threshold)).select("a", "b")
    first = released(confirmed(stars, texts, threshold))
    found = connected_components(first, FIRST_ROUNDS)  # enough to leave out most pairs; the end result is exact

    placed = members.join(found, members.rep == found.id, "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_rows = placed.join(mixed.select("band", "key"), ["band", "key"]).join(
        sketched.select("rep", F.struct("n_shingles", "sketch", "bins", "bands").alias("of")), "rep"
    )
    left = open_rows.select("band", "key", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("of").alias("of_a"))
    right = open_rows.select("band", "key", F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("of").alias("of_b"))
    earlier = F.exists(F.sequence(F.lit(0), F.col("band") - 1), lambda i: F.col("of_a.bands")[i] == F.col("of_b.bands")[i])
    again = F.when(F.col("band") > 0, earlier).otherwise(False)
    pairs = left.join(right, ["band", "key"]).where((F.col("ca") < F.col("cb")) & _close("of_a", "of_b", threshold) & ~again)
    links = first.unionByName(confirmed(pairs.select("a", "b"), texts, threshold))
    links = released(links)
    component = connected_components(links)

    reps = classes.select(*keys, "rep").join(component, F.col("rep") == component.id, "left")
    reps = reps.select(*keys, F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", *keys).join(reps, keys, "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def _without_copies(docs: DataFrame, id_column: str, threshold: int) -> DataFrame:
    gone = materialize(near_duplicates(docs.select(F.col(id_column).alias("doc_id"), "text"), threshold).where("not kept").select("doc_id").distinct())
    key = unused("_gone", docs.columns)
    return docs.join(sized(gone.withColumnRenamed("doc_id", key), 16), docs[id_column] == F.col(key), "left_anti")


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents without all but one of each group of near copies; texts without a word all stay.

    Where ids repeat or are null, a row counts by its id and text: of equal rows one stays,
    and of a group the row with the smallest id, null last.
    """
    counted = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if counted["rows"] == counted["ids"]:
        return _without_copies(docs, "doc_id", threshold).select(*docs.columns)
    names = {n: unused(n, docs.columns) for n in ("key", "digest", "no_id", "id", "wordless")}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({
        names["digest"]: F.sha2(text, 256), names["no_id"]: F.col("doc_id").isNull(), names["id"]: F.col("doc_id").cast("bigint"),
        names["wordless"]: ~text.rlike(r"[^\x20\x09-\x0D]"),
    })
    order = [names[n] for n in ("no_id", "id", "digest")]
    worded = marked.where(~F.col(names["wordless"]))
    keys = dense_number(worded.select(*order).distinct(), order, name=names["key"])
    numbered = join_null_safe(worded, keys, order).dropDuplicates([names["key"]])
    kept = _without_copies(numbered, names["key"], threshold).select(*docs.columns)
    return kept.unionByName(marked.where(F.col(names["wordless"])).select(*docs.columns))
