"""Language identification with hyperdimensional letter profiles.

Every letter has a fixed random vector of +1 and -1.  An n-gram of three letters is
bound into one vector: the first letter's permuted twice, times the second's permuted
once, times the third's.  A text bundles (adds) the vectors of all its trigrams; a run
of other characters counts as one separating letter.  A language's prototype bundles
the unit vectors of its training texts, and a text is given the language whose
prototype has the largest cosine.

Prototypes are summed per task, then per language and dimension on the cluster; only
languages x ``DIMENSIONS`` numbers reach the driver and are broadcast.

Results for odd input: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if nothing could be learned; ties go to the smaller name; rows
with null id or lang are predicted like others, and one without an id or with a null
lang isn't learned from; repeated rows count each.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import crc32_text, map_arrow, text_batches
from engrama.llm.hashing import random_words

DIMENSIONS = 1024
UNKNOWN = "und"
LEAST_COSINE = 0.1    # below it a text is rejected as no known language
FULL_CHARS = 200      # shorter texts need a share of it only, in proportion
BUNDLE_CHARS = 1 << 19
SLICE = 8192  # trigrams bound at once
PIECE_CHARS = 1 << 22  # a longer text is bundled in pieces


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code point to letter; 0 for all others."""
    table = np.zeros(0x110000, dtype=np.int32)
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] == "L":
            table[code] = code
    return table


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 per letter, from its code point alone."""
    words = np.stack([random_words(DIMENSIONS // 64, 1000 + int(x)) for x in letters])
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _letters(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _letter_table()[codes]
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    return letters[keep]


def _bundle_group(texts: Sequence[np.ndarray]) -> np.ndarray:
    known, spelled = np.unique(np.concatenate(texts), return_inverse=True)
    n = len(known)
    bounds = np.cumsum([0, *map(len, texts)])
    grams = [
        (s[:-2] * n + s[1:-1]) * n + s[2:]
        for s in (spelled[a:b].astype(np.int64) for a, b in zip(bounds[:-1], bounds[1:]))
    ]
    present = np.unique(np.concatenate(grams)) if n > 200 else np.flatnonzero(np.bincount(np.concatenate(grams), minlength=n**3))
    vectors = letter_vectors(known)
    held = []  # of each text: places of its trigrams among those present, and how often each
    for g in grams:
        if n > 200:
            held.append(np.unique(np.searchsorted(present, g), return_counts=True))
        else:
            often = np.bincount(g, minlength=n**3)[present]
            held.append((np.flatnonzero(often), often[often > 0]))
    out = np.zeros((len(texts), vectors.shape[1]), dtype=np.float32)
    for low in range(0, len(present), SLICE):  # so that memory is bounded however many trigrams there are
        part = present[low:low + SLICE]
        first, second, third = part // (n * n), part // n % n, part % n
        bound = np.roll(vectors[first], 2, axis=1) * np.roll(vectors[second], 1, axis=1) * vectors[third]
        counts = np.zeros((len(texts), len(part)), dtype=np.float32)
        for row, (places, often) in zip(counts, held):
            begin, end = np.searchsorted(places, [low, low + SLICE])
            row[places[begin:end] - low] = often[begin:end]
        out += counts @ bound
    return out


def bundles(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(position, vector) of each text with a letter; short texts are padded by the separator."""
    held: list[np.ndarray] = []
    at: list[int] = []

    def flush():
        if held:
            sums: dict[int, np.ndarray] = {}
            for i, v in zip(at, _bundle_group(held)):
                sums[i] = sums[i] + v if i in sums else v
            yield from sums.items()
        held.clear(), at.clear()

    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        letters = _letters(text)
        if not letters.any():
            continue
        letters = np.pad(letters, (int(letters[0] != 0), int(letters[-1] != 0)))  # begins and ends with the separator
        if size + len(letters) > BUNDLE_CHARS:
            yield from flush()
            size = 0
        for cut in range(0, len(letters) - 2, PIECE_CHARS):
            held.append(letters[cut:cut + PIECE_CHARS + 2]), at.append(i)
        size += len(letters)
    yield from flush()


def training_rows(doc_id: Column) -> Column:
    """Documents that may be learned from; the others are held out."""
    return F.pmod(crc32_text(doc_id), F.lit(4)) != 2


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for i, vector in bundles(batch.column(0).to_pylist()):
            norm = np.linalg.norm(vector)
            if norm:
                sums.setdefault(langs[i], np.zeros(DIMENSIONS))
                sums[langs[i]] += vector / norm
    if sums:
        yield pa.RecordBatch.from_pydict({"lang": list(sums), "vector": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and unit prototypes of the languages in (text, lang)."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    parts = text_batches(rows).mapInArrow(_summed, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect()
    names = [r.lang for r in found]
    table = np.array([[x["x"] for x in r.v] for r in found]).reshape(len(names), DIMENSIONS)
    return names, table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)


def _predict(model):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, table = model.value
        langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
        if names:
            for i, vector in bundles(batch.column(1).to_pylist()):
                norm = np.linalg.norm(vector)
                cosines = table @ vector / norm if norm else np.zeros(len(names))
                best = int(np.argmax(cosines))
                langs[i], scores[i] = names[best], float(min(1.0, max(0.0, cosines[best])))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: str = "doc_id") -> DataFrame:
    """(``keep``, lang_pred, score) per row."""
    kind = docs.schema[keep].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs.select(F.col(keep).alias("doc_id"), F.col("text").cast("string").alias("text")), _predict(sent), f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those not held out."""
    train = docs.where(training_rows(F.col("doc_id")))
    found = predict(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), prototypes(train))
    return found.select("doc_id", F.coalesce(~training_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def _judge(model):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        result = _predict(model)(batch.select(["text", "text"]))
        rows = zip(result.column(1).to_pylist(), result.column(2).to_pylist(), batch.column("text").to_pylist())
        ok = [lang != UNKNOWN and score >= LEAST_COSINE * min(1, len(text) / FULL_CHARS) for lang, score, text in rows]
        return batch.filter(pa.array(ok))

    return run


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """The documents in some known language: others have no letter or no prototype near them.

    If no row has a lang, nothing can be learned and only texts without a letter go.
    """
    model = prototypes(docs.where(training_rows(F.col("doc_id"))))
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return map_arrow(docs, _judge(docs.sparkSession.sparkContext.broadcast(model)), docs.schema)
