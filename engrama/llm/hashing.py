"""Word and shingle hashes of many texts at once, as numpy passes over their bytes.

A text becomes UTF-8 bytes; A-Z are lower-cased; words are maximal runs of bytes
other than space and \\t \\n \\v \\f \\r.  A word's hash is a polynomial in random
byte values modulo 2**64, then mixed; a shingle's is a polynomial in its words'.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
_SHINGLE_STEP = np.uint64(0xA0761D6478BD642F)
CHUNK_BYTES = 1 << 20  # texts hashed together; a longer text is hashed alone


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (a 64-bit finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed random 64-bit values, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32) + np.uint64(1)) * _GOLDEN)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = random_words(256, 7)
_BYTE_VALUE[ord("A"):ord("Z") + 1] = _BYTE_VALUE[ord("a"):ord("z") + 1]
_BYTE_VALUE[_SPACE] = 0


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hash_chunk(encoded: Sequence[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    firsts = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    if not len(starts):
        return [np.empty(0, dtype=np.uint64) for _ in encoded]
    at = np.arange(len(data))
    begin = np.zeros(len(data), dtype=np.int64)
    begin[starts] = starts
    place = at - np.maximum.accumulate(begin)
    place[space] = 0
    values = _BYTE_VALUE[data] * _powers(int(place.max()) + 1, _WORD_STEP)[place]
    words = mix(np.add.reduceat(values, starts))
    return np.split(words, np.searchsorted(starts, firsts[1:-1]))


def chunks_of(texts: Sequence[str | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        e = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(e) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(e)
        size += len(e)
    if held:
        yield held


def word_hashes(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order; null is empty."""
    for chunk in chunks_of(texts):
        with np.errstate(over="ignore"):
            hashed = _hash_chunk(chunk)
        yield from hashed


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, no words are none."""
    if not len(words):
        return words
    n = min(width, len(words))
    with np.errstate(over="ignore"):
        steps = _powers(n, _SHINGLE_STEP)
        count = len(words) - n + 1
        total = np.full(count, np.uint64(n) * _GOLDEN, dtype=np.uint64)
        for j in range(n):
            total += words[j:j + count] * steps[j]
        return np.unique(mix(total))
