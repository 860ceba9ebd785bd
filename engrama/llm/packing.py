"""Packing of token sequences by bin completion, branch and bound over length classes.

Documents become pieces of at most ``CAPACITY`` tokens.  Pieces of one length are
alike, so the problem is fully told by how many there are of each length: at most
``CAPACITY`` numbers, whatever the size of the corpus.  The driver solves that:

* a bin is completed around the largest piece left: fillings of its remaining
  room are enumerated, largest pieces first, and fillings dominated by another
  (whose pieces fit into the other's) are left out;
* a chosen filling is repeated as long as its pieces last, or used once, so a
  solution is a short list of patterns with counts;
* best-fit decreasing gives the first incumbent, so no result has more bins than it;
  a branch is cut once its waste exceeds what any solution with one bin less than
  the incumbent could have;
* the search ends when the incumbent meets the lower bound, or after ``NODES``
  branches (packing is NP-hard), with the best solution so far.

Pieces are then numbered within their length on the cluster and look their place
up in the pattern list, which is broadcast and bounded as the histogram is.

Results for odd input: a null or empty text is one piece, the end id; rows with a
null id are packed like all others; repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import map_arrow, text_batches
from engrama.llm.tokens import END_ID, encoder, vocabulary_path
from engrama.operators.numbering import dense_number
from engrama.session import materialize

CAPACITY = 2048
FILLINGS = 12   # fillings tried at one branch, best first
SEEN = 400      # steps spent on enumerating them
NODES = 3000    # branches tried before the incumbent is taken
_END = np.asarray([END_ID], dtype="<u4").tobytes()

Pattern = tuple[tuple[int, int], ...]  # (length, how many of it in one bin), longest first


def lower_bound(counts: Mapping[int, int], capacity: int) -> int:
    """No packing has fewer bins: total size, and pieces over half that can't share, at every cut-off."""
    n = np.zeros(capacity + 1, dtype=object)
    for length, count in counts.items():
        n[length] += count
    best = -(-sum(length * count for length, count in counts.items()) // capacity)
    size = n * np.arange(capacity + 1)
    half = capacity // 2
    for cut in range(1, half + 1):
        alone = sum(n[capacity - cut + 1:])
        large, large_size = sum(n[half + 1:capacity - cut + 1]), sum(size[half + 1:capacity - cut + 1])
        small = sum(size[cut:half + 1])
        over = small - (large * capacity - large_size)
        best = max(best, alone + large + (-(-over // capacity) if over > 0 else 0))
    return int(best)


def _fits(inner: tuple[int, ...], outer: tuple[int, ...]) -> bool:
    """Whether the pieces ``inner`` fit into rooms the size of ``outer``: first fit, longest first."""
    rooms = list(outer)
    for piece in inner:
        for i, room in enumerate(rooms):
            if piece <= room:
                rooms[i] -= piece
                break
        else:
            return False
    return True


def fillings(room: int, lengths: list[int], left: Mapping[int, int], smallest: int) -> Iterator[tuple[int, ...]]:
    """Maximal sets of remaining pieces that fit into ``room``, in descending lexicographic order."""
    at = int(np.searchsorted(np.asarray(lengths), room, side="right")) - 1
    stack: list[tuple[int, int, tuple[int, ...]]] = [(at, room, ())]
    while stack:
        i, space, chosen = stack.pop()
        while i >= 0 and (lengths[i] > space or left[lengths[i]] <= chosen.count(lengths[i])):
            i -= 1
        if i < 0 or space < smallest:
            if not any(x <= space and left[x] > chosen.count(x) for x in lengths[:1]):
                yield chosen
            continue
        stack.append((i - 1, space, chosen))                               # without this length
        stack.append((i, space - lengths[i], (*chosen, lengths[i])))       # with one more of it


def completions(largest: int, left: Mapping[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Undominated fillings around the largest piece, least waste first, then fewest pieces."""
    lengths = sorted(x for x, n in left.items() if n > 0)
    room = capacity - largest
    found: list[tuple[int, ...]] = []
    for filling in islice(fillings(room, lengths, left, lengths[0] if lengths else capacity + 1), SEEN):
        found.append(filling)
        if sum(filling) == room and len(found) >= FILLINGS:
            break
    found.sort(key=lambda f: (-sum(f), len(f)))
    kept: list[tuple[int, ...]] = []
    for filling in found:
        if not any(_fits(filling, other) for other in kept):
            kept.append(filling)
        if len(kept) == FILLINGS:
            break
    return kept or [()]


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, bins of one filling taken together.

    The pieces of a length go where they leave the least room.  A bin that takes one has
    less room than its like, so it takes as many as fit before the next bin gets any.
    """
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left: fillings and how many bins have each
    order: list[int] = []                                     # rooms that bins have, ascending

    def put(filling: tuple[int, ...], room: int, bins: int) -> None:
        if bins:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((filling, bins))

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left = counts[length]
        at = bisect_left(order, length)
        while left and at < len(order):
            room = order[at]
            per_bin, groups = room // length, rooms.pop(room)
            del order[at]
            kept = []
            for filling, bins in groups:
                full = min(bins, left // per_bin)
                rest = left - full * per_bin if bins > full and left - full * per_bin < per_bin else 0
                put((*filling, *[length] * per_bin), room - per_bin * length, full)
                put((*filling, *[length] * rest), room - rest * length, 1 if rest else 0)
                left -= full * per_bin + rest
                untouched = bins - full - bool(rest)
                if untouched:
                    kept.append((filling, untouched))
            for filling, bins in kept:
                put(filling, room, bins)
            at = bisect_right(order, room)
        per_bin = capacity // length
        put((length,) * per_bin, capacity - per_bin * length, left // per_bin)
        put((length,) * (left % per_bin), capacity - left % per_bin * length, 1 if left % per_bin else 0)
    return [(tuple(sorted(Counter(f).items(), reverse=True)), bins) for groups in rooms.values() for f, bins in groups]


def _step(left: dict[int, int], largest: int, filling: tuple[int, ...], most: int | None = None) -> tuple[Pattern, int, dict[int, int]]:
    need: dict[int, int] = {}
    for x in (largest, *filling):
        need[x] = need.get(x, 0) + 1
    times = min([left[x] // n for x, n in need.items()] + ([most] if most else []))
    rest = dict(left)
    for x, n in need.items():
        rest[x] -= n * times
        if not rest[x]:
            del rest[x]
    return tuple(sorted(need.items(), reverse=True)), times, rest


def _choices(left: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int | None]]:
    """Fillings around the largest piece: each as often as its pieces last, then each used once."""
    top = max(left)
    found = completions(top, {**left, top: left[top] - 1}, capacity)
    once = [(f, 1) for f in found if _step(dict(left), top, f)[1] > 1]
    return [(f, None) for f in found] + once


def complete_bins(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many bins have each, using every piece once."""
    start = {length: count for length, count in counts.items() if count}
    if not start:
        return []
    total, bound = sum(x * n for x, n in start.items()), lower_bound(start, capacity)
    best = best_fit(start, capacity)
    best_bins, nodes = sum(times for _, times in best), 0
    if best_bins == bound:
        return best
    path: list[tuple[Pattern, int]] = []
    # each level: pieces left, bins so far, waste so far, choices not tried yet
    levels = [(start, 0, 0, _choices(start, capacity))]
    while levels:
        left, bins, waste, options = levels[-1]
        if not options or nodes >= NODES:
            levels.pop()
            if path:
                path.pop()
            continue
        filling, most = options.pop(0)
        nodes += 1
        largest = max(left)
        pattern, times, rest = _step(left, largest, filling, most)
        bins, waste = bins + times, waste + times * (capacity - largest - sum(filling))
        if waste > (best_bins - 1) * capacity - total:
            continue
        path.append((pattern, times))
        if not rest:
            if bins < best_bins:
                best, best_bins = list(path), bins
                if bins == bound:
                    break
            path.pop()
            continue
        levels.append((rest, bins, waste, _choices(rest, capacity)))
    return best


def slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For each length and run of pattern bins: which numbers of that length go there, and where in the bin."""
    rows, used, first = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, count in pattern:
            begin = used.get(length, 0)
            rows.append((length, begin, first, count, offset))
            used[length] = begin + count * times
            offset += length * count
        first += times
    table = np.asarray(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "begin", "first", "count", "offset"), table.T))


def _cut(capacity: int, vocabulary: str, with_ids: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, numbers, starts, lengths, checks, pieces = [], [], [], [], [], []
        for doc_id, tokens in zip(batch.column(0).to_pylist(), encoder(vocabulary).encode(batch.column(1).to_pylist())):
            ids = tokens + _END
            size = len(ids) // 4
            start, number = 0, 0
            while start < size:
                length = (size - 1) % capacity + 1 if not number else capacity  # a shorter first piece, then full ones
                part = ids[4 * start:4 * (start + length)]
                docs.append(doc_id), numbers.append(number), starts.append(start), lengths.append(length)
                checks.append(zlib.crc32(part))
                if with_ids:
                    pieces.append(part)
                start, number = start + length, number + 1
        columns = {
            "doc_id": pa.array(docs, pa.int64()), "piece": pa.array(numbers, pa.int32()), "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(checks, pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array(pieces, pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    return run


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """The documents' pieces, with their ids if asked; only texts longer than a sequence are cut."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, _cut(capacity, vocabulary or vocabulary_path(), with_ids), schema)


def _place(table):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = table.value
        length, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        spot = np.empty(len(length), dtype=np.int64)
        for x in np.unique(length):
            low, high = np.searchsorted(s["length"], [x, x + 1])
            mine = length == x
            spot[mine] = low + np.searchsorted(s["begin"][low:high], number[mine], side="right") - 1
        inside, count = number - s["begin"][spot], s["count"][spot]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[2:], batch.column(0), pa.array(s["first"][spot] + inside // count), pa.array(s["offset"][spot] + inside % count * length)],
            [*batch.schema.names[2:], "length", "sequence_id", "offset"],
        )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length, ids_crc32)."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pinned = materialize(pieces.select(*columns))
    counts = {r["length"]: r["n"] for r in pinned.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    if not counts:
        return pinned.selectExpr("*", "0L AS sequence_id", "0L AS offset")
    table = pieces.sparkSession.sparkContext.broadcast(slots(complete_bins(counts, capacity)))
    numbered = dense_number(pinned, ["doc_id", "piece", "start", "ids_crc32"], ["length"], "number")
    placed = numbered.select("length", "number", "doc_id", "piece", "start", "ids_crc32")
    return text_batches(placed).mapInArrow(
        _each(_place(table)), "doc_id bigint, piece int, start bigint, ids_crc32 bigint, length bigint, sequence_id bigint, offset bigint"
    )


def _each(work):
    def run(batches):
        return (work(batch) for batch in batches if batch.num_rows)

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut_pieces(docs, capacity, vocabulary), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """The packed ids themselves: sequence_id, n_tokens, ids (little-endian unsigned 32-bit).

    At most ``capacity`` ids meet in a group.
    """
    cut = materialize(cut_pieces(docs, capacity, vocabulary, with_ids=True))
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = pack(cut, capacity)
    # repeated rows have equal keys: the n-th of them takes the n-th place
    nth = F.row_number().over(_by(keys, "sequence_id", "offset"))
    ids = cut.withColumn("nth", F.row_number().over(_by(keys, "ids")))
    joined = ids.alias("i").join(placed.withColumn("nth", nth).alias("p"), [F.col(f"i.{k}").eqNullSafe(F.col(f"p.{k}")) for k in [*keys, "nth"]])
    parts = joined.groupBy("sequence_id").agg(F.sum("p.length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", "n_tokens", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def _by(keys, *order):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy(*order)
