"""Vector arithmetic: JVM column expressions, and the numpy kernel used inside search tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engrama.defaults import FIRST_ROWS, SCORE_CELLS, SCORE_ROWS, SCREEN_ROWS, SCREEN_SHARE

METRICS = ("COSINE", "IP", "L2")


def r6(value: Column) -> Column:
    """Scores are compared and reported at six digits."""
    return F.round(value, 6)


def normalize_metric(metric: str | None) -> str:
    name = (metric or "COSINE").strip().upper()
    if name not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    return name


def matrix_of(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """A list column as a float64 matrix; every row must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty((0, dim or 0))
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    width = int(lengths[0]) if dim is None else dim
    if not (lengths == width).all():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} dimensions where {width} is required")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def sortable(ids: np.ndarray | pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as a plain numpy array that sorts as Spark sorts them."""
    if isinstance(ids, pa.Array):
        ids = ids.to_numpy(zero_copy_only=False)
    elif isinstance(ids, pa.ChunkedArray):
        ids = ids.to_numpy()
    return ids.astype(str) if ids.dtype == object else ids


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def distances_l2(queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product; pairs too close for that are recomputed directly."""
    scale = (queries**2).sum(axis=1)[:, None] + (base**2).sum(axis=1)[None, :]
    squared = np.maximum(scale - 2 * (queries @ base.T), 0)
    rows, cols = np.nonzero(squared < 1e-4 * scale)
    for start in range(0, len(rows), 50_000):
        r, c = rows[start : start + 50_000], cols[start : start + 50_000]
        squared[r, c] = ((queries[r] - base[c]) ** 2).sum(axis=1)
    return np.sqrt(squared)


def scores(metric: str, queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Score matrix, larger is better; L2 is returned negated."""
    if metric == "L2":
        return -np.round(distances_l2(queries, base), 6) + 0.0
    out = queries @ base.T
    if metric == "COSINE":
        scale = np.outer(np.linalg.norm(queries, axis=1), np.linalg.norm(base, axis=1))
        out = np.divide(out, scale, out=np.zeros_like(out), where=scale > 0)
    return np.round(out, 6) + 0.0


def nearest(rows: np.ndarray, centers: np.ndarray, closeness) -> np.ndarray:
    """Number of the closest center per row, ties to the smaller number; the matrix is held in slices."""
    step = max(1, SCORE_CELLS // len(centers))
    slices = [
        np.round(closeness(rows[i : i + step], centers), 6).argmax(axis=1) for i in range(0, len(rows), step)
    ]
    return np.concatenate(slices)  # argmax takes the first of equals


def keep_best(
    query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of every query: by score descending, then id ascending."""
    sorted_rows = _sorted_as_numbers(query, ids, score)
    if sorted_rows is None:
        order = np.lexsort((ids, -score, query))
        sorted_rows = query[order], ids[order], score[order]
    query, ids, score = sorted_rows
    at = np.arange(len(query))
    starts = np.maximum.accumulate(np.where(np.concatenate([[True], query[1:] != query[:-1]])[: len(query)], at, 0))
    kept = at - starts < k
    return query[kept], ids[kept], score[kept]


def _sorted_as_numbers(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The same order by one sort, where a whole entry goes into one integer: numbers as ids, scores of six digits."""
    if not len(query) or query.dtype.kind != "i" or ids.dtype.kind != "i":
        return None
    millionths = np.rint(score * 1e6)
    if not (np.abs(millionths) < 2**52).all() or not (millionths / 1e6 == score).all():
        return None
    top, least_id = int(millionths.max()), int(ids.min())
    id_bits = (int(ids.max()) - least_id).bit_length()
    score_bits = (top - int(millionths.min())).bit_length()
    if query.min() < 0 or int(query.max()).bit_length() + score_bits + id_bits > 63:
        return None
    packed = (query.astype(np.int64) << score_bits | top - millionths.astype(np.int64)) << id_bits | ids.astype(np.int64) - least_id
    packed.sort()
    found = (packed & (1 << id_bits) - 1) + least_id
    packed >>= id_bits
    return (packed >> score_bits).astype(query.dtype), found.astype(ids.dtype), (top - (packed & (1 << score_bits) - 1)) / 1e6


class Coding:
    """Base rows as they are: vectors.  Other codings say how queries are scored against stored codes."""

    cells = 1  # numbers held per query beside its scores

    def width(self, dim: int) -> int:
        """Length of a stored row, for queries of this dimension."""
        return dim

    def vectors(self, stored: np.ndarray) -> np.ndarray:
        """What some stored rows stand for."""
        return stored

    def scores(self, metric: str, queries: np.ndarray, stored: np.ndarray) -> np.ndarray:
        return scores(metric, queries, self.vectors(stored))

    def pair_scores(self, metric: str, queries: np.ndarray, stored: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """The scores of single pairs, given by their places."""
        out, step = np.empty(len(rows)), max(1, SCORE_CELLS // (4 * max(1, queries.shape[1])))
        for start in range(0, len(rows), step):
            a, b = queries[rows[start : start + step]], self.vectors(stored[cols[start : start + step]])
            if metric == "L2":
                score = -np.sqrt(((a - b) ** 2).sum(axis=1))
            else:
                score = np.einsum("ij,ij->i", a, b)
            if metric == "COSINE":
                scale = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
                score = np.divide(score, scale, out=np.zeros_like(score), where=scale > 0)
            out[start : start + step] = np.round(score, 6) + 0.0
        return out


class ByteRanges(Coding):
    """A step of 255 per dimension between its smallest and largest value."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high

    def vectors(self, stored: np.ndarray) -> np.ndarray:
        return self.low + stored * (self.high - self.low) / 255


class PartTables(Coding):
    """A codebook entry per part, ``books`` being ``(parts, entries, dim / parts)``; for L2.

    A query's distances to all entries are one table; a stored row's distance is the
    root of the entries its codes pick from it.  Rows become vectors again a slice at a
    time, where many of them are only to be turned away.
    """

    def __init__(self, books: np.ndarray):
        self.books = books
        self.cells = books.shape[0] * books.shape[1]

    def width(self, dim: int) -> int:
        return len(self.books)

    def vectors(self, stored: np.ndarray) -> np.ndarray:
        return self.books[np.arange(len(self.books)), stored.astype(np.int64)].reshape(len(stored), -1)

    def scores(self, metric: str, queries: np.ndarray, stored: np.ndarray) -> np.ndarray:
        if metric != "L2":
            raise ValueError("part codes are compared by L2")
        codes = stored.astype(np.int64)
        squared = np.zeros((len(queries), len(codes)))
        pieces = queries.reshape(len(queries), len(self.books), -1)
        for part, book in enumerate(self.books):
            squared += (distances_l2(pieces[:, part], book) ** 2)[:, codes[:, part]]
        return -np.round(np.sqrt(squared), 6) + 0.0


class Screen:
    """Products in single precision that turn away pairs which cannot reach a bar, and no others.

    Vectors are scaled to a length of 1 at most, so a product of n terms is off by less than
    (n + 4) / 2**24 of the lengths' product; the bar is lowered by that and by what rounding adds.
    """

    def __init__(self, metric: str, queries: np.ndarray, stored: np.ndarray, coding: Coding):
        self.metric = metric
        pieces = [stored[i : i + SCORE_ROWS] for i in range(0, len(stored), SCORE_ROWS)]
        with np.errstate(all="ignore"):  # what overflows is not screened
            self.asked = np.linalg.norm(queries, axis=1)
            lengths = [np.linalg.norm(coding.vectors(piece), axis=1) for piece in pieces]
            self.longest = max(x.max() for x in lengths) or 1.0
            off = 1.05 * (queries.shape[1] + 5) / 2**24
            if metric == "L2":
                # |q - b|**2 = |q|**2 - 2 (q b - |b|**2 / 2), the inner part as a product with one more term
                far = self.asked / self.longest
                self.slack = off * (far + 0.5) + 1e-15 * far**2
                left = np.column_stack([queries / self.longest, np.ones(len(queries))])
                right = [np.column_stack([coding.vectors(p) / self.longest, -((n / self.longest) ** 2) / 2]) for p, n in zip(pieces, lengths)]
            else:
                self.slack = off
                left = queries / np.where(self.asked > 0, self.asked, 1)[:, None]
                scales = [np.where(n > 0, n, 1)[:, None] if metric == "COSINE" else self.longest for n in lengths]
                right = [coding.vectors(p) / scale for p, scale in zip(pieces, scales)]
            self.left = left.astype(np.float32)
            self.right = np.concatenate([x.astype(np.float32) for x in right])
        self.sound = bool(np.isfinite(self.left).all() and np.isfinite(self.right).all())

    def _least(self, at: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """The smallest product that may reach the bar: scores are rounded to six digits."""
        slack, asked = (x[at] if isinstance(x, np.ndarray) else x for x in (self.slack, self.asked))
        if self.metric == "COSINE":
            least = bar - 6e-7
        elif self.metric == "IP":
            least = (bar - 6e-7) / (np.where(asked > 0, asked, 1) * self.longest)
        else:
            least = ((asked / self.longest) ** 2 - ((6e-7 - bar) / self.longest) ** 2) / 2
        return np.nextafter((least - slack).astype(np.float32), np.float32(-np.inf))

    def reaching(self, at: np.ndarray, bar: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Places among ``at`` and from ``low`` of the pairs that may reach the bar; nothing if they are too many to look at singly."""
        left, least = self.left[at], self._least(at, bar)[:, None]
        rows, cols, n, most = [], [], 0, SCREEN_SHARE * len(at) * (high - low)
        for i in range(0, len(at), SCREEN_ROWS):
            for j in range(low, high, SCREEN_ROWS):
                hits = left[i : i + SCREEN_ROWS] @ self.right[j : min(high, j + SCREEN_ROWS)].T >= least[i : i + SCREEN_ROWS]
                spots = _true_spots(hits.reshape(-1))
                n += len(spots)
                if n > most:
                    return None
                rows.append(i + spots // hits.shape[1]), cols.append(j - low + spots % hits.shape[1])
        return np.concatenate(rows), np.concatenate(cols)


def _true_spots(flags: np.ndarray) -> np.ndarray:
    """``flatnonzero`` where few are true: eight are looked at together."""
    if len(flags) % 8:
        return np.flatnonzero(flags)
    words = np.flatnonzero(flags.view(np.uint64) != 0)
    word, byte = np.nonzero(flags.reshape(-1, 8)[words])
    return words[word] * 8 + byte


def block_top_k(
    metric: str, query_rows: np.ndarray, queries: np.ndarray, ids: np.ndarray, base: np.ndarray, k: int,
    coding: Coding | None = None, bars: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` base rows for each query, with the score matrix held in bounded slices of queries and base rows.

    A few base rows give every query a k-th best; of the others only what reaches it is scored.
    ``bars``  a k-th best that queries have from elsewhere; rows below it are left out.
    """
    coding = coding or Coding()
    bars = np.full(len(queries), -np.inf) if bars is None else bars
    barred = bars > -np.inf
    screen = Screen(metric, queries, base, coding) if len(base) > FIRST_ROWS or barred.any() and len(base) else None
    step = max(1, SCORE_CELLS // max(1, min(len(base), SCORE_ROWS), coding.cells))
    parts = [(query_rows[:0], ids[:0], np.empty(0))]
    for some in (np.flatnonzero(barred), np.flatnonzero(~barred)):
        for start in range(0, len(some), step):
            at = some[start : start + step]
            best = _slice_top_k(metric, at, queries[at], ids, base, k, coding, bars[at], screen)
            parts.append((query_rows[at[best[0]]], best[1], best[2]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _slice_top_k(
    metric: str, at: np.ndarray, asked: np.ndarray, ids: np.ndarray, base: np.ndarray, k: int, coding: Coding, bar: np.ndarray, screen: Screen | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept, low = (np.empty(0, dtype=np.int64), ids[:0], np.empty(0)), 0
    while low < len(base):
        barred = bar.min() > -np.inf
        # until there are bars few rows; then as many as before, so that few more reach the bar than are kept
        high = min(len(base), low + min(SCORE_ROWS, max(FIRST_ROWS, 4 * k, low) if low or not barred else SCORE_ROWS))
        spots = screen.reaching(at, bar, low, high) if barred and screen and screen.sound else None
        if spots is not None:
            rows, cols = spots
            score = coding.pair_scores(metric, asked, base, rows, low + cols)
            reached = score >= bar[rows]
            rows, cols, score = rows[reached], cols[reached], score[reached]
        else:
            block = coding.scores(metric, asked, base[low:high])
            if low or barred:
                rows, cols = np.nonzero(block >= bar[:, None])
            elif k < block.shape[1]:
                # every entry tied with the k-th best survives, so the id order decides among ties
                least = np.partition(block, block.shape[1] - k, axis=1)[:, block.shape[1] - k, None]
                rows, cols = np.nonzero(block >= least)
            else:
                rows, cols = (axis.ravel() for axis in np.indices(block.shape))
            score = block[rows, cols]
        kept = keep_best(*(np.concatenate(pair) for pair in zip(kept, (rows, ids[low + cols], score))), k)
        if high < len(base):
            full = np.flatnonzero(np.bincount(kept[0], minlength=len(asked)) == k)
            bar = bar.copy()
            bar[full] = kept[2][np.searchsorted(kept[0], full, side="right") - 1]
        low = high
    return kept


class Best:
    """Running best rows per (group, query) inside one task: at most groups x queries x k, which the caller bounds.

    ``wait``  rows of a group that may wait for the next sort; bars rise with the sorts.
    """

    def __init__(self, k: int, n_queries: int, wait: int = 0):
        self.k, self.n_queries, self.wait = k, n_queries, wait
        self.kept, self.bars, self.waiting = {}, {}, {}

    def keep(self, group: tuple, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if group in self.bars:
            # what scores below a query's k-th best so far cannot get in any more
            contending = score >= self.bars[group][query]
            query, ids, score = query[contending], ids[contending], score[contending]
        if not len(query):
            return
        waiting = self.waiting.setdefault(group, [])
        waiting.append((query, ids, score))
        if self.wait:
            # k rows of one query make a bar before they are sorted
            starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
            whole = np.diff(np.append(starts, len(query))) == self.k
            got, least = query[starts[whole]], np.minimum.reduceat(score, starts)[whole]
            bar = self.bars.setdefault(group, np.full(self.n_queries, -np.inf))
            bar[got] = np.maximum(bar[got], least)
        if sum(len(x[0]) for x in waiting) > self.wait:
            self.sort(group)

    def sort(self, group: tuple) -> None:
        waiting = self.waiting.pop(group, [])
        if not waiting:
            return
        held = [self.kept[group]] if group in self.kept else []
        query, ids, score = self.kept[group] = keep_best(*(np.concatenate(x) for x in zip(*held, *waiting)), self.k)
        full = np.flatnonzero(np.bincount(query, minlength=self.n_queries) == self.k)
        bar = np.full(self.n_queries, -np.inf)
        bar[full] = score[np.searchsorted(query, full, side="right") - 1]
        self.bars[group] = bar

    def bars_of(self, group: tuple, query: np.ndarray) -> np.ndarray | None:
        return self.bars[group][query] if group in self.bars else None

    def batches(self, query_ids: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of ``(query id, *group, id, score)``."""
        for group in list(self.waiting):
            self.sort(group)
        for group, (query, ids, score) in self.kept.items():
            columns = [pa.array(query_ids[query], type=schema.field(0).type)]
            for value, field in zip(group, list(schema)[1:-2]):
                columns.append(pa.array([value] * len(query), type=field.type))
            columns.append(pa.array(ids, type=schema.field(len(schema) - 2).type))
            columns.append(pa.array(score, type=pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
