"""Alignment of two tokenizers over the same bytes, by sparse incidence matrices.

A token-byte incidence matrix has a row per token and a column per byte, in CSR form
(``indptr``, ``indices``).  The row products A x B^T say which tokens of A and B overlap,
and by how many bytes; products of the token-group incidences say which share a group,
groups being cut where tokens of both end.  All texts of a batch are one block-diagonal
matrix, so numpy works on them together.

Corpus-wide counts need no broadcast: texts are written in blocks, a block asks once for
each distinct id pair in it, and the answers (how many documents link the pair, and
whether that is the highest count of its A id) come back to the block by a join.  A pair
is asked for once per block, so no pair is a hot key.

Results for odd input: a text that is null, empty, or not spelled alike by both
tokenizers (A's or B's joined bytes differ from a space and the text) has no tokens and
zeros; rows of one doc_id, or of none, are documents of their own; other columns are
ignored.  A long text is a block of its own and costs memory in proportion to its length.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.llm.tokens import Remembered, encoder, vocabulary_path
from engrama.session import ship_package, work_dir

PIECE_VOCABULARY = "piece_bpe_32k.model"
SPACE_MARK = "▁"
BLOCK_BYTES = 16 * 1024 * 1024  # texts of a block, in which each id pair is asked for once
BATCH_BYTES = 512 * 1024       # texts whose matrices are made together

_PLAIN = regex.compile(r"[\n -~¡-ɏ]*")  # texts whose words can be encoded one by one


class Csr:
    """Rows of sorted column numbers, with equal weights of one."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, columns: int):
        self.indptr, self.indices, self.columns = indptr, indices, columns

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns))))
        return Csr(indptr, self.row_of_entries()[order], self.rows)

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Terms of each row of ``self @ other``, before equal columns are added up."""
        terms = np.concatenate(([0], np.cumsum(np.diff(other.indptr)[self.indices])))
        return terms[self.indptr[1:]] - terms[self.indptr[:-1]]

    def times(self, other: Csr) -> tuple[Csr, np.ndarray]:
        """``self @ other`` by Gustavson's rows: for each entry k of a row, row k of ``other`` is added up.

        Returns the pattern and the values.
        """
        counts = np.diff(other.indptr)[self.indices]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(other.indptr[self.indices] - (ends - counts), counts)
        columns, row = other.indices[at], np.repeat(self.row_of_entries(), counts)
        if len(at) and ((row[1:] == row[:-1]) & (columns[1:] < columns[:-1])).any():
            order = np.lexsort((columns, row))
            columns, row = columns[order], row[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(at), 1), bool), (row[1:] != row[:-1]) | (columns[1:] != columns[:-1]))))
        values = np.diff(np.concatenate((first, [len(at)])))
        indptr = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=self.rows))))
        return Csr(indptr, columns[first], other.columns), values


def incidence(ends: np.ndarray, size: int) -> Csr:
    """Tokens by bytes, from the offsets at which the tokens end."""
    return Csr(np.concatenate(([0], ends)), np.arange(size), size)


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by groups, from the offsets at which tokens and groups end."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), len(cuts))


class PieceEncoder:
    """Ids by a sentencepiece file; words of ordinary texts are encoded once and kept.

    Pieces never hold a space mark behind another character, nor a newline, so merges
    don't cross them; whether that is so is read from the vocabulary.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) or self.model.is_unknown(i)
            else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.apart = not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)
        self.words = Remembered(self._word)
        self.newline = np.asarray(self.model.encode("a\nb")[1:-1], "<u4").tobytes()
        self.inner = Remembered(self._inner)

    def _word(self, word: str) -> bytes:
        return np.asarray(self.model.encode(word), "<u4").tobytes()

    def _inner(self, piece: str) -> bytes:
        """The ids of a piece that no space comes before."""
        return np.asarray(self.model.encode("\n" + piece)[len(self.newline) // 4 + 1:], "<u4").tobytes()

    def _line(self, line: str, first: bool) -> bytes:
        head, *rest = line.split(" ")
        start = self.words[head] if first else self.inner[head] if head else b""
        return start + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if self.apart and len(self.newline) == 4 and "  " not in text and not text.startswith((" ", "\n")) and not text.endswith(" ") and " \n" not in text and _PLAIN.fullmatch(text):
            first, *rest = text.split("\n")
            return self.newline.join([self._line(first, True), *(self._line(line, False) for line in rest)])
        return np.asarray(self.model.encode(text), "<u4").tobytes()


class Pair:
    """Both tokenizers, and how their ids are spelled."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = encoder(path_a, True), PieceEncoder(path_b)
        byte_of = {letter: byte for byte, letter in self.a.letters.items()}
        size = self.a.tokenizer.get_vocab_size()
        spelled_a = [b""] * size
        for token, i in self.a.tokenizer.get_vocab().items():
            spelled_a[i] = bytes(byte_of.get(letter, ord(letter) & 255) for letter in token)
        self.spelled = spelled_a, self.b.bytes
        self.sizes = tuple(np.array([len(x) for x in s], np.int64) for s in self.spelled)
        self.n_a, self.n_b = size, len(self.b.bytes)
        self.stride = max(self.n_a, self.n_b)
        self.names = [str(i) + tail for tail in (",", ";", "|") for i in range(self.stride)]

    def encode(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """(A ids, B ids, bytes) of each text; none where the two don't spell a space and the text."""
        out = []
        self.b.words.trim(), self.b.inner.trim()
        for text, ids in zip(texts, self.a.encode([f" {t}" if t else None for t in texts])):
            if text:
                spelled = f" {text}".encode("utf-8", "surrogatepass")
                a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in (ids, self.b.encode(text)))
                if all(b"".join(map(s.__getitem__, x.tolist())) == spelled for s, x in zip(self.spelled, (a, b))):
                    out.append((a, b, len(spelled)))
                    continue
            out.append((np.empty(0, np.int64), np.empty(0, np.int64), 0))
        return out


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker process."""
    return Pair(path_a, path_b)


class Aligned:
    """Links and groups of a batch of encoded texts, as products of block-diagonal matrices."""

    def __init__(self, coded: Sequence[tuple[np.ndarray, np.ndarray, int]], both: Pair):
        self.n_a, self.n_b = (np.array([len(c[i]) for c in coded], np.int64) for i in (0, 1))
        self.a, self.b = (np.concatenate([c[i] for c in coded]) for i in (0, 1))
        size = sum(c[2] for c in coded)
        ends_a, ends_b = np.cumsum(both.sizes[0][self.a]), np.cumsum(both.sizes[1][self.b])
        by_byte = incidence(ends_a, size), incidence(ends_b, size)
        self.links, self.bytes = by_byte[0].times(by_byte[1].transposed())  # tokens of A by tokens of B
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = group_incidence(ends_a, cuts), group_incidence(ends_b, cuts)
        texts = np.arange(len(coded))
        self.text_of_a, self.text_of_b = np.repeat(texts, self.n_a), np.repeat(texts, self.n_b)
        last = np.cumsum([c[2] for c in coded])
        self.text_of_cut = np.searchsorted(last, cuts)

    def per_text(self, of: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, values, minlength=len(self.n_a)).astype(np.int64)

    def shared_groups(self) -> tuple[Csr, np.ndarray]:
        """Tokens of A by tokens of B that share a group."""
        return self.group_a.times(self.group_b.transposed())

    def group_texts(self, both: Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group, per text."""
        ga, gb, n = self.group_a.indices, self.group_b.indices, self.group_a.columns
        last_a, last_b = np.append(ga[1:] != ga[:-1], True)[:len(ga)], np.append(gb[1:] != gb[:-1], True)[:len(gb)]
        per_a, per_b = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
        before_b, upto_a = np.cumsum(per_b) - per_b, np.cumsum(per_a)
        names = np.empty(len(ga) + len(gb), np.int64)
        names[np.arange(len(ga)) + before_b[ga]] = self.a + both.stride * np.where(last_a, 2, 0)
        names[np.arange(len(gb)) + upto_a[gb]] = self.b + both.stride * np.where(last_b, 1, 0)
        joined = list(map(both.names.__getitem__, names.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(joined[i:j])[:-1] for i, j in zip([0, *ends[:-1]], ends)]


_WRITTEN = (
    "block string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, "
    "groups_sha256 string, places binary, times binary, pairs array<bigint>, texts array<int>"
)


def _write_blocks(path_a: str, path_b: str, block_bytes: int, batch_bytes: int):
    """Rows of documents, then one row (without counts) of the distinct pairs of their block."""
    schema = pa.schema([
        ("block", pa.string()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")),
        ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("texts", pa.list_(pa.int32())),
    ])

    def block_rows(name: str, held: list[tuple[int | None, str | None]], both: Pair) -> pa.RecordBatch:
        rows, keys = [], []
        for part in _parts(held, batch_bytes):
            done = Aligned(both.encode([t for _, t in part]), both)
            text = done.text_of_a[done.links.row_of_entries()]
            linked = done.a[done.links.row_of_entries()] * both.n_b + done.b[done.links.indices]
            n_links = done.per_text(text).tolist()
            key = np.sort(text * (both.n_a * both.n_b) + linked)
            first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
            times = np.diff(np.append(first, len(key)))
            text, linked = np.divmod(key[first], both.n_a * both.n_b)
            at = np.searchsorted(text, np.arange(len(part) + 1))
            shared = done.per_text(done.text_of_a, done.group_a.product_sizes(done.group_b.transposed()))
            columns = zip(part, done.n_a.tolist(), done.n_b.tolist(), done.per_text(done.text_of_cut).tolist(), n_links, shared.tolist(), done.group_texts(both))
            for i, ((doc_id, _), a, b, groups, links, n_shared, spelled) in enumerate(columns):
                rows.append((doc_id, a, b, groups, links, n_shared, hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
                keys.append((linked[at[i]:at[i + 1]], times[at[i]:at[i + 1]]))
        distinct, n_texts = np.unique(np.concatenate([k for k, _ in keys]), return_counts=True)
        places = [np.diff(np.searchsorted(distinct, k), prepend=0).astype("<u4").tobytes() for k, _ in keys]  # steps
        weights = [t.astype("<u4").tobytes() for _, t in keys]
        columns = [[*c, None] for c in zip(*rows)]
        split = np.append(distinct // both.n_b, distinct % both.n_b).reshape(2, -1)
        packed = (split[0] << 32 | split[1]).tolist()
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([
            [name] * (n + 1), *columns, [*places, None], [*weights, None], [None] * n + [packed], [None] * n + [n_texts.tolist()],
        ], schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, count, held, size = pair(path_a, path_b), TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and size + len(row[1] or "") > block_bytes:
                    yield block_rows(f"{task}-{count}", held, both)
                    count, held, size = count + 1, [], 0
                held.append(row)
                size += len(row[1] or "") + 64
        if held:
            yield block_rows(f"{task}-{count}", held, both)

    return run


def _parts(rows: list, limit: int) -> Iterator[list]:
    held, size = [], 0
    for row in rows:
        if held and size + len(row[1] or "") > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[1] or "") + 64
    yield held


_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, n_group_links bigint"


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of one block with the answers to its pairs."""
    order = np.argsort(answers["place"].to_numpy())
    counts, best = answers["docs"].to_numpy()[order], answers["best"].to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for places, times in zip(docs["places"].to_pylist(), docs["times"].to_pylist()):
        at, n = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64)), np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int(n[best[at]].sum())), count_sum.append(int((n * counts[at]).sum()))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.append_column("groups_sha256", docs["groups_sha256"]).append_column("n_group_links", docs["n_group_links"])


def linked_blocks(
    docs: DataFrame, folder: str | None = None, vocabulary_a: str | None = None, vocabulary_b: str | None = None,
    block_bytes: int = BLOCK_BYTES, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Encode and align every text once; the written table of documents and of the pairs of their blocks."""
    spark = docs.sparkSession
    ship_package(spark)
    path = f"{folder or work_dir(spark, 'alignment')}/blocks"
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = _write_blocks(vocabulary_a or vocabulary_path(), vocabulary_b or vocabulary_path(PIECE_VOCABULARY), block_bytes, batch_bytes)
    texts.mapInArrow(work, _WRITTEN).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_WRITTEN).parquet(path)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, docs, best): documents that link the pair, and whether none of its A id's pairs has more."""
    asked = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "texts")).alias("x"))
    found = asked.select(F.col("x.pairs").alias("pair"), F.col("x.texts").alias("n")).groupBy("pair").agg(F.sum("n").alias("docs"))
    found = found.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("b"), "docs")
    highest = found.groupBy("a").agg(F.max("docs").alias("highest"))
    return found.join(highest, "a").select("pair", "a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align(docs: DataFrame, **options) -> DataFrame:
    """Every document's tokens, groups and links, with the corpus-wide counts of its linked id pairs."""
    blocks = linked_blocks(docs, **options)
    counts = pair_counts(blocks).select("pair", "docs", "best")
    asked = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("by"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("by", "place", "docs", "best")
    rows = blocks.where("places IS NOT NULL").select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "places", "times")
    return rows.groupBy("block").cogroup(answers.groupBy("by")).applyInArrow(_score, _RESULT)
