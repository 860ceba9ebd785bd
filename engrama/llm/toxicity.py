"""Toxicity by a learned lexicon, matched within one edit, with the context of each match.

* Lexicon: words, and stems (word beginnings of 4 to 7 letters), that occur in many
  toxic and next to no other labelled texts.  Near copies count once (texts with one
  smallest shingle hash are taken as copies).
* Matching: the lexicon is a trie, intersected with a Levenshtein automaton for one
  edit (terms of five letters or more).  The product is made deterministic as far as
  words lead into it, so a word costs one table look-up per letter; nearly all words
  leave it within three letters.
* Context: each match is put among its neighbours: windows of ``WINDOW`` words are scored
  by the weights of matches in them, and matches inside quotation marks count apart
  from those outside, so quoting and abusing can be weighed differently.
* Score: a logistic regression over these features, fitted on the sample.

Learning uses a bounded, documented sample: ``SAMPLE`` labelled training documents, the
first by a hash of their id.  The lexicon is counted on the cluster, and features of the
sample are a few numbers per row.  Scoring covers every whole text.

Results for odd input: a null or empty text has no match and gets the score of a text
without matches; unlabelled rows and null labels aren't learned from; if the sample
lacks either label, every score is the share of toxic ones (0 without a sample); ids
with several labels count as toxic if one of them does; rows with a null id are scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import crc32_text, map_arrow, text_batches
from engrama.llm.hashing import shingle_set, word_hashes
from engrama.session import materialize

SAMPLE = 30_000
QUOTE_WORDS = 60  # of a quotation, at most
LEXICON = 2_000       # terms at most, strongest first
STEMS = range(4, 8)
LEAST_TEXTS = 6       # toxic texts a term must be in, and at least this share of them
LEAST_SHARE = 0.004
LEAST_PRECISION = 0.9
EDITED_LENGTH = 5     # shorter terms must match exactly
WINDOW = 12
TOXIC_FROM = 0.7
KEPT_WORDS = 400_000

_WORD = re.compile(r"\w+")
_QUOTES = re.compile("(?<!\\d)\"|[«»“”„]")
FEATURES = 11


class Automaton:
    """Trie of terms x Levenshtein automaton of one edit, determinised lazily.

    A state is a set of (trie node, edits) and the best stem met so far.
    """

    def __init__(self, terms: dict[tuple[str, bool], float]):
        self.next: list[dict[str, int]] = [{}]
        self.word: list[tuple[float, int] | None] = [None]  # weight and length of a term that ends here
        self.stem: list[tuple[float, int] | None] = [None]
        for (term, is_stem), weight in sorted(terms.items()):
            node = 0
            for letter in term:
                node = self.next[node].setdefault(letter, len(self.next))
                if node == len(self.next):
                    self.next.append({}), self.word.append(None), self.stem.append(None)
            (self.stem if is_stem else self.word)[node] = (weight, len(term))
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state(frozenset({(0, 0)}), None)

    def _state(self, nodes: frozenset, stem: tuple | None) -> int:
        closed = set(nodes)
        for node, edits in nodes:
            if edits == 0:  # a letter of the term left out
                closed.update((child, 1) for child in self.next[node].values())
        for node, edits in closed:
            found = self.stem[node]
            if found and (edits == 0 or found[1] >= EDITED_LENGTH):
                new = (-edits, found[0])
                stem = new if stem is None else max(stem, new)
        key = (frozenset(closed), stem)
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        nodes, stem = self.sets[state]
        out = set()
        for node, edits in nodes:
            child = self.next[node].get(letter)
            if child is not None:
                out.add((child, edits))
            if edits == 0:
                out.add((node, 1))                                           # a letter too many
                out.update((c, 1) for c in self.next[node].values())         # another letter
        found = self._state(frozenset(out), stem)
        self.moves[state][letter] = found
        return found

    def match(self, word: str) -> tuple[float, int, int] | None:
        """(weight, edits, 1 if a stem) of the closest term, the heaviest of equals."""
        state = self.start
        for letter in word:
            state = self.moves[state].get(letter, -1) if letter in self.moves[state] else self._move(state, letter)
            nodes, stem = self.sets[state]
            if not nodes:
                break
        nodes, stem = self.sets[state]
        best = (*stem, 1) if stem else None
        for node, edits in nodes:
            found = self.word[node]
            if found and (edits == 0 or found[1] >= EDITED_LENGTH):
                new = (-edits, found[0], 0)
                best = new if best is None else max(best, new)
        return (best[1], -best[0], best[2]) if best else None


class Matcher:
    """Features of texts; remembers what each distinct chunk of text holds."""

    def __init__(self, terms: dict[tuple[str, bool], float]):
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple] = {}

    def _chunk(self, chunk: str) -> tuple:
        found = tuple(m for m in map(self.automaton.match, _WORD.findall(chunk)) if m)
        if len(chunk) < 64:
            self.known[chunk] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        """By kind (word or stem) x (exact or edited) x (plain or quoted): log of matches; then the
        heaviest window, all weight and the share of words that match, as logs."""
        out = np.zeros(FEATURES)
        if not text:
            return out
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        chunks = text.lower().split()
        known = self.known
        hits = {}
        for chunk in set(chunks):
            found = known[chunk] if chunk in known else self._chunk(chunk)
            if found:
                hits[chunk] = found
        if not hits:
            return out
        quoted = self._quoted(chunks) if _QUOTES.search(text) else None
        weights = np.zeros(len(chunks) + WINDOW)
        matches = 0
        for i, chunk in enumerate(chunks):
            for weight, edits, stem in hits.get(chunk, ()):
                inside = bool(quoted and quoted[i])
                out[4 * inside + 2 * stem + edits] += 1
                weights[i] += weight * (0.5 if inside or edits else 1.0)
                matches += 1
        sums = np.concatenate(([0.0], np.cumsum(weights)))
        out[8], out[9] = (sums[WINDOW:] - sums[:-WINDOW]).max(), sums[-1]
        out[10] = 100 * matches / len(chunks)
        return np.log1p(out)

    @staticmethod
    def _quoted(chunks: list[str]) -> list[bool]:
        """Which words stand in a quotation: between two marks at most ``QUOTE_WORDS`` apart; inches are no marks."""
        inside, opened = [False] * len(chunks), None
        for i, chunk in enumerate(chunks):
            for _ in _QUOTES.findall(chunk):
                if opened is not None and i - opened <= QUOTE_WORDS:
                    inside[opened:i + 1] = [True] * (i + 1 - opened)
                    opened = None
                else:
                    opened = i
        return inside


def training_rows(doc_id: Column) -> Column:
    """Labels that may be learned from; the others are held out."""
    return F.pmod(crc32_text(doc_id), F.lit(3)) != 1


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most ``SAMPLE`` labelled training documents."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    known = known.where(training_rows(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # two numbers a row, a bounded number of rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"]).select("text", "toxic"))


def _terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    terms, stems, toxic, keys = [], [], [], []
    texts = batch.column(0).to_pylist()
    for text, label, words in zip(texts, batch.column(1).to_pylist(), word_hashes(texts)):
        if not len(words):
            continue
        key = int(shingle_set(words)[0].view(np.int64))
        found = {w for w in _WORD.findall(text.lower()) if len(w) > 3 and not w.isdigit()}
        for is_stem, group in ((False, found), (True, {w[:n] for w in found for n in STEMS if len(w) > n})):
            terms.extend(group), stems.extend([is_stem] * len(group))
            toxic.extend([label] * len(group)), keys.extend([key] * len(group))
    return pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array(stems, pa.bool_()), pa.array(toxic, pa.int32()), pa.array(keys, pa.int64())],
        ["term", "is_stem", "toxic", "key"],
    )


def learn_lexicon(sample: DataFrame) -> dict[tuple[str, bool], float]:
    """Terms with their log odds of being in a toxic text."""
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        return {}
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))
    rows = map_arrow(sample, _terms, "term string, is_stem boolean, toxic int, key bigint")
    candidates = rows.where("toxic = 1").groupBy("term", "is_stem").agg(F.approx_count_distinct("key", 0.05).alias("a")).where(F.col("a") >= least)
    others = rows.where("toxic = 0").groupBy("term", "is_stem").agg(F.count(F.lit(1)).alias("b"))
    counted = candidates.join(others, ["term", "is_stem"], "left").select("term", "is_stem", "a", F.coalesce("b", F.lit(0)).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    precise = counted.where(F.col("a") / (F.col("a") + F.col("b")) >= LEAST_PRECISION)
    best = precise.select("term", "is_stem", odds.alias("weight")).orderBy(F.desc("weight"), "term", "is_stem").limit(LEXICON)
    return {(r.term, r.is_stem): r.weight for r in best.collect() if r.weight > 0}


def _featured(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms.value)
        for batch in batches:
            if batch.num_rows:
                rows = np.array([matcher.features(t) for t in batch.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the constant comes last."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(rows) / 100)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[tuple[str, bool], float], np.ndarray | float]:
    """The lexicon and the weights of its features, or one score for all."""
    sample = training_sample(docs, labels)
    terms = learn_lexicon(sample)
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    rows = text_batches(sample.select("text", "toxic")).mapInArrow(_featured(sent), "toxic int, x array<double>").collect()  # <= SAMPLE rows
    y = np.array([float(r.toxic > 0) for r in rows])
    if not len(y) or y.min() == y.max():
        return terms, float(y.mean()) if len(y) else 0.0
    return terms, fit(np.array([r.x for r in rows]), y)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = model.value
        matcher = Matcher(terms)
        for batch in batches:
            if not batch.num_rows:
                continue
            if isinstance(weights, float):
                scores = np.full(batch.num_rows, weights)
            else:
                rows = np.array([matcher.features(t) for t in batch.column(1).to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(rows @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = text_batches(texts).mapInArrow(_score(sent), "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(~training_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )
