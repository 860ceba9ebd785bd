"""Repeated line runs across documents, by a suffix array over line ids; later copies are deleted.

Lines are what newlines separate, compared exactly; a line's id is a 96-bit hash.
The corpus is one sequence of ids per document, and a suffix is the lines from a
given one to its document's end.

* Prefix doubling ranks suffixes by their first 1, 2, 4, ... lines.  A rank is
  (id of the first line, place in the order of the suffixes starting with it), so
  refining a group only needs the sizes of its own subgroups and no numbering of
  the whole corpus.  A suffix whose prefix is unique stands alone in the array and
  takes no further part, which leaves only repeated lines from the first step on.
* Two suffixes agree on m lines exactly if their ranks by 2**j lines agree both at
  the start and at ``m - 2**j`` lines behind, 2**j <= m < 2**(j+1): this is the
  longest-common-prefix interval of m lines, found by one equi-join.
* A run counts once it has ``min_words`` words.  Every line of a repeated run that
  long lies in a shortest one beginning or ending inside it, so those intervals
  reveal all maximal runs, and the doubling stops at the longest of them.
* Of an interval, the first suffix by (doc_id, line) is the original; the lines of
  all others are deleted.

All work is DataFrame expressions; groups are counted by partial aggregates and
joined back, so a line in a third of all documents is a skewed join that splits.

Results for odd input: a null text stays null, an empty one empty; rows with a null
id are passed through and no copies are looked for in them; rows of one id with one
text count as one document; of an id with several texts the smallest counts, and rows
with another one are passed through; a document's own repeats are deleted too; other
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engrama.llm.common import released, sized, unused
from engrama.session import materialize

MIN_WORDS = 50
_AT = ["doc", "pos"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _words(line: Column) -> Column:
    """How many words a line has."""
    return F.size(F.filter(F.split(line, r"[ \t\x0B\f\r]+"), lambda w: w != "")).cast("bigint")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))


def smallest_texts(docs: DataFrame) -> DataFrame | None:
    """(doc, text) of the ids that several rows have, each with its smallest text; None where there are none."""
    ids = materialize(_texts(docs).groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"))
    if ids.isEmpty():
        return None
    rows = _texts(docs).join(sized(ids, 16), "doc", "left_semi")
    return materialize(rows.groupBy("doc").agg(F.min("text").alias("text")))  # texts of these ids only, least per task first


def line_ids(docs: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """One row per line: document, place, id (h1, h2) and words; ``chosen`` are the texts of ids with several rows."""
    texts = _texts(docs)
    if chosen is not None:
        texts = texts.join(sized(chosen.select("doc"), 16), "doc", "left_anti").unionByName(chosen)
    described = F.transform(_lines(F.col("text")), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.hash(x).alias("h2"), _words(x).alias("words")))
    return texts.select("doc", F.posexplode(described).alias("pos", "line")).select("doc", F.col("pos").cast("bigint").alias("pos"), "line.*")


def repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose keys occur more than once, with how often."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    return rows.join(counts, keys)


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, m): shortest runs of neighbouring repeated lines with ``min_words``, from each line and up to each line."""
    in_doc = Window.partitionBy("doc").orderBy("pos")
    upto = in_doc.rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("i", F.row_number().over(in_doc).cast("bigint")).withColumn("w", F.sum("words").over(upto)).withColumn("s", F.col("w") - F.col("words"))
    # a line that ends a run from line i is the one before the first start at s + min_words; the last one has no start behind it
    from_end = Window.partitionBy("doc").orderBy(F.col("s").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    from_start = Window.partitionBy("doc").orderBy("w").rangeBetween(Window.unboundedPreceding, -min_words)
    whole = Window.partitionBy("doc")
    last = F.max("i").over(whole)
    reached = F.min("i").over(from_end) - 1
    forward = F.coalesce(reached, F.when(F.max("w").over(whole) >= F.col("s") + min_words, last))
    backward = F.coalesce(F.max("i").over(from_start) + 1, F.when(F.col("w") >= min_words, F.lit(1)).cast("bigint"))
    bounds = placed.select("doc", "pos", "i", forward.alias("last"), backward.alias("first"))
    starts = bounds.where("last is not null").select("doc", "pos", "i", (F.col("last") - F.col("i") + 1).alias("m"))
    ends = bounds.where("first is not null").select("doc", (F.col("pos") - (F.col("i") - F.col("first"))).alias("pos"), F.col("first").alias("i"), (F.col("i") - F.col("first") + 1).alias("m"))
    both = starts.unionByName(ends).distinct()
    # neighbouring rows are neighbouring lines only if their places agree
    marks = placed.select("doc", F.col("i").alias("j"), F.col("pos").alias("end"))
    near = both.join(marks, (both.doc == marks.doc) & (both.i + both.m - 1 == marks.j)).where(F.col("end") - both.pos + 1 == both.m)
    return near.select(both.doc, both.pos, "m").distinct()


def doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks by twice as many lines, of the suffixes that are still not alone."""
    behind = ranks.select("doc", (F.col("pos") - step).alias("pos"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("place").alias("next"))
    pairs = ranks.join(behind, _AT)
    group, finer = ["h1", "h2", "place"], ["h1", "h2", "place", "g1", "g2", "next"]
    counts = pairs.groupBy(*finer).agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.partitionBy(*group).orderBy("g1", "g2", "next").rowsBetween(Window.unboundedPreceding, -1)
    refined = counts.withColumn("finer", F.col("place") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).where("n > 1").drop("n")
    return pairs.join(refined, finer).select(*_AT, "h1", "h2", F.col("finer").alias("place"))


def suffix_ranks(lines: DataFrame, longest: int) -> list[DataFrame]:
    """Ranks by 1, 2, 4, ... lines, up to the power of two within ``longest``."""
    ranks = materialize(lines.select(*_AT, "h1", "h2", F.lit(0).cast("bigint").alias("place")))
    levels, step = [ranks], 1
    while 2 * step <= longest:
        ranks = released(doubled(ranks, step))
        levels.append(ranks)
        step *= 2
    return levels


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, chosen: DataFrame | None = None) -> DataFrame:
    """Later copies of repeated runs: doc, pos, m lines, the original's ``from_doc`` and ``from_pos``."""
    lines = released(repeated(line_ids(docs, chosen), ["h1", "h2"], "n").drop("n"))
    runs = released(windows(lines, min_words))
    longest = runs.agg(F.max("m")).first()[0] or 0
    keyed = None
    for j, ranks in enumerate(suffix_ranks(lines, longest)):
        here = runs.where((F.col("m") >= 2**j) & (F.col("m") < 2 ** (j + 1)))
        head = ranks.select(*_AT, "h1", "h2", "place")
        tail = ranks.select("doc", F.col("pos").alias("end"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("place").alias("next"))
        at_head = here.withColumn("end", F.col("pos") + F.col("m") - 2**j).join(head, _AT)
        # a run of exactly 2**j lines is its own tail
        part = at_head.join(tail, ["doc", "end"]).select(*_AT, "m", "h1", "h2", "place", "g1", "g2", "next")
        keyed = part if keyed is None else keyed.unionByName(part)
    keyed = released(keyed)
    interval = ["m", "h1", "h2", "place", "g1", "g2", "next"]
    first = keyed.groupBy(*interval).agg(F.min(F.struct(*_AT)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return keyed.join(first, interval).where(F.struct(*_AT) > F.col("first")).select(
        *_AT, "m", F.col("first.doc").alias("from_doc"), F.col("first.pos").alias("from_pos")
    )


def removed_spans(runs: DataFrame) -> DataFrame:
    """Maximal runs of deleted lines: doc and an array of (first, last), as many as the document has gaps."""
    in_doc = Window.partitionBy("doc").orderBy("pos", "m")
    reach = F.max(F.col("pos") + F.col("m")).over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    breaks = runs.select("doc", "pos", "m").distinct().withColumn("new", F.when(F.col("pos") <= reach, 0).otherwise(1))
    islands = breaks.withColumn("island", F.sum("new").over(in_doc))
    spans = islands.groupBy("doc", "island").agg(F.min("pos").alias("first"), F.max(F.col("pos") + F.col("m") - 1).alias("last"))
    return spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, info: str = "line_dedup") -> DataFrame:
    """``docs`` with later copies deleted from ``text``, and a struct ``info`` of n_lines, n_removed and removed spans.

    ``info`` gets underscores in front if ``docs`` has such a column.
    """
    chosen = smallest_texts(docs)
    spans = released(removed_spans(repeated_runs(docs, min_words, chosen)))
    digest = F.sha2(F.col("text").cast("string"), 256)
    # which text the spans are of, where an id has several rows
    of = F.lit(None).cast("string").alias("of")
    spans = spans.select("*", of) if chosen is None else spans.join(chosen.select("doc", digest.alias("of")), "doc", "left")
    key, found, info = unused("doc", docs.columns), unused("spans", docs.columns), unused(info, docs.columns)
    text_of = unused("of", docs.columns)
    marked = sized(spans.select(F.col("doc").alias(key), F.col("spans").alias(found), F.col("of").alias(text_of)), 160, found, 32)
    mine = F.col(text_of).isNull() | (F.col(text_of) == F.sha2(docs["text"].cast("string"), 256))
    joined = docs.join(marked, (docs["doc_id"].cast("bigint") == F.col(key)) & mine, "left")
    lines = _lines(F.col("text").cast("string"))
    # the text between removed spans; spans are sorted and apart
    kept = F.filter(lines, lambda x, i: ~F.exists(found, lambda s: (i >= s["first"]) & (i <= s["last"])))
    text = F.when(F.col(found).isNull(), F.col("text").cast("string")).otherwise(F.array_join(kept, "\n"))
    removed = F.coalesce(F.aggregate(found, F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"] + 1), F.lit(0))
    told = F.struct(
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        removed.cast("bigint").alias("n_removed"), F.col(found).alias("spans"),
    )
    return joined.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns], told.alias(info))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later copies; a document is dropped only if nothing but copies was in it."""
    info = unused("line_dedup", docs.columns)
    out = dedup_lines(docs, min_words, info)
    left = F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    columns = [F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.where(left | (F.col(info)["n_removed"] == 0)).select(*columns)
