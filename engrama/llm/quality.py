"""Quality rules: a table of thresholds compiled into one projection of measured ratios.

``measures`` adds counts of words, symbols, stop words, lines and repeats to every
text.  ``compile_rules`` turns a table of rules - one count over another, with a least
and a greatest ratio - into columns of a single projection: a verdict and the names
of the rules that failed.  Ratios are compared by multiplying out, so that no rounding
decides.  All of it is DataFrame expressions; no row meets another and nothing is shuffled.

Words are runs of characters other than space, \\t, \\n, \\v, \\f and \\r.  A repeated
word is covered by a five-word window that stands twice or more in its text, the first
place included; windows are found by hash and confirmed word by word.

Results for odd input: a null or empty text has no words, fails ``base`` and isn't kept;
rows of one id, or of none, are judged row by row; other columns are left out.  A text
costs memory in proportion to its own length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that for was on are with as at be this have from or by not but what all were when your can an "
    "der die das und ist nicht mit ein eine zu den von auf im sich des dem er es sie für "
    "le la les de des et un une est que qui dans pour pas au sur du ne ce il en "
    "el los las y del se por con para una su lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * count / per <= most``, of rows that keep the rules in ``when``."""

    name: str
    count: str
    per: str
    least: float | None = None
    most: float | None = None
    when: tuple[Rule, ...] = ()


BASE_RULES = (
    Rule("few_words", "n_words", "one", least=1000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=20),
)
RULES = (
    Rule("short_words", "word_chars", "n_words", least=200),
    Rule("long_words", "word_chars", "n_words", most=1500),
    Rule("symbols", "n_symbols", "n_words", most=20),
    # the stop words are of languages in Latin letters, mostly one byte each; short texts may hold none
    Rule("stop_words", "n_stop_words", "n_words", least=2, when=(
        Rule("latin", "n_bytes", "n_chars", most=150), Rule("long_enough", "n_words", "one", least=5000),
    )),
    # a line above and below a short text, the same twice, is no fault
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=30, when=(Rule("lines", "n_lines", "one", least=1000),)),
    Rule("listed_lines", "n_bullet_lines", "n_lines", most=90),
    Rule("cut_lines", "n_ellipsis_lines", "n_lines", most=30),
)


def _repeated_places(words: Column, order: Column, width: int) -> Column:
    """Places, ascending from 1, of the windows found twice, from the (hash, place) pairs in order."""
    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (F.slice(words, a["i"], width) == F.slice(words, b["i"], width)), F.lit(False))

    found = F.filter(order, lambda x, k: same(x, F.get(order, k + 1)) | same(x, F.get(order, k - 1)))
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _covered(places: Column, width: int) -> Column:
    """Words covered by windows at these places."""
    reach = lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - p, F.lit(width)))
    return F.aggregate(F.transform(places, reach), F.lit(0), lambda total, n: total + n)


def measures(docs: DataFrame, stop_words: Sequence[str] = STOP_WORDS, window: int = WINDOW, carry: str = "doc_id") -> DataFrame:
    """The column ``carry`` and the counts that rules may name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed != "", F.split(trimmed, BLANK_RUN)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    split = docs.select(
        F.col(carry), text.alias("text"), words.alias("words"), lines.alias("lines"),
    ).select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("marks"))
    n_windows = F.greatest(F.size("words") - (window - 1), F.lit(0))
    at = [F.lit(j) for j in range(window)]
    hashes = F.transform(
        F.slice("marks", F.lit(1), n_windows), lambda m, i: F.xxhash64(*[F.get("marks", i + j) for j in at])
    )
    split = split.select("*", hashes.alias("hashes"))
    # only texts with a repeated window are sorted
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    order = F.when(repeats, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i")))))
    # a lambda evaluates what it names for every element, so what it names is a column made before
    split = split.select("*", order.alias("order"))
    split = split.select("*", _repeated_places(F.col("words"), F.col("order"), window).alias("places"))
    long = lambda c: c.cast("bigint")
    # a word counts in lower case, capitalized or in capitals
    stops = sorted({form for w in stop_words for form in (w, w.capitalize(), w.upper())})
    bullet = lambda line: F.btrim(line, F.lit(BLANKS)).rlike(r"^[-*•●‣]")
    cut = lambda line: F.btrim(line, F.lit(BLANKS)).rlike(r"(\.\.\.|…)$")
    return split.select(
        carry,
        long(F.size("words")).alias("n_words"),
        long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.regexp_count("text", F.lit(f"[{SYMBOLS}]"))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(F.coalesce(_covered(F.col("places"), window), F.lit(0))).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"),
        long(F.size(F.filter("words", lambda w: w.isin(stops)))).alias("n_stop_words"),
        long(F.length("text")).alias("n_chars"),
        long(F.octet_length("text")).alias("n_bytes"),
        long(F.size(F.filter("lines", bullet))).alias("n_bullet_lines"),
        long(F.size(F.filter("lines", cut))).alias("n_ellipsis_lines"),
        F.lit(1).cast("bigint").alias("one"),
    )


def broken(rule: Rule) -> Column:
    """Whether a row breaks the rule; a ratio over nothing breaks no upper bound."""
    bounds = []
    if rule.least is not None:
        bounds.append(100 * F.col(rule.count) < F.lit(rule.least) * F.col(rule.per))
    if rule.most is not None:
        bounds.append(100 * F.col(rule.count) > F.lit(rule.most) * F.col(rule.per))
    out = reduce(or_, bounds, F.lit(False))
    return reduce(and_, [~broken(r) for r in rule.when], out)


def compile_rules(base: Sequence[Rule] = BASE_RULES, rules: Sequence[Rule] = RULES) -> list[Column]:
    """base_failed, kept and failed_rules, as columns of one projection."""
    fails = [F.when(broken(r), F.lit(r.name)) for r in (*base, *rules)]
    base_ok = reduce(and_, [~broken(r) for r in base], F.lit(True))
    return [
        (~base_ok).alias("base_failed"),
        reduce(and_, [~broken(r) for r in rules], base_ok).alias("kept"),
        F.array_compact(F.array(*fails)).alias("failed_rules"),
    ]


def judge(docs: DataFrame, base: Sequence[Rule] = BASE_RULES, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """Every row of ``docs``: its doc_id, counts, base_failed, kept and the rules it broke."""
    return measures(docs, **options).select("*", *compile_rules(base, rules)).drop("one")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return measures(rows, carry="row", **options).select("row", *compile_rules()).where("kept").select("row.*")
