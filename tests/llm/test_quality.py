"""Quality rules against a plain count of each text."""

import re
from fractions import Fraction

from pyspark.sql import functions as F

from engrama.llm import quality

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def counted(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + j for found in places.values() if len(found) > 1 for i in found for j in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def check(rows):
    for r in rows:
        want = counted(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        n, repeated = want[0], want[4]
        assert r.base_failed == (n < 10 or Fraction(100 * repeated) > 20 * n)
        assert not (r.kept and r.base_failed)


def test_counts_of_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = quality.judge(docs).join(docs.select("doc_id", "text"), "doc_id")
    rows = got.collect()
    assert len(rows) == docs.count()
    check(rows)


def test_odd_texts(spark):
    texts = [
        None, "", " \n\t ", "a", "a b c d e", "a b c d e a b c d e", "x x x x x x x x", "A b c d e a b c d e", "é日本 \U0001F600 \x00 #", "   x",
        "l\nl\n\nl \nm", "word " * 30_000, " ".join(str(i % 500) for i in range(3000)), "\x0bq\x0cq\r\n q", "a b c d e f a b c d e f",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "p q r"), (None, None), (3, "again")]
    docs = spark.createDataFrame(rows, SCHEMA)
    keyed = docs.withColumns({"words": F.lit(1), "order": F.lit(2), "one": F.lit(3), "kept": F.lit("clash")})
    got = quality.judge(keyed.where("doc_id is not null and doc_id <> 3")).join(docs, "doc_id").collect()
    assert len(got) == len(texts) - 1
    check(got)
    assert quality.judge(keyed).count() == len(rows)
    assert quality.judge(keyed.limit(0)).count() == 0
    assert quality.keep_good(keyed).columns == keyed.columns


def test_rules_decide(spark):
    prose = "the cat sat on a mat and " + " ".join(f"word{i}" for i in range(60))
    cases = {
        1: (prose, True, []),
        2: ("few words", False, ["few_words"]),
        3: ("one two three four five " * 4, False, ["repeated_words"]),
        4: (" ".join(f"the{i}### of{i}" for i in range(10)), False, ["symbols"]),
        5: (" ".join(f"zq{i}" for i in range(60)), False, ["stop_words"]),
        6: ("\n".join(["menu"] * 6 + [f"the line of {i}" for i in range(8)]), False, ["repeated_lines"]),
        7: ("\n".join(f"- the item {i}" for i in range(9)), False, ["listed_lines"]),
        8: ("\n".join(f"the story of {i}..." for i in range(9)), False, ["cut_lines"]),
        9: (" ".join(f"日本語の文章です{i}" for i in range(60)), True, []),
        10: (" ".join(f"x{i:020d}" for i in range(12)), False, ["long_words"]),
        11: (" ".join("abcdefghijkl"), False, ["short_words"]),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in cases.items()], SCHEMA)
    for r in quality.judge(docs).collect():
        assert (r.kept, r.failed_rules) == cases[r.doc_id][1:], r
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {i for i, c in cases.items() if c[1]}


def test_no_python_no_shuffle(spark):
    plan = quality.judge(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
