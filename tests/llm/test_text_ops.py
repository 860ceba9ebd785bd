"""Deduplication, decontamination, languages and toxicity against brute force and held-out rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from engrama.llm import decontam, hashing, lang_id, line_dedup, near_dup, toxicity

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
WORDS = "ab cd ef gh ij kl mn op qr st uv wx".split()
ODD = [
    (1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (4, "one two", "x"), (4, "one two", "x"), (5, "One  TWO\n", "y"),
    (None, "one two", "x"), (None, None, None), (6, "é日本 \U0001F600 \x00 end", None), (7, "word " * 30_000, "x"), (8, "word " * 30_000, "x"),
]
CLASH = ["band", "component", "rep", "doc", "pos", "spans", "line_dedup", "_id", "term", "score", "lang_pred"]


def odd(spark):
    """Nulls, blanks, long and repeated texts, and columns named like inner ones."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})


def nothing(spark):
    return odd(spark).limit(0)


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- near duplicates ---------------------------------------------------------


def brute_components(rows, threshold=85):
    sets = {}
    for doc_id, text in rows:
        w = [x for x in bytes_words(text)]
        sets[doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        inter, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if inter and 100 * inter >= threshold * union:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def bytes_words(text):
    return (text or "").encode().lower().split()


def near_copies(seed=3):
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        words = [rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(rng.choice([4, 5, 6, 40, 120, 400]))]
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 25))):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(1000))
            rows.append((len(rows) * 3 % 97 + 100 * base, rng.choice([" ", "\n", "  "]).join(copy)))
    return list(dict(rows).items())


def test_near_duplicates_agree_with_brute_force(spark):
    rows = near_copies() + [(r.doc_id + 10_000, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(want) - 20


def test_star_of_near_copies_around_one_text(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for i in range(60):  # close to the base, mostly too far from each other
        copy = list(base)
        for j in rng.sample(range(200), 3):
            copy[j] = f"x{i}-{j}"
        rows.append((i, " ".join(copy)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: c for d, (_, c) in brute_components(rows).items()}


def test_pipeline_drops_near_copies_from_80_percent_on(spark):
    rng = random.Random(8)
    rows = near_copies()
    for base in range(30):  # 196 shingles; each run of new words away from others spoils their number and four
        words = [f"b{base}w{i}" for i in range(200)]
        rows.append((10_000 + 10 * base, " ".join(words)))
        at = rng.randrange(20, 150)
        new = rng.randrange(13, 20)
        rows.append((10_001 + 10 * base, " ".join(words[:at] + [f"n{i}" for i in range(new)] + words[at + new:])))
    assert near_dup.bands_for(85) == 25 and (1 - 0.8**5) ** near_dup.bands_for(80) < 1e-6
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()}
    want, at_85 = ({d for d, (_, c) in brute_components(rows, t).items() if d == c} for t in (80, 85))
    assert kept == want and len(at_85 - want) > 5


def test_near_duplicates_of_odd_rows(spark):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(odd(spark)).collect()}
    assert got[(1, 0)] == (1, True) and got[(2, 0)] == (2, True) and got[(3, 0)] == (3, True)
    assert got[(4, 1)] == (4, True) and got[(5, 1)] == (4, False)
    assert got[(None, 1)] == (None, True) and got[(7, 1)] == (7, True) and got[(8, 1)] == (7, False)
    assert near_dup.near_duplicates(nothing(spark)).count() == 0
    kept = near_dup.drop_near_duplicates(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD) - 4  # one of each group of copies, whatever their ids


def test_hashing_follows_the_word_rule():
    texts = ["A b", "a  B\n", "a b", "", None, "Ä b", "ä b"]
    a, b, c, d, e, f, g = list(hashing.word_hashes(texts))
    assert (a == b).all() and len(c) == 1 and len(d) == len(e) == 0 and f[0] != g[0]
    assert len(hashing.shingle_set(a)) == 1 and len(hashing.shingle_set(d)) == 0


# --- repeated lines ----------------------------------------------------------


def brute_lines(rows, min_words):
    """Delete every line that lies in a run with enough words that occurs earlier."""
    lines = {d: t.split("\n") for d, t in rows if d is not None and t is not None}
    seen, runs = set(), []
    for d in sorted(lines):
        for i in range(len(lines[d])):
            words = 0
            for j in range(i, len(lines[d])):
                words += len(lines[d][j].split())
                runs.append((d, i, j, words, tuple(lines[d][i:j + 1])))
    gone = set()
    for d, i, j, words, run in runs:  # in the order of (document, line)
        if words >= min_words and run in seen:
            gone.update((d, x) for x in range(i, j + 1))
        seen.add(run)
    return {d: "\n".join(x for i, x in enumerate(lines[d]) if (d, i) not in gone) for d in lines}


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_agrees_with_brute_force(spark, seed):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 5, 9]))) for _ in range(14)]
    runs = [[rng.choice(stock) for _ in range(rng.randrange(2, 9))] for _ in range(4)]
    rows = []
    for d in range(30):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice(runs) if rng.random() < 0.6 else [f"own {d} {rng.random()}"]
        rows.append((d, "\n".join(text)))
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words=12)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == brute_lines(rows, 12)
    assert any(got[d] != t for d, t in rows)


def test_line_dedup_of_odd_rows(spark):
    out = line_dedup.dedup_lines(odd(spark), min_words=2)
    assert out.columns == [*odd(spark).columns, "_line_dedup"] and out.count() == len(ODD)
    got = {r.doc_id: r.text for r in out.where("doc_id is not null").collect()}
    assert got[1] is None and got[2] == "" and got[4] == "one two" and got[7] == "word " * 30_000 and got[8] == ""
    assert sorted(x.text or "" for x in out.where("doc_id is null").collect()) == ["", "one two"]
    kept = line_dedup.drop_repeated_lines(odd(spark), 2)
    assert kept.columns == odd(spark).columns and kept.where("doc_id = 8").count() == 0 and kept.count() == len(ODD) - 1
    assert line_dedup.dedup_lines(nothing(spark)).count() == 0


def test_an_id_with_two_texts_loses_no_unique_line(spark):
    rows = [(1, "A\nZ"), (2, "A\nZ"), (2, "U\nV"), (3, "U\nW"), (4, "A\nB"), (4, "A\nB")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("of", F.lit("clash"))
    out = line_dedup.dedup_lines(docs, min_words=1)
    assert sorted((r.doc_id, r.text, r["_line_dedup"]["n_removed"] if "_line_dedup" in out.columns else r.line_dedup.n_removed) for r in out.collect()) == [
        (1, "A\nZ", 0), (2, "", 2), (2, "U\nV", 0), (3, "U\nW", 0), (4, "B", 1), (4, "B", 1)]


def test_one_of_equal_texts_stays_whatever_their_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (3, text), (3, text), (4, text), (5, text + " eight"), (None, "alone here now"), (None, ""), (None, ""), (6, None), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("key", "digest", "id", "_gone")})
    got = sorted(((r.doc_id, r.text) for r in near_dup.drop_near_duplicates(docs, 80).collect()), key=str)
    assert got == sorted([(3, text), (5, text + " eight"), (None, "alone here now"), (None, ""), (None, ""), (6, None), (6, None)], key=str)
    many = near_dup.drop_near_duplicates(docs.where("doc_id is null"), 80).collect()
    assert sorted(r.text for r in many) == ["", "", "alone here now", text]


# --- bundles of trigrams, quotations ------------------------------------------


def test_bundles_agree_with_one_trigram_at_a_time():
    rng = random.Random(5)
    wide = "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(3000))
    texts = ["The cat sat.", "a", "", None, "ÄÖ ü 12 ß", wide, "x " * 500]
    got = dict(lang_id.bundles(texts))
    for i, text in enumerate(texts):
        letters = lang_id._letters(text) if text else np.zeros(0, int)
        if not len(letters) or not letters.any():
            assert i not in got
            continue
        letters = np.pad(letters, (int(letters[0] != 0), int(letters[-1] != 0)))
        vector = {x: lang_id.letter_vectors(np.array([x]))[0] for x in set(letters.tolist())}
        want = sum(np.roll(vector[a], 2) * np.roll(vector[b], 1) * vector[c] for a, b, c in zip(letters[:-2].tolist(), letters[1:-1].tolist(), letters[2:].tolist()))
        assert np.allclose(got[i], want)


def test_quotations_end():
    quoted = toxicity.Matcher._quoted
    assert quoted('a 5" pipe and you are an idiot'.split()) == [False] * 8
    assert quoted('he said "you idiot" to me'.split()) == [False, False, True, True, False, False]
    open_mark = ['"so'] + ["word"] * 200 + ['"one', 'two"', "end"]
    assert quoted(open_mark) == [False] * 201 + [True, True, False]


# --- benchmark overlaps ------------------------------------------------------


def test_masks_bear_the_substitutions_they_promise():
    for length in range(8, decontam.WINDOW + 1):
        for bad in itertools.combinations(range(length), decontam.tolerance(length)):
            assert any(
                all(s + i not in bad for i in m) for m in decontam.MASKS for s in range(length - m[-1])
            ), (length, bad)
    assert decontam.tolerance(decontam.WINDOW) == 3


def test_overlaps_with_substitutions(spark):
    rng = random.Random(1)
    item = [f"t{i}" for i in range(30)]
    short, tiny = "p q r s t u", "of the"
    rows, want = [], {}
    for d in range(120):
        words = [rng.choice(WORDS) for _ in range(50)]
        n = d % 6
        part = item[7:23]
        for i in rng.sample(range(16), n):
            part[i] = "zz"
        rows.append((d, " ".join(words[:20] + part + words[20:])))
        want[d] = n <= 3
    rows += [(200, f"x {short} y"), (201, "p q r S t x"), (202, "of the end of the road"), (203, None), (204, "")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, short), (3, tiny), (4, None), (5, "")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontam.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert {d: got[d].contaminated for d in want} == want
    assert got[200].items == [2] and not any(got[d].contaminated for d in (201, 202, 203, 204))


def test_seeds_joined_by_a_shuffle_find_the_same(spark, monkeypatch):
    docs, bench = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = {r.doc_id: r.items for r in decontam.contamination(docs, bench).collect()}
    # nothing broadcast, a bitmap that turns few seeds away, one item in a group
    for name, value in {"BROADCAST_BYTES": 0, "LEAST_BITS": 1 << 16, "MOST_BITS": 1 << 16, "GROUP_ITEMS": 1}.items():
        monkeypatch.setattr(decontam, name, value)
    assert {r.doc_id: r.items for r in decontam.contamination(docs, bench).collect()} == whole
    items = {r.item_id: r.text for r in bench.collect()}
    for r in docs.collect():  # whole items in a text are always found
        assert {i for i, t in items.items() if t in r.text} <= set(whole[r.doc_id])


def plain_overlap(words, item):
    """Every diagonal on which some mask's words agree, one after another."""
    masks = [m for m in decontam.MASKS if m[-1] < len(item)] or [decontam.SHORT_MASK]
    size, best = min(len(item), decontam.WINDOW), 0
    for shift in range(-len(item) + 1, len(words)):
        same = [words[i + shift] == w if 0 <= i + shift < len(words) else None for i, w in enumerate(item)]
        seeded = any(all(p + i < len(item) and same[p + i] for i in m) for m in masks for p in range(len(item)))
        windows = [same[i:i + size] for i in range(len(item) - size + 1)]
        if seeded and any(None not in w and sum(w) >= size - decontam.tolerance(size) for w in windows):
            best = max(best, sum(x is True for x in same))
    return best


def test_overlap_against_every_diagonal():
    rng = random.Random(3)
    for n in range(150):
        item = [rng.choice("abc"[:1 + n % 3]) if n % 2 else f"w{i}" for i in range(rng.randint(5, 40))]
        words = [rng.choice("abc") for _ in range(30)] + [w if rng.random() < 0.85 else "z" for w in item] + item[3:]
        words = words[rng.randint(0, 35):]
        hashed = list(hashing.word_hashes([" ".join(words), " ".join(item)]))
        with np.errstate(over="ignore"):
            assert decontam.overlap(*hashed) == plain_overlap(words, item), (words, item)


def test_a_word_repeated_in_text_and_item_costs_no_pairs():
    words, item = hashing.word_hashes(["same " * 30_000, "same " * 400])
    with np.errstate(over="ignore"):
        assert len(decontam.shifts(words, item)) == 30_000 + 400 - 15  # all that a mask of eight words fits on
        assert decontam.overlap(words, item) == 400


def test_decontamination_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "word " * 6), (None, "one two")], "item_id bigint, text string")
    out = decontam.drop_contaminated(odd(spark), bench)
    assert out.columns == odd(spark).columns and out.count() == len(ODD) - 2
    assert decontam.contamination(nothing(spark), bench).count() == 0
    assert decontam.contamination(odd(spark), bench.limit(0)).where("contaminated").count() == 0


# --- languages ---------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF)
    scored = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in scored) / len(scored) > 0.97 and len(scored) > 150


def test_languages_of_odd_rows(spark):
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(odd(spark)).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "x"
    assert lang_id.identify(nothing(spark)).count() == 0
    unlabelled = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.identify(unlabelled).collect()} == {"und"}
    kept = lang_id.keep_known_languages(odd(spark))
    assert kept.columns == odd(spark).columns and kept.where("doc_id in (1, 2, 3)").count() == 0
    assert lang_id.keep_known_languages(unlabelled).where("doc_id = 4").count() == 2


# --- toxicity ----------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_matches_what_edit_distance_does():
    rng = random.Random(2)
    terms = {("abcab", False): 1.0, ("bcabca", False): 2.0, ("acb", False): 3.0}
    auto = toxicity.Automaton(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        want = [(-edits(word, t), w) for (t, _), w in terms.items() if edits(word, t) == 0 or (edits(word, t) == 1 and len(t) >= 5)]
        got = auto.match(word)
        assert (got and (-got[1], got[0])) == (max(want) if want else None), word


def test_stems_match_any_ending():
    auto = toxicity.Automaton({("stemm", True): 1.0, ("abc", True): 2.0})
    assert auto.match("stemmata") == (1.0, 0, 1) and auto.match("stxmmer") == (1.0, 1, 1)
    assert auto.match("abcde") == (2.0, 0, 1) and auto.match("abd") is None and auto.match("") is None


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.toxicity(documents(spark, SF), labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in scored)
    assert right / len(scored) > 0.9 and all(0 <= r.score <= 1 for r in scored)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (4, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(odd(spark), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.toxicity(odd(spark), labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(nothing(spark), labels).count() == 0
