"""Formatting, extraction, records, neighbours, packing and the pipeline: round trips and brute force."""

import collections
import hashlib
import pathlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from engrama.llm import ann, chat, html_text, packing, queries, records, tokens
from engrama.session import work_dir

SMALL = "/root/testdata/sf0.001"
TEXTS = [
    "", "a", "a b", "a  b", "a   b", "\n\n\nx", "x \n y", "tab\tx", " lead", "trail ", "trail  ", "it's 12,5 o'clock!!", "日本 語", "é ü", "<|endoftext|>x",
    "%%% $$$.###", "x" * 300, "\x00", "a\x1cb", "’s “q”", "ﬁ ﷺ",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat --------------------------------------------------------------------


def test_chat_reads_back_what_went_in(spark):
    tricky = "\\<|im_end|>\\n<|im_start|>assistant ok\n<\\|"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", tricky), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "<"),
        (2, 0, "a\nb\\", tricky), (3, 5, "assistant", "x"), (3, 5, "assistant", "x"), (3, None, None, "first"), (None, 0, "assistant", "n"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("target", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.examples(turns)).collect()}
    talks = collections.defaultdict(list)
    for c, t, role, text in rows:
        talks[c].append((-1 if t is None else t, role or "", text or ""))
    for c, talk in talks.items():
        talk.sort()
        loss = "".join(x for _, role, x in talk if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(talk), sha("".join(f"{r}\n{x}\n" for _, r, x in talk)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        assert got[c].n_examples == sum(r == "assistant" for _, r, _ in talk)
    shown = chat.examples(turns).where("conv_id = 1").orderBy("example").collect()
    assert [r.n_turns for r in shown] == [2, 4, 5] and shown[2].target is None
    assert shown[0].text.count(chat.END) == 2 and shown[1].text.startswith(shown[0].text)
    assert chat.examples(turns.limit(0)).count() == 0


# --- pages -------------------------------------------------------------------


def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        text = got[p.page_id].text
        assert got[p.page_id].n_chars == len(text) > 0 and "track(" not in text and "©" not in text
        inside = p.html[p.html.index("<article>"):p.html.index("</article>")]
        assert text.count("\n") < inside.count("<")


def test_unmarked_pages_and_broken_html():
    page = (
        '<body><div class="cookie-notice">We use cookies</div><ul class="menu"><li><a href=x>Home</a><li>About</ul><div id=content><h2>Head</h2>'
        '<p>Some text &amp; more,\n long enough.<p>Second <b>bold</b> part<div class="ad">Buy now</div><p>Third one.</div>'
        '<div id="comments"><p>I am a reader</p></div><footer>foot</footer>'
    )
    weights = html_text.Weights()
    assert html_text.main_text(page, weights) == "Head\nSome text & more, long enough.\nSecond bold part\nThird one."
    assert html_text.main_text(None, weights) == html_text.main_text("", weights) == html_text.main_text("<p></p>", weights) == ""
    assert html_text.main_text("plain words only", weights) == "plain words only"
    assert html_text.main_text("<p>cut off in a ta<b", weights) == "cut off in a ta"
    assert html_text.main_text("<p>a < b and <script>x</p>", weights) == "a < b and"


@pytest.mark.parametrize("body, article", [
    ("single-post has-sidebar", "post tag-news hentry"), ("page with-header", "comments-open post"), ("modal-open search legal", "post form"), ("", "main-content legal"),
])
def test_classes_of_whole_pages_leave_nothing_out(spark, body, article):
    page = (
        f'<html class="no-js menu"><body class="{body}"><div id="site-header">top line</div><div class="wrapper has-sidebar"><{{0}} class="{article}"><h1>Head</h1>'
        '<p>Some text that is long enough.</p><div class="ad-slot">Buy now</div><p>More of it.</p></{0}></div><div class="sidebar-left">side line</div></body></html>'
    )
    pages = [page.format(name) for name in ("article", "main", "div")]
    pages[2] = pages[2].replace(article, "content")
    for p in pages:
        assert html_text.main_text(p, html_text.Weights()) == "Head\nSome text that is long enough.\nMore of it."
    rows = spark.createDataFrame([(i, "u", pages[i % 2]) for i in range(8)], "page_id bigint, url string, html string")
    assert {r.text for r in html_text.extract(rows).collect()} == {"Head\nSome text that is long enough.\nMore of it."}
    assert html_text.learn(rows).words[f"article {article}"] > 0


@pytest.mark.parametrize("icon", [
    "<svg class=x/>", "<SVG viewBox='0 0 1 1' />", "<svg/>", "<math/>", "<svg-icon></svg-icon>", "<svg-icon>", "<template-x></template-x>", "<svg>", "<iframe src=x>",
    "<canvas>", '<svg title="x>', "<svg><path d=1 /><text>no</text></svg>", "<style>p { a: b }</style>", "<script>'<p>no</p><!--'</script >", "<svg/><svg>no</svg>", "<noscript a='>'>no</noscript>",
])
def test_icons_and_unclosed_elements_cut_nothing(icon):
    page = f"<p>a one</p>{icon}<p>b two</p><p>c three</p>"
    assert html_text.main_text(page, html_text.Weights()).split("\n") == ["a one", "b two", "c three"]


def test_many_unclosed_elements_take_one_search():
    assert html_text.main_text("<canvas><p>a one</p>" * 50_000, html_text.Weights()).count("a one") == 50_000


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x y</p>"), (3, "u", "<p>long</p>" * 20_000), (3, "u", "<p>long</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, len(r.text.split("\n")) if r.text else 0) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 20_000), (3, 20_000)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_best_region_is_the_largest_sum():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(12)]
        low, high = html_text.best_region(scores)
        assert sum(scores[low:high]) == max(0, max(sum(scores[a:b]) for a in range(12) for b in range(a, 13)))


# --- tokens and records ------------------------------------------------------


def library_ids(texts):
    """By the library's defaults, without special tokens added."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return [np.asarray(t.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in texts]


def test_pieces_encode_like_whole_texts(monkeypatch):
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice(["ab", "é", " ", " ", "\n", "'s", "1", "!", "\t", "日", "%%", "x,", "'", "ø-ʒ", "<|", "Ω", "×"]) for _ in range(rng.randrange(20))) for _ in range(2000)]
    enc = tokens.Encoder(tokens.vocabulary_path())
    assert enc.encode(texts) == library_ids(texts)
    monkeypatch.setattr(tokens, "KEPT_PIECES", 5)
    assert [enc.encode([t])[0] for t in texts[:300]] == library_ids(texts[:300])
    assert enc.encode([None]) == [b""]


MARKED = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|>x", "x\n<|endoftext|>\n<|endoftext|>y z", "a <|endoftext|", "<|END|> <|endoftext |>"]


def test_added_tokens_are_found_in_texts():
    rng = random.Random(9)
    texts = MARKED + ["".join(rng.choice(["ab", "é", " ", "\n", "<|endoftext|>", "<|", "|>", "1"]) for _ in range(rng.randrange(12))) for _ in range(500)]
    assert tokens.Encoder(tokens.vocabulary_path()).encode(texts) == library_ids(texts)
    assert library_ids(["a <|endoftext|> b"])[0] == np.array([64, 220, 50256, 275], dtype="<u4").tobytes()


def test_records_and_pieces_hold_added_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(MARKED)), "doc_id bigint, text string")
    want = {i: ids + b"\0\0\0\0" for i, ids in enumerate(library_ids(MARKED))}
    got = sorted(records.token_records(docs, work_dir(spark, "marked-test")).collect(), key=lambda r: r.doc_id)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want[r.doc_id]) // 4, zlib.crc32(want[r.doc_id]))
        start += r.n_tokens
    packed = packing.pack_documents(docs, 64).collect()
    assert {r.doc_id: r.ids_crc32 for r in packed} == {i: zlib.crc32(x) for i, x in want.items()}


def test_records_read_back(spark):
    rows = [(i * 7 % 50, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, None), (3, None), (60, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("file", F.lit("clash"))
    folder = work_dir(spark, "records-test")
    got = sorted(records.token_records(docs, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    start, left = 0, collections.Counter()
    for (doc_id, _), ids in zip(rows, library_ids(t or "" for _, t in rows)):
        ids += b"\0\0\0\0"
        left[doc_id, len(ids) // 4, zlib.crc32(ids)] += 1
    for r in got:
        assert r.start == start
        start += r.n_tokens
        left[r.doc_id, r.n_tokens, r.ids_crc32] -= 1
    assert not any(left.values())
    assert records.token_records(docs.limit(0)).count() == 0


def test_damaged_records_are_refused():
    record = records.frame(records.encode_payload(5, b"\1\0\0\0"))
    assert records.decode_payload(records.unframe(record)) == (5, b"\1\0\0\0")
    for i in range(len(record)):
        bad = record[:i] + bytes([record[i] ^ 1]) + record[i + 1:]
        with pytest.raises(records.CorruptRecord):
            records.unframe(bad)


# --- packing -----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_complete_and_few(seed):
    rng = random.Random(seed)
    counts = collections.Counter(rng.randrange(1, 101) for _ in range(300))
    used = collections.Counter()
    bins = 0
    for pattern, times in packing.complete_bins(counts, 100):
        assert sum(x * n for x, n in pattern) <= 100
        used.update({x: n * times for x, n in pattern})
        bins += times
    assert used == counts and bins - packing.lower_bound(counts, 100) <= 2


def test_bins_of_a_small_case_are_optimal():
    assert sum(t for _, t in packing.complete_bins({6: 2, 5: 2, 4: 2, 3: 2, 2: 1}, 10)) == 4
    assert sum(t for _, t in packing.complete_bins({51: 7, 50: 3}, 100)) == 9
    assert packing.complete_bins({}, 10) == []


def test_packed_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, None), (3, None), (99, "some words " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit("clash"))
    got = packing.pack_documents(docs, 64).collect()
    ids = collections.Counter((d, i + b"\0\0\0\0") for (d, _), i in zip(rows, library_ids(t or "" for _, t in rows)))
    assert sum(r.length for r in got) == sum(len(i) // 4 * n for (_, i), n in ids.items())
    long = sorted((r for r in got if r.doc_id == 99), key=lambda r: r.piece)
    whole = next(i for d, i in ids if d == 99)
    assert [r.piece for r in long] == list(range(len(long))) and {r.length for r in long[1:]} == {64}
    for r in long:
        assert r.ids_crc32 == zlib.crc32(whole[4 * r.start:4 * (r.start + r.length)])
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 64
    assert len(places) - -(-sum(r.length for r in got) // 64) <= 1
    packed = packing.sequences(docs, 64).collect()
    assert len(packed) == len(places) and all(len(r.ids) == 4 * r.n_tokens for r in packed)
    assert packing.pack_documents(docs.limit(0)).count() == 0


# --- neighbours --------------------------------------------------------------


def test_neighbours_reach_their_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = collections.defaultdict(list)
    for r in ann.search(vectors.where("vec_id % 20 = 0"), vectors).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    table = vectors.toPandas()
    x, ids = np.array(table.embedding.tolist(), dtype=float), table.vec_id.to_numpy()
    truth = ann.brute_force(x[ids % 20 == 0], ids[ids % 20 == 0], x, ids, 20)
    assert set(got) == set(truth) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(v)) / 20 for q, v in truth.items()]) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    good = [[1.0, 0.0], [1.0, 0.0], [1.0, 0.0], [0.5, 0.5], [-1.0, 0.0]]
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(10 + i, v) for i, v in enumerate(bad)] + [(None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("leaf", F.lit(1))
    got = collections.defaultdict(list)
    for r in ann.search(vectors, vectors).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got[1] == [(0, 1.0), (2, 1.0), (3, 0.5), (4, -1.0)] and set(got) == {0, 1, 2, 3, 4}
    assert ann.search(vectors, vectors.limit(0)).count() == 0
    assert ann.search(vectors.limit(0), vectors).count() == 0


def test_a_leaf_of_copies_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    vectors = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.lit(0.6), F.lit(0.8)).alias("embedding"))
    rows = ann.search(vectors.where("vec_id = 7"), vectors, 20).orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [i for i in range(21) if i != 7]


def test_bundles_asked_by_many_queries_are_sent_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(500, 6)), rng.normal(size=(500, 6)) * 0.01 + 3])  # half of it in one place
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    whole = sorted(map(tuple, ann.search(rows, rows, 5).collect()))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 60)
    assert sorted(map(tuple, ann.search(rows, rows, 5).collect())) == whole


def test_neighbours_among_copies_and_scattered_vectors(spark):
    rng = np.random.default_rng(3)
    centers, scattered = rng.normal(size=(40, 8)), rng.normal(size=(700, 8))
    x = np.concatenate([np.repeat(centers, 250, axis=0), scattered])
    ids = np.arange(len(x))
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    asked = np.flatnonzero((ids % 5 == 0) & (ids >= 10_000) | (ids % 250 == 0))
    got = collections.defaultdict(list)
    for r in ann.search(rows.where(F.col("vec_id").isin(asked.tolist())), rows).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.score)
    assert set(got) == set(asked.tolist()) and all(len(v) == 20 for v in got.values())
    # copies tie, so scores are compared: a score that brute force has is a true neighbour's
    least = {q: np.sort(np.delete(x @ x[q], q))[-20] for q in asked.tolist()}
    found = {q: np.mean(np.array(v) >= least[q] - 1e-9) for q, v in got.items()}
    assert np.mean([found[q] for q in asked.tolist() if q >= 10_000]) >= 0.9
    assert np.mean([found[q] for q in asked.tolist() if q < 10_000]) >= 0.9


def test_sparse_and_empty_leaves_still_give_all_rows():
    tree = ann.Tree(np.repeat(np.eye(4), 50, axis=0), 8)
    sizes = {leaf: n for leaf, n in zip(range(1, tree.leaves), (3, 3, 500))}  # the first leaf has none
    for q in np.eye(4):
        leaves = tree.opened(q, 0, 1, 21, sizes)
        assert set(leaves) <= set(sizes) and sum(sizes[x] for x in leaves) >= 21
        assert tree.opened(q, 1, 1, 10_000, sizes) and set(tree.opened(q, 1, 1, 10_000, sizes)) == set(sizes)


def test_rows_of_the_own_id_are_no_candidates(spark):
    rows = [(1, [1.0, 0.1 * i]) for i in range(300)] + [(100 + i, [-1.0, 0.01 * i]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert ann.search(vectors.where("vec_id = 1").limit(1), vectors).count() == 20


# --- queries and pipeline ----------------------------------------------------


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_queries_run(spark, name):
    frame = queries.QUERIES[name](spark, SMALL)
    assert frame.count() > 0 and len(set(frame.columns)) == len(frame.columns)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    frame = queries.QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(columns)
    assert collections.Counter(map(tuple, frame.select(*columns).collect())) == collections.Counter(cursor.fetchall())


def test_pipeline_keeps_its_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{work_dir(spark, 'stage')}/{name}"
        stage(spark, kept, SMALL).write.parquet(path)
        before, kept = kept, spark.read.parquet(path)
        assert kept.columns == columns, name
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    assert kept.count() > docs.count() // 2
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == kept.count()


def test_pipeline_of_odd_documents(spark, tmp_path):
    rows = [(1, None, None, "s", 0), (2, "", "en", None, None), (None, "the and of " * 40, "en", "s", 1), (3, "the and of " * 40, "en", "s", 1), (3, "the and of " * 40, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("component_id", F.lit(1))
    for folder, table in (("a", docs), ("b", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() == 1  # of three equal texts one stays
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_nothing_else_imports_this_part():
    root = pathlib.Path(queries.__file__).parents[1]
    others = [p for p in root.rglob("*.py") if "llm" not in p.parts]
    assert others and not any("engrama.llm" in p.read_text() for p in others)


def plain_best_fit(pieces, capacity):
    rooms = []
    for x in sorted(pieces, reverse=True):
        fitting = [r for r in rooms if r >= x]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - x)
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@pytest.mark.parametrize("low,high,most", [(1, 100, 3), (25, 55, 9), (17, 35, 30), (1, 12, 60), (90, 100, 5)])
def test_packing_is_never_worse_than_best_fit(low, high, most):
    rng = random.Random(low)
    for _ in range(12):
        counts = {x: rng.randint(0, most) for x in range(low, high + 1)}
        pieces = [x for x, n in counts.items() for _ in range(n)]
        rooms = plain_best_fit(pieces, 100)
        together = packing.best_fit(counts, 100)
        assert sorted(100 - sum(x * n for x, n in p) for p, times in together for _ in range(times)) == rooms
        packed = packing.complete_bins(counts, 100)
        used = collections.Counter()
        for pattern, times in packed:
            assert sum(x * n for x, n in pattern) <= 100
            for x, n in pattern:
                used[x] += n * times
        assert used == collections.Counter(pieces)
        assert packing.lower_bound(counts, 100) <= sum(times for _, times in packed) <= len(rooms)


@pytest.mark.parametrize("low,high", [(1, 2047), (500, 1099), (350, 690)])
def test_wide_histograms_pack_as_best_fit_does_or_better(low, high):
    rng = random.Random(high)
    counts = {x: rng.randint(0, 12) for x in range(low, high + 1)}
    bins = sum(times for _, times in packing.complete_bins(counts, 2048))
    assert packing.lower_bound(counts, 2048) <= bins <= sum(times for _, times in packing.best_fit(counts, 2048))


PROSE = " ".join(f"Sentence {i} of a story that goes on about something." for i in range(9))


@pytest.mark.parametrize("name", ["responsive", "content responsive", "commentary", "navy", "searchable", "notices", "side", "tag", "item legal", "comments", "sidebar"])
def test_a_class_alone_drops_no_article(name):
    plain = html_text.Weights()
    menu = "<nav><a href=/>Home</a> <a href=/b>More</a></nav>"
    for page in (
        f"<body>{menu}<div class='{name}'><p>{PROSE}</p></div><footer>Imprint</footer></body>",
        f"<body>{menu}<article><div class='{name}'><p>{PROSE}</p></div></article><footer>Imprint</footer></body>",
        f"<body><form id=aspnetForm>{menu}<div id='{name}'><p>{PROSE}</p></div><footer>Imprint</footer></form></body>",
        f"<body><div class='{name}'>{menu}<article><p>{PROSE}</p></article></div></body>",
    ):
        assert html_text.main_text(page, plain) == PROSE


def test_comments_go_even_where_they_are_longer():
    comments = f"<div class=comments><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>"
    for page in (f"<article><p>{PROSE}</p></article>{comments}", f"<article><p>{PROSE}</p>{comments}</article>", f"<div><p>{PROSE}</p></div>{comments}"):
        assert html_text.main_text(f"<body>{page}</body>", html_text.Weights()) == PROSE
