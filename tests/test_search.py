"""Search kernels against plain numpy, in both physical forms, with hot groups and ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from engrama.functions import vectors
from engrama.operators import ivf, text_index, text_search as ts, vector_search as vs


def frame(spark, ids, rows, id_name, vector_name, **extra):
    columns = [id_name, vector_name, *extra]
    data = [(i, [float(x) for x in r], *(extra[c][n] for c in extra)) for n, (i, r) in enumerate(zip(ids, rows))]
    types = ", ".join(
        f"{c} {'array<float>' if c == vector_name else 'string' if isinstance(data[0][j], str) else 'bigint'}"
        for j, c in enumerate(columns)
    )
    return spark.createDataFrame(data, types)


def brute(metric, queries, base, ids, k):
    out = {}
    for q, row in enumerate(queries):
        score = vectors.scores(metric, row[None], base)[0]
        out[q] = [ids[i] for i in np.lexsort((ids, -score))[:k]]
    return out


def answers(hits, query="query_id", item="object_id"):
    out = {}
    for r in hits.orderBy(query, "rank").collect():
        out.setdefault(r[query], []).append(r[item])
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 8)).astype(np.float32)
    base[100:200] = base[100]  # a third of the rows are copies: ties are broken by id
    return base, rng.normal(size=(12, 8)).astype(np.float32)


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
@pytest.mark.parametrize("limit", [1 << 28, 0], ids=["broadcast", "blocks"])
def test_both_forms_equal_brute_force(spark, points, metric, limit):
    base, queries = points
    ids = list(range(300))
    b = frame(spark, ids, base, "object_id", "embedding").repartition(4)
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    got = answers(vs.top_k(q, b, k=7, metric=metric, broadcast_bytes=limit, block_bytes=(37 * 64, 5 * 64)))
    want = brute(metric, queries.astype(float), base.astype(float), np.array(ids), 7)
    assert got == want


@pytest.mark.parametrize("limit", [1 << 28, 0], ids=["broadcast", "blocks"])
def test_on_and_within(spark, points, limit):
    base, queries = points
    part = ["hot" if i % 3 else "cold" for i in range(300)]
    source = ["x" if i % 2 else "y" for i in range(300)]
    b = frame(spark, range(300), base, "object_id", "embedding", part=part, source=source)
    q = frame(spark, range(12), queries, "query_id", "query_vector", part=["hot", "cold"] * 6)
    hits = vs.top_k(q, b, k=3, on=["part"], within=["source"], broadcast_bytes=limit, block_bytes=(50 * 64, 5 * 64))
    rows = hits.collect()
    assert len(rows) == 12 * 2 * 3
    for r in rows:
        assert part[r.object_id] == r.part == ["hot", "cold"][r.query_id % 2]
        assert source[r.object_id] == r.source


@pytest.mark.parametrize("limit", [1 << 28, 0], ids=["broadcast", "blocks"])
def test_a_table_searched_for_its_own_rows_within_their_groups(spark, points, limit):
    base, _ = points
    part = ["hot" if i % 3 else "cold" for i in range(300)]
    b = frame(spark, range(300), base, "object_id", "embedding", part=part)
    q = b.select(F.col("object_id").alias("query_id"), "part", F.col("embedding").alias("query_vector"))
    got = answers(vs.top_k(q, b, k=4, on=["part"], broadcast_bytes=limit, block_bytes=(50 * 64, 70 * 64)))
    for kind in ("hot", "cold"):
        ids = np.array([i for i in range(300) if part[i] == kind])
        want = brute("COSINE", base[ids].astype(float), base[ids].astype(float), ids, 4)
        assert [got[i] for i in ids] == [want[n] for n in range(len(ids))]


@pytest.mark.parametrize("within", [[], ["source"]])
def test_shipped_rows_are_bounded_however_little_a_task_may_hold(spark, points, within, monkeypatch):
    base, queries = points
    b = frame(spark, range(300), base, "object_id", "embedding", source=[f"s{i % 30}" for i in range(300)])
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    want = sorted(map(tuple, vs.top_k(q, b, k=3, within=within).collect()))
    monkeypatch.setattr(vs, "LEAST_QUERY_ROWS", 4)
    tight = vs.top_k(q, b, k=3, within=within, kept_rows=1, block_bytes=(8 * base.shape[1] * 100, 8 * base.shape[1] * 100))
    assert sorted(map(tuple, tight.collect())) == want


def test_a_task_keeps_its_bars():
    best = vectors.Best(2, 1)
    for i in range(50):
        best.keep((), np.array([0]), np.array([i]), np.array([float(i)]))
        assert len(best.kept[()][0]) <= 2
    assert list(best.kept[()][1]) == [49, 48]


def several(kind, rng, n, dim=16):
    rows = rng.normal(size=(n, dim))
    if kind == "copies":
        rows[n // 3 :: 2] = rows[0]
    elif kind == "near":
        rows = rows[:1] + 1e-4 * rows
    elif kind == "lengths":
        rows *= np.exp(3 * rng.normal(size=(n, 1)))
    elif kind == "zeros":
        rows[::3] = 0
    return rows.astype(np.float32).astype(float)


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
@pytest.mark.parametrize("kind", ["plain", "copies", "near", "lengths", "zeros"])
def test_screening_loses_no_row(metric, kind):
    rng = np.random.default_rng(8)
    base, ids = several(kind, rng, 5000), rng.permutation(5000)
    queries = np.concatenate([base[:30], several(kind, rng, 10), 1e3 * base[:5]])
    got = vectors.block_top_k(metric, np.arange(45), queries, ids, base, 7)
    score = vectors.scores(metric, queries, base)
    for q in range(45):
        best = np.lexsort((ids, -score[q]))[:7]
        assert got[1][got[0] == q].tolist() == ids[best].tolist()
        assert np.allclose(got[2][got[0] == q], score[q][best], rtol=1e-9, atol=2e-6)


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
def test_few_pairs_are_scored_in_full(metric, monkeypatch):
    rng = np.random.default_rng(9)
    base, cells, scores = several("plain", rng, 20_000), [], vectors.scores
    monkeypatch.setattr(vectors, "scores", lambda m, q, b: cells.append(len(q) * len(b)) or scores(m, q, b))
    vectors.block_top_k(metric, np.arange(40), base[:40], np.arange(20_000), base, 10)
    assert sum(cells) < 40 * 20_000 / 10


def test_what_is_not_finite_is_not_screened():
    rng = np.random.default_rng(10)
    base = several("plain", rng, 3000)
    base[2000, 1] = np.nan
    got = vectors.block_top_k("IP", np.arange(3), base[:3], np.arange(3000), base, 5)
    score = np.where(np.isnan(s := vectors.scores("IP", base[:3], base)), -np.inf, s)
    assert got[1].reshape(3, 5).tolist() == [np.lexsort((np.arange(3000), -r))[:5].tolist() for r in score]


def test_a_search_of_a_list_starts_from_the_bars_of_others(monkeypatch):
    rng = np.random.default_rng(11)
    books, queries = rng.normal(size=(4, 16, 2)), rng.normal(size=(50, 8))
    tables, codes = vectors.PartTables(books), rng.integers(0, 16, (6000, 4)).astype(float)
    score = tables.scores("L2", queries, codes)
    cells, full = [], vectors.PartTables.scores
    monkeypatch.setattr(vectors.PartTables, "scores", lambda self, m, q, b: cells.append(len(q) * len(b)) or full(self, m, q, b))
    best, asking = vectors.Best(10, 50, wait=500), np.arange(50)
    for rows in np.array_split(np.arange(6000), 30):
        best.keep((), *vectors.block_top_k("L2", asking, queries, rows, codes[rows], 10, tables, best.bars_of((), asking)))
    best.sort(())
    assert sum(cells) < 50 * 6000 / 2
    assert best.kept[()][1].reshape(50, 10).tolist() == [np.lexsort((np.arange(6000), -r))[:10].tolist() for r in score]


@pytest.mark.parametrize("ids", [np.arange(-50, 50), np.arange(100) + 2**62, np.array([f"n{i}" for i in range(100)])])
def test_entries_sort_alike_as_numbers_and_by_columns(ids):
    rng = np.random.default_rng(12)
    query, which = rng.integers(0, 9, 700), rng.integers(0, 100, 700)
    for score in (np.round(rng.normal(size=700), 1), rng.normal(size=700), np.where(which == 3, np.inf, -1.5)):
        order = np.lexsort((ids[which], -score, query))
        want = [i for q in range(9) for i in [j for j in order if query[j] == q][:4]]
        got = vectors.keep_best(query, ids[which], score, 4)
        assert [x.tolist() for x in got] == [query[want].tolist(), ids[which][want].tolist(), score[want].tolist()]
    assert all(len(x) == 0 for x in vectors.keep_best(query[:0], ids[:0], np.empty(0), 4))


def test_groups_keep_large_and_missing_integers(spark, points):
    base, queries = points
    big = [2**53, 2**53 + 1, None]
    b = frame(spark, range(300), base, "object_id", "embedding", source=[big[i % 3] for i in range(300)])
    q = frame(spark, range(2), queries[:2], "query_id", "query_vector")
    assert {r.source for r in vs.top_k(q, b, k=1, within=["source"]).collect()} == set(big)


def test_query_dimension_must_match(spark, points):
    base, _ = points
    b = frame(spark, range(300), base, "object_id", "embedding")
    q = frame(spark, [0], [[1.0, 2.0]], "query_id", "query_vector")
    with pytest.raises(Exception, match="dimensions"):
        vs.top_k(q, b).collect()


def test_zero_vectors_score_zero():
    assert vectors.scores("COSINE", np.zeros((1, 3)), np.ones((2, 3))).tolist() == [[0.0, 0.0]]


def test_close_pairs_keep_exact_distances():
    base = np.array([[1000.0, 1000.0], [1000.0, 1000.001]])
    assert np.allclose(vectors.distances_l2(base, base), [[0, 0.001], [0.001, 0]], atol=1e-9)


def test_flat_result_of_two_queries(spark):
    frames = spark.createDataFrame([(0, list(range(6)), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5])], "f bigint, ids array<bigint>, ds array<double>")
    rows = vs.explode_flat_result(frames, "f", "ids", "ds", topk=3).orderBy("query_idx", "rank").collect()
    assert [(r.query_idx, r.rank, r.id) for r in rows] == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (1, 0, 3), (1, 1, 4), (1, 2, 5)]
    assert rows[4].distance == 0.4


def test_flat_result_must_fit(spark):
    frames = spark.createDataFrame([(0, [1, 2, 3], [0.1, 0.2])], "f bigint, ids array<bigint>, ds array<double>")
    with pytest.raises(Exception, match="do not fit"):
        vs.explode_flat_result(frames, "f", "ids", "ds", topk=3).collect()


def test_recall_rises_with_probes_and_ends_at_one(spark, points):
    base, queries = points
    b = frame(spark, range(300), base, "object_id", "embedding")
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    exact = answers(vs.top_k(q, b, k=10))
    for centroids in (ivf.sampled_centroids(b, 8), ivf.kmeans_centroids(b, 8)):
        assigned = ivf.assign_lists(b, centroids)
        recalls = []
        for nprobe in (1, 4, 8):
            got = answers(ivf.ivf_search(q, assigned, centroids, nprobe, 10))
            recalls.append(sum(len(set(got.get(i, [])) & set(exact[i])) for i in exact) / 120)
        assert recalls == sorted(recalls)
        assert recalls[-1] == 1.0


def test_codes_are_scored_as_the_vectors_they_stand_for():
    rng = np.random.default_rng(3)
    books, codes, queries = rng.normal(size=(4, 16, 2)), rng.integers(0, 16, (50, 4)), rng.normal(size=(7, 8))
    codes[:16] = np.arange(16)[:, None]
    queries[0] = books[:, 5].ravel()  # an entry itself
    decoded = books[np.arange(4), codes].reshape(50, 8)
    tables = vectors.PartTables(books)
    assert np.abs(tables.scores("L2", queries, codes.astype(float)) - vectors.scores("L2", queries, decoded)).max() <= 2e-6
    assert (tables.width(8), tables.cells) == (4, 64)
    with pytest.raises(ValueError):
        tables.scores("IP", queries, codes)
    low, high = decoded.min(axis=0), decoded.max(axis=0)
    stored = np.floor(255 * (decoded - low) / (high - low) + 0.5)
    got = vectors.ByteRanges(low, high).scores("IP", queries, stored)
    assert np.abs(got - vectors.scores("IP", queries, decoded)).max() < 0.5


@pytest.mark.parametrize("limit", [{}, {"broadcast_bytes": 0}])
def test_coded_search_in_both_forms(spark, limit):
    """Codes stay codes in the broadcast and in the block form, with the same answers as decoded vectors."""
    rng = np.random.default_rng(4)
    books, codes, queries = rng.normal(size=(4, 16, 2)), rng.integers(0, 16, (60, 4)), rng.normal(size=(5, 8))
    q = frame(spark, range(5), queries, "query_id", "query_vector")
    coded = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(codes)], "object_id bigint, codes array<smallint>")
    decoded = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(books[np.arange(4), codes].reshape(60, 8))], "object_id bigint, embedding array<double>")
    got = vs.top_k(q, coded, k=10, metric="L2", base_vector="codes", coding=vectors.PartTables(books), **limit)
    assert answers(got) == answers(vs.top_k(q, decoded, k=10, metric="L2"))


@pytest.mark.parametrize("kind,least", [("IVF_FLAT", 1.0), ("IVF_SQ8", 0.9), ("IVF_PQ", 0.5)])
def test_stored_indexes_answer_from_their_folders(spark, points, tmp_path, kind, least):
    base, queries = points
    b = frame(spark, range(300), base, "object_id", "embedding").where("object_id < 100 or object_id >= 200")
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    exact = answers(vs.top_k(q, b, k=10))
    path = str(tmp_path / "index")
    row = ivf.build_index(b, ivf.sampled_centroids(b, 4), path, "s", kind).first()
    assert (row.index_type, row.n_lists, row.n_vectors) == (kind, 4, 200)
    stored = set(spark.read.parquet(f"{path}/lists").columns)
    assert ("embedding" in stored) == (kind == "IVF_FLAT") and ("codes" in stored) == (kind != "IVF_FLAT")
    got = answers(ivf.search_index(spark, path, q, 4, 10))
    assert sum(len(set(a) & set(exact[i])) for i, a in got.items()) / 120 >= least
    assert answers(ivf.search_index(spark, path, q, k=10)) == answers(ivf.search_index(spark, path, q, 1, 10))  # a quarter of the lists
    one = ivf.of_lists(ivf.read_lists(spark, path), spark.createDataFrame([(2,)], "list_id bigint"), row.n_folders)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan and "EqualTo(list_id,2)" in plan and "Exchange" not in plan


def test_an_index_lies_in_few_folders_and_keeps_its_settings(spark, points, tmp_path):
    base, queries = points
    b = frame(spark, range(300), base, "object_id", "embedding")
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    path = str(tmp_path / "index")
    row = ivf.build_index(b, ivf.sampled_centroids(b, 40), path, "s", "IVF_PQ", nprobe=40, parts=2, bits=6).first()
    assert (row.n_folders, row.nprobe) == (5, 40)
    assert len(list((tmp_path / "index/lists").glob("folder=*"))) == len(list((tmp_path / "index/vectors").glob("folder=*"))) == 5
    assert spark.read.parquet(f"{path}/codebooks").groupBy("part").count().orderBy("part").collect() == [(0, 64), (1, 64)]
    assert answers(ivf.search_index(spark, path, q, k=10)) == answers(ivf.search_index(spark, path, q, 40, 10))
    sizes = ivf.read_lists(spark, path).where("folder <> list_id % 5").count()
    assert sizes == 0
    exact = ivf.build_index(b, ivf.sampled_centroids(b, 4), str(tmp_path / "exact"), "s", "IVF_SQ8", sq_type="FP32").first()
    assert exact.coded_as == "vectors"
    assert answers(ivf.search_index(spark, str(tmp_path / "exact"), q, 4, 10)) == answers(vs.top_k(q, b, k=10))
    with pytest.raises(ValueError, match="sq_type"):
        ivf.build_index(b, ivf.sampled_centroids(b, 4), path, "s", "IVF_SQ8", sq_type="INT4")


def test_lists_of_unequal_vectors_follow_their_metric(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 8)) * rng.uniform(0.1, 10, size=(300, 1))
    b = frame(spark, range(300), base, "object_id", "embedding")
    q = frame(spark, range(12), base[:12], "query_id", "query_vector")
    exact = answers(vs.top_k(q, b, k=10, metric="L2"))
    centroids = ivf.kmeans_centroids(b, 8)

    def recall(metric):
        assigned = ivf.assign_lists(b, centroids, metric=metric)
        got = answers(ivf.ivf_search(q, assigned, centroids, 3, 10, "L2", list_metric=metric))
        return sum(len(set(got.get(i, [])) & set(exact[i])) for i in exact) / 120

    assert recall("L2") > 0.7 and recall("L2") >= recall("IP")


TEXTS = [(f"d{i:03d}", t, "ab"[i % 2]) for i, t in enumerate(
    ["the cat sat on the mat", "the dog ate the cat", "birds sing at dawn", "", "the the the", "Cat! cat? CAT."] * 20
)]


@pytest.mark.parametrize("scope,within", [((), ()), (("ws",), ()), ((), ("ws",))])
def test_text_search_forms_agree(spark, scope, within):
    texts = spark.createDataFrame(TEXTS, "memory_id string, text string, ws string").repartition(3)
    queries = spark.createDataFrame([(1, "the cat", "a"), (2, "dawn birds the", "b"), (3, "nothing here", "a")],
                                    "query_id bigint, query_text string, ws string")
    results = [
        sorted(map(tuple, ts.text_search(queries, texts, k=5, scope=scope, within=within, broadcast_bytes=n).collect()))
        for n in (1 << 28, 0)
    ]
    assert results[0] == results[1]
    assert len(results[0]) == (20 if within else 10)


@pytest.mark.parametrize("scope,within", [((), ()), (("ws",), ()), ((), ("ws",))])
def test_a_stored_text_index_answers_like_a_search(spark, scope, within, tmp_path):
    texts = spark.createDataFrame(TEXTS, "memory_id string, text string, ws string")
    queries = spark.createDataFrame([(1, "the cat", "a"), (2, "dawn birds the", "b"), (3, "nothing here", "a")],
                                    "query_id bigint, query_text string, ws string")
    path = str(tmp_path / "index")
    text_index.build(texts, path, carried=["ws"], buckets=4)
    got = text_index.search(spark, path, queries, 5, scope, within)
    columns = ["query_id", *dict.fromkeys([*scope, *within]), "memory_id", "score", "rank"]
    want = ts.text_search(queries, texts, k=5, scope=scope, within=within)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    few = text_index.only_terms(spark.read.parquet(f"{path}/postings"), spark.createDataFrame([("cat",)], "token string"), 4)
    assert "PartitionFilters: [isnotnull(bucket" in few._jdf.queryExecution().executedPlan().toString()


def test_words_of_all_scripts_are_found(spark):
    texts = spark.createDataFrame([("a", "\u0441\u043b\u043e\u0432\u043e \u0434\u0435\u043b\u043e"), ("b", "caf\u00e9 noir"), ("c", "cafe")], "memory_id string, text string")
    queries = spark.createDataFrame([(1, "\u0421\u043b\u043e\u0432\u043e"), (2, "CAF\u00c9")], "query_id bigint, query_text string")
    assert answers(ts.text_search(queries, texts), item="memory_id") == {1: ["a"], 2: ["b"]}


def test_boost_changes_the_order(spark):
    texts = spark.createDataFrame([("a", "cat", 0.1), ("b", "cat dog", 1.0)], "memory_id string, text string, imp double")
    queries = spark.createDataFrame([(1, "cat")], "query_id bigint, query_text string")
    plain = answers(ts.text_search(queries, texts), item="memory_id")
    boosted = answers(ts.text_search(queries, texts, boost=F.col("imp")), item="memory_id")
    assert plain == {1: ["a", "b"]} and boosted == {1: ["b", "a"]}


def test_rrf_prefers_what_both_lists_have(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "query_id bigint, memory_id string, rank bigint")
    b = spark.createDataFrame([(1, "z", 1), (1, "y", 2)], "query_id bigint, memory_id string, rank bigint")
    rows = ts.rrf_fusion([a, b], "query_id", "memory_id", 3).orderBy("rank").collect()
    assert [r.memory_id for r in rows] == ["y", "x", "z"]
    assert rows[0].score == round(2 / 62, 6)


def test_lists_by_search_equal_lists_by_broadcast(spark, points, monkeypatch):
    base, _ = points
    b = frame(spark, range(300), base, "object_id", "embedding")
    centroids = ivf.sampled_centroids(b, 8)
    want = {r.object_id: r.list_id for r in ivf.assign_lists(b, centroids).collect()}
    monkeypatch.setattr(ivf, "BROADCAST_BYTES", 0)  # centroids too large to send
    got = {r.object_id: r.list_id for r in ivf.assign_lists(b, centroids).collect()}
    assert got == want and len(want) == 300


def test_a_large_vocabulary_is_joined_not_broadcast(spark, monkeypatch):
    texts = spark.createDataFrame(TEXTS, "memory_id string, text string, ws string")
    want = sorted(map(tuple, ts.tfidf_weights(texts, ["memory_id"], "text").collect()))
    monkeypatch.setattr(ts, "BROADCAST_BYTES", 0)
    got = ts.tfidf_weights(texts, ["memory_id"], "text")
    assert sorted(map(tuple, got.collect())) == want
    assert "SortMergeJoin" in got._jdf.queryExecution().toString()


def greedy_picks(query, base, k, fetch_k, weight):
    """Diversified picks by the formula, one at a time."""
    def near(a, b):
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return round(float(a @ b / n), 6) if n else 0.0

    fetched = sorted(base, key=lambda i: (-near(query, base[i]), i))[:fetch_k]
    picks = []
    while fetched and len(picks) < k:
        def gain(i):
            nearness = near(query, base[i])
            return round(weight * nearness - (1 - weight) * max(near(base[i], base[j]) for j in picks), 9) if picks else nearness
        best = min(fetched, key=lambda i: (-gain(i), i))
        picks.append(best)
        fetched.remove(best)
    return picks


@pytest.mark.parametrize("k,fetch_k,weight", [(4, 20, 0.5), (3, 3, 0.2), (50, 10, 0.9), (4, 20, 1.0), (4, 20, 0.0)])
def test_mmr_picks(spark, k, fetch_k, weight):
    rng = np.random.default_rng(k)
    base = {i: rng.normal(size=6) for i in range(40)}
    base[40], base[41], base[42] = base[3], base[3], np.zeros(6)
    queries = {i: rng.normal(size=6) for i in range(5)}
    frame = lambda rows, names: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows.items()], names)
    got = vs.mmr(frame(queries, "query_id int, query_vector array<double>"), frame(base, "object_id int, embedding array<double>"), k, fetch_k, weight).collect()
    for q, vector in queries.items():
        picks = [r.object_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.pick)]
        assert picks == greedy_picks(vector, base, k, fetch_k, weight)


def test_mmr_by_distance_and_without_rows(spark):
    base = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.1]), (3, [3.0, 0.0]), (4, None)], "object_id int, embedding array<double>")
    queries = spark.createDataFrame([(1, [0.0, 1.0]), (2, None)], "query_id int, query_vector array<double>")
    got = sorted(vs.mmr(queries, base, 2, 3, 0.4, "L2").collect(), key=lambda r: r.pick)
    assert [(r.object_id, r.score) for r in got] == [(1, 0.0), (3, pytest.approx(3.162278))]
    assert vs.mmr(queries, base.limit(0)).count() == vs.mmr(queries.limit(0), base).count() == 0
    with pytest.raises(ValueError):
        vs.mmr(queries, base, weight=1.5)


@pytest.mark.parametrize("scope,within", [([], []), (["ws"], []), ([], ["ws"])])
def test_index_postings_meet_by_text_whatever_the_number_of_queries(spark, tmp_path, scope, within):
    """Few queries are scored in tasks: no row per posting and query; beyond the bound the join gives the same."""
    path = str(tmp_path / "text-index")
    rows = [*TEXTS, ("d000", "the other cat", "a"), (None, "the cat", "a"), ("d999", "the cat", None)]
    text_index.build(spark.createDataFrame(rows, "memory_id string, text string, ws string"), path, carried=["ws"], buckets=4)
    queries = spark.createDataFrame([(i, "the cat sat at dawn", "ab"[i % 2]) for i in range(6)], "query_id bigint, query_text string, ws string")
    small = text_index.search(spark, path, queries, 5, scope, within)
    large = text_index.search(spark, path, queries, 5, scope, within, broadcast_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (small, large)]
    assert "MapInArrow" in plans[0] and "MapInArrow" not in plans[1]


@pytest.mark.parametrize("metric", ["COSINE", "L2"])
def test_queries_go_once_to_a_block_of_lists(spark, points, metric):
    """Lists of blocks, long lists in pieces, lists nobody holds, repeated ids and asks: as if each list were searched alone."""
    base, queries = points
    b = frame(spark, range(300), base, "object_id", "embedding", list_id=[0 if i % 2 else 1 + i % 7 for i in range(300)])
    lists = [[0, 1, 5], [2], [9], [0, 0, 3], [1, 2, 3, 4, 5, 6, 7]] * 2 + [[7], []]
    rows = [(i if i < 11 else 0, [float(x) for x in v], asked) for i, (v, asked) in enumerate(zip(queries, lists))]
    q = spark.createDataFrame(rows, "query_id bigint, query_vector array<float>, lists array<bigint>")
    asks = q.select("query_id", F.explode("lists").alias("list_id"), "query_vector")
    columns = ["query_id", "list_id", "object_id", "score", "rank"]
    want = vs.top_k(asks, b, k=7, metric=metric, on=["list_id"]).select("query_id", "object_id", "score", "rank")
    got = vs.top_k_in_lists(q, b, k=7, metric=metric, broadcast_bytes=0, block_bytes=(64 * 40, 64 * 5))
    assert set(columns) == set(got.columns)
    assert sorted(map(tuple, got.select("query_id", "object_id", "score", "rank").collect())) == sorted(map(tuple, want.collect()))
    lists_of = {r.object_id: r.list_id for r in b.collect()}
    assert all(r.list_id == lists_of[r.object_id] for r in got.collect())


def test_probes_are_one_row_per_query(spark, points):
    base, queries = points
    q = frame(spark, range(12), queries, "query_id", "query_vector")
    centroids = frame(spark, range(20), base[:20], "list_id", "centroid")
    for metric in ("IP", "L2"):
        best = vs.top_k(q, centroids, k=5, metric=metric, base_id="list_id", base_vector="centroid")
        want = {i: sorted(found) for i, found in answers(best, item="list_id").items()}
        assert {r.query_id: sorted(r.lists) for r in ivf.probes(q, centroids, 5, metric=metric).collect()} == want
        twice = {r.query_id: sorted(set(r.lists)) for r in ivf.probes(q.union(q.where("query_id = 0")), centroids, 5, metric=metric).collect()}
        assert {i: found for i, found in twice.items() if i} == {i: found for i, found in want.items() if i}


def test_slices_of_base_rows_keep_ties(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(-1, 2, (500, 4)).astype(float)  # many equal scores
    queries, ids = rng.normal(size=(9, 4)), rng.permutation(500)
    want = vectors.block_top_k("IP", np.arange(9), queries, ids, base, 12)
    monkeypatch.setattr(vectors, "SCORE_ROWS", 7)
    for got, expected in zip(vectors.block_top_k("IP", np.arange(9), queries, ids, base, 12), want):
        assert got.tolist() == expected.tolist()


def test_text_vectors_merge_torn_texts_and_repeated_ids(spark):
    """A row per text is shuffled, none per token; rows of one id are one vector, and so are texts longer than a batch."""
    long = " ".join(f"w{i}" for i in range(200))
    rows = [("a", "x y y"), ("b", long), ("a", "z x"), ("c", ""), (None, "x"), (None, "y")]
    texts = spark.createDataFrame(rows, "memory_id string, text string")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        cells = {(r.memory_id, r.bucket): r.value for r in ts.dense_text_cells(texts, "memory_id", "text").collect()}
        vectors_of = [(r.memory_id, r.embedding) for r in ts.dense_text_vectors(texts, "memory_id", "text").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    weights = ts.tfidf_weights(texts, ["memory_id"], "text").groupBy("memory_id", ts.bucket_of(F.col("token")).alias("bucket")).agg(F.sum("w").alias("s"))
    sums = {(r.memory_id, r.bucket): r.s for r in weights.collect()}
    for (name, bucket), s in sums.items():
        length = sum(v * v for (n, _), v in sums.items() if n == name) ** 0.5
        assert abs(cells.pop((name, bucket)) - s / length) < 1e-12
    assert not cells and len(vectors_of) == 6
    assert all(not any(v) for name, v in vectors_of if name in ("c", None))
    assert all(abs(sum(x * x for x in v) - 1) < 1e-5 for name, v in vectors_of if name in ("a", "b"))
