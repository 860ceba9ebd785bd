"""Lifecycle, filters, graph, tasks and provenance on small hand-made tables."""

import random

import pytest
from pyspark.sql import functions as F

from engrama.functions.provenance import runtime_info
from engrama.operators import collections, embedding, filters, graph, lifecycle, sketches, tasks
from engrama.session import materialize
from engrama.sources import snapshots


@pytest.fixture(scope="module")
def memory(spark):
    return spark.createDataFrame(
        [
            ("m1", "w", "a", "d", "Hello  World", True, "hot", ["e1", "r1"], 0.5),
            ("m2", "w", "a", "d", "hello world", False, "cold", ["e2", "r1"], 0.9),
            ("m3", "w", "b", "d2", "hello world", True, "cold", ["e3"], 0.1),
            ("m4", "v", "a", "d", "other", True, "hot", ["e4", "r1"], 0.2),
        ],
        "memory_id string, workspace_id string, agent_id string, dataset_name string, text string, is_active boolean, "
        "tier string, source_event_ids array<string>, importance double",
    )


def ids(df):
    return sorted(r.memory_id for r in df.select("memory_id").collect())


def test_copies_are_merged_per_agent(memory):
    rows = {r.kept_id: (r.n_merged, r.n_sources, r.importance) for r in lifecycle.compressed(memory).collect()}
    assert rows == {"m1": (2, 3, 0.9), "m3": (1, 1, 0.1), "m4": (1, 2, 0.2)}


@pytest.mark.parametrize("kwargs", [{}, {"reference_id": "r", "event_id": "e"}])
def test_exactly_one_reference(kwargs):
    with pytest.raises(ValueError, match="exactly one"):
        lifecycle.source_match("w", **kwargs)


def test_workspace_is_required():
    with pytest.raises(ValueError, match="workspace_id"):
        lifecycle.source_match("", event_id="e")
    with pytest.raises(ValueError):
        lifecycle.dataset_match("w", "")


def test_soft_delete_and_purge_stay_in_the_workspace(memory):
    match = lifecycle.source_match("w", reference_id="r1")
    assert ids(lifecycle.soft_deleted(memory, match).where("is_active")) == ["m3", "m4"]
    assert ids(lifecycle.purged(memory, match)) == ["m1", "m3", "m4"]
    assert ids(lifecycle.purged(memory, match, only_if_inactive=False)) == ["m3", "m4"]
    report = lifecycle.deletion_report(memory, match).first()
    assert (report.n_matched, report.n_active) == (2, 1)


def test_purge_job_is_idempotent(spark, memory, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    snapshots.write_version(memory, table)
    match = lifecycle.source_match("w", reference_id="r1")
    first = lifecycle.purge_job(spark, table, audit, match, "purge", "k1", partition_by=None).first()
    again = lifecycle.purge_job(spark, table, audit, match, "purge", "k1", partition_by=None).first()
    assert first == again and (first.n_removed, first.n_left, first.version) == (1, 3, 2)
    assert snapshots.versions(spark, table) == [1, 2]
    lifecycle.purge_job(spark, table, audit, match, "purge", "k2", only_if_inactive=False, partition_by=None)
    assert ids(snapshots.read_version(spark, table)) == ["m3", "m4"]
    assert snapshots.read_version(spark, audit).count() == 2


def test_purge_job_finishes_what_a_dead_run_announced(spark, memory, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    snapshots.write_version(memory, table)
    announced = spark.createDataFrame([("k1", "purge", 2, 1, 3)], "idempotency_key string, action string, version bigint, n_removed bigint, n_left bigint")
    snapshots.write_version(announced, audit)
    lifecycle.purge_job(spark, table, audit, lifecycle.source_match("w", reference_id="r1"), "purge", "k1", partition_by=None)
    assert ids(snapshots.read_version(spark, table)) == ["m1", "m3", "m4"]


def test_purge_of_a_dead_run_happens_after_another_job(spark, memory, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    snapshots.write_version(memory, table)
    announced = spark.createDataFrame([("k1", "purge", 2, 1, 3)], "idempotency_key string, action string, version bigint, n_removed bigint, n_left bigint")
    snapshots.write_version(announced, audit)  # job k1 died here
    lifecycle.purge_job(spark, table, audit, lifecycle.source_match("v", memory_id="m4"), "purge", "k2", only_if_inactive=False, partition_by=None)
    for _ in range(2):
        lifecycle.purge_job(spark, table, audit, lifecycle.source_match("w", reference_id="r1"), "purge", "k1", partition_by=None)
    assert ids(snapshots.read_version(spark, table)) == ["m1", "m3"]
    assert snapshots.versions(spark, table) == [1, 2, 3]


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [
            ("m1", None, "a", "d", "hello", True, None, None, 0.5),
            ("m2", "w", None, "d", "hello", None, "cold", None, 0.9),
            ("m3", "w", None, "d2", "hello", True, "hot", ["r1"], 0.1),
            ("m4", None, "a", None, None, False, None, ["r1"], 0.2),
            ("m5", None, "a", None, None, True, None, ["r1"], 0.2),
        ],
        "memory_id string, workspace_id string, agent_id string, dataset_name string, text string, is_active boolean, "
        "tier string, source_event_ids array<string>, importance double",
    )


def test_nulls_survive_what_does_not_name_them(spark, gaps, tmp_path):
    everything = ["m1", "m2", "m3", "m4", "m5"]
    match = lifecycle.source_match("w", reference_id="r1")
    left = ["m1", "m2", "m4", "m5"]
    assert ids(lifecycle.purged(gaps, match, only_if_inactive=False)) == left and ids(lifecycle.purged(gaps, match)) == everything
    assert {r.memory_id: r.is_active for r in lifecycle.soft_deleted(gaps, match).collect()} == {"m1": True, "m2": None, "m3": False, "m4": False, "m5": True}
    assert ids(lifecycle.purged(gaps, lifecycle.dataset_match("w", "d"), only_if_inactive=False)) == ["m1", "m3", "m4", "m5"]
    assert ids(lifecycle.cold_purged(gaps, lifecycle.CONFIRM_COLD)) == ["m1", "m3", "m4", "m5"]
    assert {r.kept_id: r.n_merged for r in lifecycle.compressed(gaps).collect()} == {"m1": 1, "m2": 2, "m4": 1, "m5": 1}
    table, audit, snapshot = (str(tmp_path / n) for n in "tas")
    snapshots.write_version(gaps, table, "workspace_id")
    assert ids(snapshots.read_version(spark, table)) == everything
    report = lifecycle.purge_job(spark, table, audit, match, "purge", "k", only_if_inactive=False).first()
    assert (report.n_removed, report.n_left) == (1, 4) and ids(snapshots.read_version(spark, table)) == left
    assert all(r.verified for r in snapshots.export_snapshot(gaps, snapshot, "workspace_id").collect())
    assert spark.read.parquet(snapshot).count() == 5


def test_a_purge_rewrites_only_partitions_with_matches(spark, memory, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    snapshots.write_version(memory.union(memory.where("memory_id = 'm3'").replace("m3", "m5").withColumn("workspace_id", F.lit(None).cast("string"))), table, "workspace_id")
    for job, match, want in (
        ("k1", lifecycle.source_match("v", memory_id="m4"), ["m1", "m2", "m3", "m5"]),
        ("k2", lifecycle.source_match("w", reference_id="r1"), ["m3", "m5"]),
        ("k3", F.col("workspace_id").isNull(), ["m3"]),
        ("k4", F.lit(True), []),
    ):
        lifecycle.purge_job(spark, table, audit, match, "purge", job, only_if_inactive=False)
        now = snapshots.read_version(spark, table)
        assert ids(now) == want and sorted(now.columns) == sorted(memory.columns)
    second = next(p for p in (tmp_path / "t").iterdir() if p.name.startswith("v=2"))
    assert not [p for p in second.iterdir() if p.name.startswith("workspace_id=w")]


def test_null_keys_are_keys(spark):
    states = spark.createDataFrame([("s1", None, 1), ("s2", None, 2), ("s3", "k", 1)], "id string, key string, at int")
    got = {r.id: (r.is_active, r.superseded_by) for r in lifecycle.conflict_winners(states, "key", "id", ["at"]).collect()}
    assert got == {"s1": (False, "s2"), "s2": (True, None), "s3": (True, None)}


def test_hand_offs_across_gaps(spark):
    turns = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("s", 4, "c"), (None, 1, "a"), (None, 9, "c")], "session_id string, seq int, agent_id string")
    got = {(r.from_agent_id, r.to_agent_id): r.n_handoffs for r in tasks.handoffs(turns).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 1, ("a", "c"): 1}


def test_replay_of_a_limited_slice(spark):
    log = spark.range(100).selectExpr("id AS lsn", "'t' AS event_type")
    row = lifecycle.replay_preview(log, from_lsn=10, limit=25).first()
    assert (row.n_events, row.first_lsn, row.last_lsn) == (25, 10, 34)


def test_traces_have_no_depth_limit_of_their_own(spark):
    edges = spark.range(12).selectExpr("cast(id AS string) AS src_id", "cast(id + 1 AS string) AS dst_id")
    roots = spark.createDataFrame([("0",)], "root_id string")
    assert graph.proof_trace(roots, edges).agg(F.max("depth")).first()[0] == 12
    assert graph.proof_trace(roots, edges, max_depth=3).agg(F.max("depth")).first()[0] == 3


def test_cold_purge_needs_confirm(memory):
    with pytest.raises(ValueError, match="confirm"):
        lifecycle.cold_purged(memory, confirm="yes")
    assert lifecycle.cold_purged(memory, dry_run=True).first().n_cold == 2
    assert ids(lifecycle.cold_purged(memory, confirm="purge_cold_tier")) == ["m1", "m4"]


def test_rollback(memory):
    assert ids(lifecycle.rolled_back(memory, "m2", "reactivate").where("is_active")) == ["m1", "m2", "m3", "m4"]
    with pytest.raises(ValueError):
        lifecycle.rolled_back(memory, "m2", "undo")


def test_governance_switch(spark, memory):
    policies = spark.createDataFrame([("m1", "deny"), ("m3", "allow")], "object_id string, effect string")
    assert ids(lifecycle.governed(memory, policies)) == ["m2", "m3", "m4"]
    assert lifecycle.governed(memory, policies, enabled=False).count() == 4


def test_unknown_filter_columns_fail(memory):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        filters.scoped(memory, filters.QueryRequest(filter_expr="nope = 1"))


def test_list_parameters_and_limit(memory):
    assert ids(filters.listed(memory, {"workspace_id": "w"}, 2, "memory_id")) == ["m1", "m2"]


@pytest.mark.parametrize("session,dataset,file_name,expected", [
    ("", "ds", "foo.fbin", "ingest_ds_foo.fbin"), (" s_custom ", "ds", "foo.fbin", "s_custom"),
    ("", None, "foo.fbin", "query_w"), ("", "ds", None, "query_w"), (None, " ", "f", "query_w"),
])
def test_session_rule(spark, session, dataset, file_name, expected):
    row = spark.createDataFrame([("w", dataset, file_name, session)], "w string, d string, f string, s string")
    assert row.select(filters.session_for(F.col("w"), F.col("d"), F.col("f"), F.col("s"))).first()[0] == expected


def test_trace_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b", "x"), ("b", "c", "x"), ("c", "a", "x"), ("a", "c", "x")], "src_id string, dst_id string, edge_type string")
    roots = spark.createDataFrame([("a",)], "root_id string")
    got = {r.node_id: r.depth for r in graph.proof_trace(roots, edges).collect()}
    assert got == {"a": 0, "b": 1, "c": 1}
    assert graph.proof_trace(roots, edges, max_depth=0).count() == 1


def reached_by_hand(roots, edges, max_depth):
    out, want = {}, set()
    for a, b in edges:
        if a is not None and b is not None:
            out.setdefault(a, set()).add(b)
    for root in set(roots):
        level, seen, depth = {root}, {root}, 0
        while level:
            want |= {(root, node, depth) for node in level}
            depth += 1
            level = {b for a in level for b in out.get(a, ())} - seen if max_depth is None or depth <= max_depth else set()
            seen |= level
    return want


@pytest.mark.parametrize("max_depth", [None, 1, 3])
@pytest.mark.parametrize("n_nodes,n_edges", [(12, 20), (60, 70)])
def test_traces_of_many_roots(spark, n_nodes, n_edges, max_depth):
    """Random graphs with cycles and diamonds, entered by many roots through few nodes, some roots inside."""
    rng = random.Random(n_nodes)
    edges = [(f"n{rng.randrange(n_nodes)}", f"n{rng.randrange(n_nodes)}") for _ in range(n_edges)]
    edges += [(f"r{i}", f"n{rng.randrange(4)}") for i in range(40)] + [(None, "n1"), ("n1", None), ("r1", "r2")]
    roots = [f"r{i}" for i in range(40)] + ["n0", "n0", "lonely", None]
    got = graph.proof_trace(
        spark.createDataFrame([(r,) for r in roots], "root_id string"), spark.createDataFrame(edges, "src_id string, dst_id string"), max_depth
    ).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == reached_by_hand(roots, edges, max_depth)


def test_a_shared_path_is_walked_once(spark, monkeypatch):
    """Rows pinned beyond the first level don't depend on the number of roots."""
    chain = spark.range(6).selectExpr("concat('n', id) AS src_id", "concat('n', id + 1) AS dst_id")
    walked = []

    def counted(df):
        pinned = materialize(df)
        walked.append(pinned.count())
        return pinned

    monkeypatch.setattr(graph, "materialize", counted)
    for n_roots in (10, 100):
        walked.clear()
        roots = spark.range(n_roots).selectExpr("concat('r', id) AS root_id")
        edges = chain.unionByName(roots.selectExpr("root_id AS src_id", "'n0' AS dst_id"))
        assert graph.proof_trace(roots, edges).count() == 8 * n_roots
        assert walked == [n_roots, 1, 1, 1, 1, 1, 1, 0]


def test_calls_meet_their_first_later_result(spark):
    """Against every pair by hand: a hot session over several partitions, equal times, odd rows."""
    rng = random.Random(5)
    data = [(f"e{i}", rng.choice(["hot"] * 4 + ["s1", "s2", None]), rng.choice(["call", "call", "result", "other"]), rng.randrange(300)) for i in range(600)]
    data += [("late", "hot", "call", 1000), ("untimed", "hot", "call", None), ("void", "hot", "result", None), ("alone", "s3", "call", 5)]
    events = spark.createDataFrame(data, "event_id string, session_id string, event_type string, at int").selectExpr(
        "*", "timestampadd(SECOND, at, timestamp_ntz'2024-01-01') AS event_time", "'clash' AS result_id").repartition(8)
    got = {r.event_id: (r.result_id, r.wait_ms) for r in graph.matched_results(events, "call", "result").collect()}
    want = {}
    for name, session, kind, at in data:
        if kind == "call":
            later = [(t, n) for n, s, k, t in data if k == "result" and None not in (t, at, session) and s == session and t > at]
            want[name] = (min(later)[1], (min(later)[0] - at) * 1000.0) if later else (None, None)
    assert got == want and got["late"] == got["untimed"] == (None, None)
    assert graph.matched_results(events.where("false"), "call", "result").count() == 0


def test_sketches_of_windows_merge(spark):
    """Any range of windows, also from two batches, within the stated bounds; null times, agents and payloads stay counted."""
    events = spark.range(40_000).selectExpr(
        "timestampadd(HOUR, cast(id % 240 AS int), timestamp_ntz'2024-01-01') AS event_time", "'w' AS workspace_id",
        "if(id % 2 = 0, 'a', 'b') AS event_type", "concat('a', id % 6000) AS agent_id", "repeat('x', cast(id % 1000 AS int)) AS payload")
    odd = spark.sql("SELECT timestamp_ntz'2024-01-03' AS event_time, 'w' AS workspace_id, 'odd' AS event_type, "
                    "cast(null AS string) AS agent_id, cast(null AS string) AS payload UNION ALL SELECT null, 'w', 'odd', 'x', 'y'")
    stored = sketches.sketched(events.where("payload > 'xxx'")).unionByName(sketches.sketched(events.where("NOT payload > 'xxx'"))).unionByName(sketches.sketched(odd))
    assert stored.agg(F.sum("n_events")).first()[0] == 40_002
    days = F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-01-07").cast("timestamp_ntz")
    got = {r.event_type: r for r in sketches.of_range(stored, *days).collect()}
    part = events.where((F.col("event_time") >= days[0]) & (F.col("event_time") < days[1])).withColumn("size", F.length("payload"))
    for r in part.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count_distinct("agent_id").alias("agents")).collect():
        mine = got[r.event_type]
        assert (mine.n_events, mine.payload_bytes) == (r.n, r.bytes) and abs(mine.n_agents - r.agents) <= 0.07 * r.agents
        for share, value in ((0.5, mine.payload_p50), (0.95, mine.payload_p95)):
            below = part.where((F.col("event_type") == r.event_type) & (F.col("size") <= value)).count()
            assert abs(below / r.n - share) < 0.03
    assert (got["odd"].n_events, got["odd"].n_agents, got["odd"].payload_p50, got["odd"].payload_bytes) == (1, 0, None, None)


def test_pending_calls_need_a_later_result(spark):
    events = spark.createDataFrame(
        [(1, "s", "call", 10), (2, "s", "result", 20), (3, "s", "call", 20), (4, "t", "call", 5)],
        "event_id int, session_id string, event_type string, event_time int",
    )
    assert sorted(r.event_id for r in graph.pending_calls(events, "call", "result").collect()) == [3, 4]


def test_sharing_has_no_duplicates(spark, memory):
    contracts = spark.createDataFrame([("a", "b", "w"), ("a", "b", "w"), ("a", "a", "w"), ("b", "c", "v")],
                                      "owner_agent_id string, grantee_agent_id string, workspace_id string")
    got = sorted((r.viewer_agent_id, r.memory_id) for r in graph.shared_view(memory, contracts).collect())
    assert got == [("a", "m1"), ("a", "m2"), ("a", "m4"), ("b", "m1"), ("b", "m2"), ("b", "m3")]


def test_first_claim_wins(spark):
    attempts = spark.createDataFrame([(1, "x", 5, 1), (1, "y", 4, 2), (1, "z", 4, 1)], "task_id int, agent_id string, claimed_at int, order_key int")
    assert [r.agent_id for r in tasks.claims(attempts).where("is_winner").collect()] == ["z"]


def test_evaluation(spark):
    truth = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "task_id int, object_id string")
    retrieved = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z")], "task_id int, object_id string")
    got = {r.task_id: (r.recall, r.hit) for r in tasks.retrieval_eval(retrieved, truth).collect()}
    assert got == {1: (0.5, True), 2: (0.0, False)}


@pytest.mark.parametrize("lines,family,provider,dim,fusion", [
    (["embedding_runtime_family=onnx:minilm", "embedding_runtime_dim=384", "cross_dim_fusion=rrf_result_layer"], "onnx:minilm", "onnx", 384, True),
    (["embedding_runtime_family=tfidf", "embedding_runtime_dim=256"], "tfidf", "tfidf", 256, False),
    ([None, " ", "embedding_runtime_family=a:b", " embedding_runtime_family=c "], "c", "c", None, False),
    (None, "", "", None, False),
])
def test_provenance(spark, lines, family, provider, dim, fusion):
    info = spark.createDataFrame([(lines,)], "p array<string>").select(runtime_info(F.col("p")).alias("i")).first().i
    assert (info.family, info.provider, info.dim, info.cross_dim_fusion) == (family, provider, dim, fusion)


@pytest.mark.parametrize("given,expected", [(None, "HNSW"), ("", "HNSW"), (" ivf_pq ", "IVF_PQ"), ("btree", None)])
def test_index_names(spark, given, expected):
    assert spark.createDataFrame([(given,)], "t string").select(collections.index_type_of(F.col("t"))).first()[0] == expected


def test_hits_of_every_shape(spark):
    bodies = [
        ('{"object_id": "o", "memory_id": "m", "score": 0.9, "payload": {"page_content": "text", "metadata": {"k": "v", "id": "old"}}}', "text", "o", 0.9),
        ('{"memory_id": "m", "distance": 0.2}', "", "m", 0.2), ('{"event_id": "e"}', "", "e", 0.0), ("plain", "", "plain", 0.0),
    ]
    hits = spark.createDataFrame([(i, b[0]) for i, b in enumerate(bodies)], "i int, body string")
    for row in embedding.project_hits(hits, "body").collect():
        _, content, identifier, score = bodies[row.i]
        assert (row.page_content, row.metadata["id"], row.score) == (content, identifier, score)


class Lengths:
    built = 0

    def embed_documents(self, texts):
        assert len(texts) <= 32
        return [[float(len(t)), 1.0] for t in texts]

    def embed_query(self, text):
        return [float(len(text)), 1.0]


def test_only_rows_without_vector_are_embedded(spark):
    rows = spark.createDataFrame([(1, "abc", None), (2, "abc", [9.0, 9.0]), (3, None, None), (4, "", None)], "id int, text string, v array<float>")
    got = {r.id: r.v for r in embedding.embed_if_missing(rows, Lengths, "text", "v").collect()}
    assert got == {1: [3.0, 1.0], 2: [9.0, 9.0], 3: None, 4: None}


def test_vector_without_document_is_still_a_hit(spark):
    vectors = spark.createDataFrame([("a", [3.0, 1.0]), ("lost", [3.0, 1.0])], "object_id string, embedding array<float>")
    events = spark.createDataFrame([("a", ("text", {"k": "v"}))], "event_id string, payload struct<page_content: string, metadata: map<string,string>>")
    queries = spark.createDataFrame([(1, "abc")], "query_id bigint, query_text string")
    rows = embedding.similarity_search(queries, vectors, events, Lengths).orderBy("rank").collect()
    assert [(r.object_id, r.page_content) for r in rows] == [("a", "text"), ("lost", None)]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    table, audit = f"{tmp_path}/memory", f"{tmp_path}/audit"
    memory = spark.createDataFrame([(f"m{i}", "w", False) for i in range(6)], "memory_id string, workspace_id string, is_active boolean")
    assert snapshots.write_version(memory, table, based_on=0) == 1
    with pytest.raises(snapshots.Conflict):
        snapshots.write_version(memory, table, based_on=0)
    # both make the next number: the first to commit has it, the other changes nothing
    number, name = snapshots._next(spark, table, 1), None
    assert snapshots.write_version(memory.where("memory_id <> 'm0'"), table, based_on=1) == number
    with pytest.raises(snapshots.Conflict):
        snapshots._commit(spark, table, number, "v=2-0-other")
    assert ids(snapshots.read_version(spark, table)) == [f"m{i}" for i in range(1, 6)]
    # a purge that another one overtakes is made anew on what that one left
    original, calls = snapshots.write_changed, []

    def overtaken(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            lifecycle.purge_job(spark, table, audit, F.col("memory_id") == "m1", "purge", "k1")
        return original(*args, **kwargs)

    monkeypatch.setattr(snapshots, "write_changed", overtaken)
    lifecycle.purge_job(spark, table, audit, F.col("memory_id") == "m2", "purge", "k2")
    assert len(calls) == 3 and ids(snapshots.read_version(spark, table)) == ["m3", "m4", "m5"]
    # a writer that died while it committed leaves a number without a version
    (tmp_path / "memory" / "_commits" / "5").write_text("")
    assert snapshots.versions(spark, table) == [1, 2, 3, 4]
    assert snapshots.write_version(memory, table, based_on=4) == 6
    (tmp_path / "memory" / "v=7-0-unfinished").mkdir()
    assert snapshots.versions(spark, table)[-1] == 6
