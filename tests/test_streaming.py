"""Streams fed batch by batch: late data, duplicates across batches, repeated runs."""

import shutil

from engrama.operators.ingest import materialize_memory
from engrama.sources import wal, wal_stream
from engrama.streaming import jobs

SCHEMA = (
    "event_id string, workspace_id string, agent_id string, session_id string, event_type string, event_time timestamp_ntz, "
    "importance double, payload string, version int"
)


def rows(spark, data):
    full = [(e, "w", "a", "s", "view", t, 1.0, "{}", v) for e, t, v in data]
    return spark.createDataFrame(full, "event_id string, workspace_id string, agent_id string, session_id string, event_type string, "
                                 "event_time string, importance double, payload string, version int").selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in SCHEMA.split(", ")])


def add(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    add(rows(spark, [("e1", "2024-01-01 10:00:00", 1), ("e2", "2024-01-03 10:00:00", 1)]), source)
    stream = lambda: jobs.table_stream(spark, source, rows(spark, []).schema)
    jobs.window_metrics(stream(), out, state)
    add(rows(spark, [("late", "2024-01-01 11:00:00", 1), ("e3", "2024-01-05 10:00:00", 1)]), source)
    jobs.window_metrics(stream(), out, state)
    got = {str(r.window_start)[:10]: (r.n_events, r.n_late, r.closed) for r in jobs.metrics(spark, out).collect()}
    assert got == {"2024-01-01": (2, 1, True), "2024-01-03": (1, 0, True), "2024-01-05": (1, 0, False)}
    add(rows(spark, [("later", "2024-01-03 11:00:00", 1), ("last", "2024-01-01 23:00:00", 1)]), source)
    jobs.window_metrics(stream(), out, state)  # older than all before: how far the stream has come stays
    got = {str(r.window_start)[:10]: (r.n_events, r.n_late, r.closed) for r in jobs.metrics(spark, out).collect()}
    assert got == {"2024-01-01": (3, 2, True), "2024-01-03": (2, 1, True), "2024-01-05": (1, 0, False)}
    kept = sorted((r.batch_id, str(r.latest)) for r in spark.read.parquet(f"{out}/reached").collect())
    assert kept == [(0, "2024-01-03 10:00:00"), (1, "2024-01-05 10:00:00"), (2, "2024-01-05 10:00:00")]


def test_late_events_are_ingested_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stream = lambda: jobs.table_stream(spark, source, rows(spark, []).schema)
    for data in ([("e1", "2024-01-05 10:00:00", 1)], [("late", "2024-01-01 10:00:00", 1)], [("late", "2024-01-01 10:00:00", 1), ("e1", "2024-01-05 10:00:00", 1), (None, None, 1), (None, None, 1)]):
        add(rows(spark, data), source)
        jobs.deduplicated_ingest(stream(), out, state)
    assert sorted(r.event_id or "" for r in jobs.ingested(spark, out).collect()) == ["", "", "e1", "late"]


def test_a_batch_lists_the_days_it_brings(spark, tmp_path, monkeypatch):
    """Events of null and of several days; a run reads no folder of another day, and a run repeated changes nothing."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stream = lambda: jobs.table_stream(spark, source, rows(spark, []).schema)
    asked = []
    exists = jobs.snapshots.exists
    monkeypatch.setattr(jobs.snapshots, "exists", lambda s, path: asked.append(path.rpartition("/")[2]) or exists(s, path))
    days = [("e1", "2024-01-01 10:00:00", 1), ("e2", "2024-01-02 10:00:00", 1), ("e3", None, 1)]
    add(rows(spark, days), source)
    jobs.deduplicated_ingest(stream(), out, state)
    before = shutil.copytree(state, tmp_path / "before")
    asked.clear()
    add(rows(spark, [("e3", None, 1), ("e4", None, 1), ("e2", "2024-01-02 12:00:00", 1), ("e2", "2024-01-03 12:00:00", 1)]), source)
    jobs.deduplicated_ingest(stream(), out, state)
    assert sorted(asked) == ["event_date=2024-01-02", "event_date=2024-01-03", f"event_date={jobs.NULL_DAY}"]
    want = ["e1", "e2", "e2", "e3", "e4"]
    assert sorted(r.event_id for r in jobs.ingested(spark, out).collect()) == want
    jobs.deduplicated_ingest(stream(), out, str(before))  # the second batch once more, as if its end had been lost
    assert sorted(r.event_id for r in jobs.ingested(spark, out).collect()) == want


def test_duplicates_across_runs(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = rows(spark, []).schema
    add(rows(spark, [("e1", "2024-01-01 10:00:00", 1)]), source)
    jobs.deduplicated_ingest(jobs.table_stream(spark, source, schema), out, state)
    add(rows(spark, [("e1", "2024-01-01 10:00:00", 1), ("e2", "2024-01-01 10:01:00", 1)]), source)
    jobs.deduplicated_ingest(jobs.table_stream(spark, source, schema), out, state)
    assert sorted(r.event_id for r in jobs.ingested(spark, out).collect()) == ["e1", "e2"]


def test_materialized_memory_equals_its_batch_twin(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = rows(spark, [("e1", "2024-01-01 10:00:00", 1), ("e2", "2024-01-01 10:00:00", 1)])
    second = rows(spark, [("e1", "2024-01-01 11:00:00", 2)])
    for batch in (first, second):
        add(batch, source)
        jobs.materialization(jobs.table_stream(spark, source, first.schema), out, state)
    got = sorted(map(tuple, jobs.current_memory(spark, out).select("memory_id", "version").collect()))
    want = sorted(map(tuple, materialize_memory(first.unionByName(second)).select("memory_id", "version").collect()))
    assert got == want == [("mem_e1", 2), ("mem_e2", 1)]
    table = str(tmp_path / "table")
    assert jobs.compact_memory(spark, out, table) == 1
    third = rows(spark, [("e2", "2024-01-01 12:00:00", 3), ("e3", "2024-01-01 12:00:00", 1)])
    add(third, source)
    jobs.materialization(jobs.table_stream(spark, source, first.schema), out, state)
    for _ in range(2):
        got = sorted(map(tuple, jobs.current_memory(spark, out, table).select("memory_id", "version").collect()))
        assert got == [("mem_e1", 2), ("mem_e2", 3), ("mem_e3", 1)]
        jobs.compact_memory(spark, out, table)


def test_log_is_followed_across_runs(spark, tmp_path):
    log, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    for start in (0, 10):
        wal.write_log(spark.range(start, start + 10).selectExpr("id as lsn", "concat('e', id) as event_id"), log)
        jobs.wal_tail(wal_stream.follow(spark, log), out, state, from_lsn=5)
    assert sorted(r.lsn for r in spark.read.parquet(out).collect()) == list(range(5, 20))


def test_tasks_complete_or_time_out(spark, tmp_path):
    starts = spark.createDataFrame([(1, "t", "2024-01-01"), (2, "t", "2024-01-01"), (3, "t", "2024-03-01")], "task_id bigint, task_type string, at string").selectExpr(
        "task_id", "task_type", "cast(at as timestamp_ntz) as started_at")
    done = spark.createDataFrame([(1, "2024-01-02"), (9, "2024-03-01")], "task_id bigint, at string").selectExpr("task_id", "cast(at as timestamp_ntz) as finished_at")
    paths = [str(tmp_path / n) for n in ("starts", "done", "out", "state")]
    add(starts, paths[0])
    add(done, paths[1])
    jobs.task_lifecycle(jobs.table_stream(spark, paths[0], starts.schema), jobs.table_stream(spark, paths[1], done.schema), *paths[2:])
    got = {r.task_id: r.outcome for r in jobs.task_outcomes(spark, paths[2]).collect()}
    assert got == {1: "completed", 2: "timed_out"}
    assert [r.task_id for r in jobs.open_tasks(starts, spark.read.parquet(paths[2])).collect()] == [3]


def test_late_completions_correct_outcomes(spark, tmp_path):
    """A completion behind the watermark, after a restart, corrects; one that was too late, or repeated, changes nothing."""
    start_rows = lambda data: spark.createDataFrame(data, "task_id bigint, task_type string, at string").selectExpr(
        "task_id", "task_type", "cast(at as timestamp_ntz) as started_at")
    done_rows = lambda data: spark.createDataFrame(data, "task_id bigint, at string").selectExpr("task_id", "cast(at as timestamp_ntz) as finished_at")
    paths = [str(tmp_path / n) for n in ("starts", "done", "out", "state")]

    def run(starts, done):
        if starts:
            add(start_rows(starts), paths[0])
        if done:
            add(done_rows(done), paths[1])
        jobs.task_lifecycle(
            jobs.table_stream(spark, paths[0], start_rows([]).schema), jobs.table_stream(spark, paths[1], done_rows([]).schema), *paths[2:])
        return {r.task_id: (r.outcome, r.duration_ms) for r in jobs.task_outcomes(spark, paths[2]).collect()}

    day = 86_400_000.0
    first = [(i, "t", "2024-01-01") for i in (1, 2, 3, 4)] + [(5, "t", "2024-01-15"), (None, "t", "2024-01-01")]
    got = run(first, [(1, "2024-01-02"), (99, "2024-01-15"), (None, "2024-01-02"), (6, "2024-01-14")])
    timed_out = ("timed_out", None)
    assert got == {1: ("completed", day), 2: timed_out, 3: timed_out, 4: timed_out}
    # all of these are behind the watermark: in time, too late, in time twice, before the start
    got = run([(6, "t", "2024-01-13")], [(2, "2024-01-03"), (3, "2024-01-12"), (4, "2024-01-05"), (4, "2024-01-04"), (1, "2024-01-03")])
    assert got == {1: ("completed", day), 2: ("completed", 2 * day), 3: timed_out, 4: ("completed", 3 * day), 6: ("completed", day)}
    got = run([(7, "t", "2024-06-01"), (4, "t", "2024-01-01")], [(98, "2024-06-01"), (4, "2024-01-02")])
    assert got[4] == ("completed", 3 * day) and got[5] == timed_out and 7 not in got
    told = spark.read.parquet(paths[2]).groupBy("task_id", "revision").count().where("count > 1")
    assert told.count() == 0


def _frame(lsn, newline="\n", text="x"):
    return f'event: wal{newline}data: {{"lsn": {lsn}, "event": {{"text": "{text}"}}}}{newline}{newline}'


def test_a_growing_log_loses_no_frame(spark, tmp_path):
    log, out, state = (tmp_path / n for n in ("log", "out", "state"))
    log.mkdir()

    def run():
        jobs.wal_tail(wal_stream.follow(spark, str(log)), str(out), str(state))
        return sorted(r.lsn for r in spark.read.parquet(str(out)).collect())

    two = _frame(2, text="é" * 50)
    (log / "a.log").write_bytes((_frame(1) + two).encode()[:-40])  # an unfinished frame, cut within its text
    (log / "_ignored").write_text(_frame(77))
    assert run() == [1]
    (log / "a.log").write_text(_frame(1) + two + _frame(3) + "event: wal\ndata: {")
    assert run() == [1, 2, 3]
    (log / "b.log").write_text(_frame(4) + _frame(5)[:-1])  # only the last newline is missing
    assert run() == [1, 2, 3, 4]
    (log / "b.log").write_text(_frame(4) + _frame(5))
    (log / "a.log").write_text(_frame(1) + two + _frame(3) + _frame(6))
    assert run() == run() == [1, 2, 3, 4, 5, 6]
    texts = {r.lsn: r.event for r in spark.read.parquet(str(out)).collect()}
    assert "é" * 50 in texts[2]


def test_log_ranges_are_cut_between_frames(tmp_path):
    for newline in ("\n", "\r\n"):
        path = tmp_path / f"long{len(newline)}.log"
        path.write_bytes("".join(_frame(i, newline, "w" * (i * 7 % 90)) for i in range(300)).encode() + b"event: cut")
        reader = wal_stream.LogReader({"path": str(path), "newline": newline.encode("unicode_escape").decode(), "splitBytes": "500"})
        end = reader.latestOffset()
        parts = reader.partitions({}, end)
        assert len(parts) > 20 and [p.end for p in parts[:-1]] == [p.start for p in parts[1:]]
        frames = [f for p in parts for f in reader.read(p)]
        assert [int(value.split('"lsn": ')[1].split(",")[0]) for value, _, _ in frames] == list(range(300))
        data = path.read_bytes()
        assert all(data[at:at + len(value.encode())] == value.encode() for value, _, at in frames)
        with path.open("rb") as raw:
            class Source:
                def read_at(self, n, at):
                    raw.seek(at)
                    return raw.read(n)
            for block in (1, 3, 64, 100_000):
                assert wal_stream.last_frame_end(Source(), len(data), reader.separator, block) == len(data) - len("event: cut")
