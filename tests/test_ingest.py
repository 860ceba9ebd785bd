"""Batches, accounting, ids, chunks and files, on the cases users know."""

import gzip
import os
import struct

import pytest
from pyspark.sql import functions as F

from engrama.operators import ingest, numbering
from engrama.sources import bulk_load, fbin, snapshots, wal
from engrama.session import work_dir


def write_fbin(path, n, dim, fill=0.25, cut=0):
    body = struct.pack("<II", n, dim) + struct.pack("<f", fill) * (n * dim)
    path.write_bytes(body[: len(body) - cut])
    return str(path)


# --- numbering ---------------------------------------------------------------


@pytest.fixture
def many_segments(spark):
    """Small inputs would otherwise be coalesced into a single partition."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_dense_numbers_with_one_hot_key(spark, many_segments):
    rows = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    numbered = numbering.dense_number(rows, ["id"], keys=["key"])
    hot = [r.row_index for r in numbered.where("key = 'hot'").orderBy("id").collect()]
    assert hot == list(range(1500))
    assert numbered.where("key <> 'hot' and row_index <> 0").count() == 0
    # the hot key did not end up in one partition
    segments = numbering.pinned_segments(rows, ["key"], ["id"])
    assert segments.where("key = 'hot'").select("_segment").distinct().count() > 1


def test_dense_numbers_over_the_table(spark, many_segments):
    numbered = numbering.dense_number(spark.range(1000).repartition(7), ["id"])
    assert numbered.where("row_index <> id").count() == 0


def test_running_total_with_one_hot_key(spark, many_segments):
    rows = spark.range(1000).select(F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id")).alias("key"), "id", F.lit(2).alias("v"))
    got = {(r.key, r.id): r.running_total for r in numbering.running_total(rows, ["key"], ["id"], "v").collect()}
    total = 0
    for i in range(1000):
        if i % 4 > 0 or i == 1:
            total += 2
            assert got[(1, i)] == total


# --- batches -----------------------------------------------------------------


def batches(spark, n, size, bad=()):
    rows = spark.range(n).withColumn("error", F.when(F.col("id").isin(*bad) if bad else F.lit(False), "server error"))
    return ingest.batch_ranges(rows, ["id"], size)


def test_ten_vectors_in_batches_of_three_with_one_failing(spark):
    accounted = ingest.whole_batch_accounting(batches(spark, 10, 3, bad=[4]), "error")
    totals = ingest.batch_totals(accounted).first()
    assert (totals.total_count, totals.accepted_count, totals.failed_count, totals.batch_count) == (10, 7, 3, 4)
    assert not totals.success
    failed = accounted.where("failed_count > 0").first()
    assert (failed.batch_index, failed.batch_start, failed.batch_end, failed.error_type) == (1, 3, 6, "ValueError")


def test_strict_mode_raises_on_the_first_failed_batch(spark):
    with pytest.raises(ValueError, match=r"Batch 1 failed \(items 3-6\)"):
        ingest.raise_on_first(ingest.whole_batch_accounting(batches(spark, 10, 3, bad=[4, 8]), "error"))


def test_strict_mode_passes_good_batches(spark):
    assert ingest.raise_on_first(ingest.whole_batch_accounting(batches(spark, 10, 3), "error")).count() == 4


def test_batch_boundaries_keep_ids_together(spark):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate("abcde")], "i int, id string")
    batched = ingest.batch_ranges(rows, ["i"], 2)
    got = {r.batch_index: r.ids for r in batched.groupBy("batch_index").agg(F.array_sort(F.collect_list("id")).alias("ids")).collect()}
    assert got == {0: ["a", "b"], 1: ["c", "d"], 2: ["e"]}


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError, match="at least 1"):
        batches(spark, 3, 0)


def test_one_refused_event_fails_alone(spark):
    counted = ingest.row_accounting(batches(spark, 3, 500, bad=[1]), "error").first()
    assert (counted.accepted_count, counted.failed_count, counted.first_error_index) == (2, 1, 1)


def test_no_rows_give_an_empty_success(spark):
    totals = ingest.batch_totals(ingest.whole_batch_accounting(batches(spark, 0, 3), "error")).first()
    assert (totals.total_count, totals.batch_count, totals.success) == (0, 0, True)


def test_ten_errors_show_five(spark):
    errors = spark.range(10).select(F.col("id").alias("batch_index"), F.format_string("error %d", "id").alias("error"), F.lit(1).alias("failed_count"))
    message = ingest.error_summary(errors).first().message
    assert message.startswith("Batch operation failed: 10 items failed across 10 batches. Errors: batch 0: error 0; ")
    assert message.endswith("batch 4: error 4 ... and 5 more errors")


def test_no_errors_give_no_message(spark):
    assert ingest.error_summary(spark.range(0).select(F.col("id").alias("batch_index"), F.lit("x").alias("error"), F.lit(1).alias("failed_count"))).count() == 0


def test_merged_totals(spark):
    a = ingest.batch_totals(ingest.whole_batch_accounting(batches(spark, 10, 3, bad=[4]), "error"))
    b = ingest.batch_totals(ingest.whole_batch_accounting(batches(spark, 5, 5), "error"))
    merged = ingest.merge_totals([a, b]).first()
    assert (merged.total_count, merged.accepted_count, merged.failed_count, merged.batch_count, merged.success) == (15, 12, 3, 5, False)


@pytest.mark.parametrize("vector,object_id,reason", [
    ([1.0, 2.0], "ok", None), ([], "e", "empty vector"), (None, "n", "empty vector"),
    ([1.0], "short", "dimension differs from the batch"), ([1.0, 2.0], "x" * 5000, "object id too long"),
])
def test_vector_checks(spark, vector, object_id, reason):
    rows = spark.createDataFrame([(0, "s", "first", [0.0, 0.0]), (1, "s", object_id, vector)],
                                 "i int, segment_id string, object_id string, embedding array<double>")
    assert ingest.validate_vectors(rows, ["segment_id"], "i").where("i = 1").first().reject_reason == reason


# --- ids, records, documents --------------------------------------------------


def test_slug_ids(spark):
    row = spark.range(1).select(
        ingest.event_slug_id(F.lit(" my data! "), F.lit("é"), F.lit(7)).alias("a"),
        ingest.event_slug_id(F.lit("d"), F.lit("f-1"), F.lit(7), F.lit("b 1")).alias("b"),
        ingest.file_stem(F.lit("a.b.fbin")).alias("stem"), ingest.file_stem(F.lit(".fbin")).alias("hidden"),
    ).first()
    assert row.a == "evt_my_data_file_00000007"
    assert row.b == "evt_d_b_1_f-1_00000007"
    assert (row.stem, row.hidden) == ("a.b", ".fbin")


def test_records_are_routed(spark):
    rows = spark.createDataFrame(
        [(0, [1.0], None, "own", "obj"), (1, None, "hello", None, None), (2, [2.0], "x", None, "obj2"), (3, [3.0], None, None, None), (4, None, "", None, None)],
        "k int, vector array<double>, text string, id string, object_id string",
    )
    vectors, documents = ingest.route_records(rows, "c", ["k"])
    assert sorted(r.object_id for r in vectors.collect()) == ["c_3", "obj2", "own"]
    assert [r.text for r in documents.collect()] == ["hello"]


@pytest.mark.parametrize("length,expected", [(0, [""]), (5, ["01234"]), (10, ["0123456789"]), (12, ["0123456789", "8901"])])
def test_chunks(spark, length, expected):
    text = "".join(str(i % 10) for i in range(length))
    rows = spark.createDataFrame([(1, text)], "id int, text string")
    got = ingest.document_chunks(rows, ["id"], "text", size=10, overlap=2).orderBy("segment_index").collect()
    assert [r.chunk for r in got] == expected
    assert {r.segment_total for r in got} == {len(expected)}


def test_overlap_must_be_smaller_than_the_chunk(spark):
    with pytest.raises(ValueError):
        ingest.document_chunks(spark.createDataFrame([(1, "x")], "id int, text string"), ["id"], "text", size=5, overlap=5)


def test_upload_parts(spark):
    parts = spark.createDataFrame([("u", 1, 2, "b"), ("u", 0, 2, "a"), ("v", 2, 3, "z")],
                                  "upload_batch_id string, segment_index int, segment_total int, text string")
    status = {r.upload_batch_id: (r.complete, r.n_missing) for r in ingest.upload_status(parts).collect()}
    assert status == {"u": (True, 0), "v": (False, 2)}
    assert [tuple(r) for r in ingest.assembled_text(parts).collect()] == [("u", 0, "a\nb")]
    pages = ingest.assembled_text(parts, page_chars=2).orderBy("page").collect()
    assert [tuple(r) for r in pages] == [("u", 0, "a"), ("u", 1, "b")]
    assert sorted(map(tuple, ingest.missing_parts(parts).collect())) == [("v", 0), ("v", 1)]


def test_canonical_event_fields(spark):
    raw = spark.createDataFrame([("w", "hello")], "workspace_id string, text string").selectExpr(
        "null as event_id", "null as tenant_id", "workspace_id", "null as agent_id", "null as session_id", "null as event_type",
        "text", "cast(null as map<string,string>) as payload", "null as source", "cast(null as int) as version",
    )
    event = ingest.canonical_events(raw, F.lit("2024-05-01 10:00:00.5").cast("timestamp"), "src", "agent").first()
    assert event.event_id == "evt_emb_w_1714557600500"
    assert (event.tenant_id, event.session_id, event.event_type, event.version) == ("t_demo", "ingest_w", "observation", 1)
    assert str(event.event_time) == "2024-05-01 10:00:00" and event.event_time == event.ingest_time == event.visible_time
    assert event.payload == {"text": "hello"}


# --- vector files --------------------------------------------------------------


@pytest.mark.parametrize("n,dim", [(0, 4), (1, 2), (3, 4)])
def test_vector_file_rows(spark, tmp_path, n, dim):
    path = write_fbin(tmp_path / "t.fbin", n, dim)
    rows = fbin.read(spark, path).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(n))
    assert all(r.vector == [0.25] * dim and r.dim == dim for r in rows)
    header = fbin.read(spark, path, mode="header").first()
    assert (header.n, header.dim) == (n, dim)


def test_row_limit(spark, tmp_path):
    path = write_fbin(tmp_path / "t.fbin", 3, 2)
    assert fbin.read(spark, path, limit=2).count() == 2
    assert fbin.read(spark, path, mode="header", limit=2).first().n == 2


def test_small_splits_read_every_row_once(spark, tmp_path):
    path = write_fbin(tmp_path / "t.fbin", 100, 4)
    rows = fbin.read(spark, path, splitBytes=7 * 16)
    assert rows.rdd.getNumPartitions() == 15
    assert sorted(r.row_index for r in rows.collect()) == list(range(100))


@pytest.mark.parametrize("content,message", [
    (b"\x01\x00", "header"), (struct.pack("<II", 1, 0), "dimension"), (struct.pack("<II", 1, 100_001), "dimension"),
])
def test_bad_headers(spark, tmp_path, content, message):
    path = tmp_path / "bad.fbin"
    path.write_bytes(content)
    with pytest.raises(Exception, match=message):
        fbin.read(spark, str(path)).collect()


def test_truncated_row(spark, tmp_path):
    path = write_fbin(tmp_path / "t.fbin", 3, 2, cut=4)
    with pytest.raises(Exception, match="ends in row 2"):
        fbin.read(spark, path).collect()


def test_appends_add_up(spark, tmp_path):
    path = str(tmp_path / "out")
    for low, high in ((0, 4), (4, 7)):
        rows = spark.range(low, high).selectExpr("id", "array(cast(id AS float), 1f) AS vector")
        fbin.write(rows, path, "vector", order="id", fileBytes=16)
    got = fbin.read(spark, path).orderBy("file_name", "row_index").collect()
    assert sorted(r.vector[0] for r in got) == [0, 1, 2, 3, 4, 5, 6]
    assert [r.vector[0] for r in got] == [0, 1, 2, 3, 4, 5, 6]
    assert not [p for p in os.listdir(path) if p.startswith("_pending")]


def test_frames_are_cut_per_key(spark):
    rows = spark.range(10).selectExpr("id", "if(id < 7, 's', NULL) AS segment_id")
    got = ingest.framed(rows, ["segment_id"], "id", frame_rows=3).groupBy("segment_id", "frame").count().collect()
    assert sorted((r.segment_id or "", r.frame, r["count"]) for r in got) == [("", 0, 3), ("s", 0, 3), ("s", 1, 3), ("s", 2, 1)]


@pytest.mark.parametrize("args", [(0, 1), (20_000, 1), (8, 0), (8, 70_000), (8, 3, 2)])
def test_query_frames_are_checked(args):
    with pytest.raises(ValueError):
        ingest.check_query(*args)
    ingest.check_query(8, 3, 3)


def test_other_suffix_is_refused(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="only .fbin"):
        fbin.read(spark, str(path)).collect()


def test_bulk_upload_returns_rows_and_dry_run_writes_nothing(spark, tmp_path):
    path, table = write_fbin(tmp_path / "t.fbin", 2, 2), str(tmp_path / "events")
    assert bulk_load.bulk_upload(spark, "ds", "w", path, table, dry_run=True) == 1
    assert not (tmp_path / "events").exists()
    assert bulk_load.bulk_upload(spark, "ds", "w", path, table) == 2
    first = spark.read.parquet(table).orderBy("event_id").first()
    assert (first.event_id, first.session_id, first.payload.dataset) == ("evt_ds_t_00000000", "ingest_ds_t.fbin", "ds")
    assert first.payload.text == "dataset=t.fbin dataset_name:ds row:0 dim:2 dtype:float32 head:0.25 0.25"
    assert len(first.embedding_vector) == 2


def test_dry_run_of_an_empty_file(spark, tmp_path):
    assert bulk_load.bulk_upload(spark, "ds", "w", write_fbin(tmp_path / "e.fbin", 0, 2), "unused", dry_run=True) == 0


def test_every_load_has_its_own_batch():
    assert bulk_load.new_import_batch_id() != bulk_load.new_import_batch_id()
    assert bulk_load.new_import_batch_id().startswith("load-")


# --- log -----------------------------------------------------------------------


def scan(spark, tmp_path, text, **options):
    (tmp_path / "a.log").write_bytes(text.encode())
    return wal.scan_log(spark, str(tmp_path), **options).collect()


def test_frame_with_heartbeat(spark, tmp_path):
    rows = scan(spark, tmp_path, 'event: wal\ndata: {"lsn": 7, "event": {"k": 1}}\n\n: keep-alive\n\n')
    assert [(r.lsn, r.event) for r in rows] == [(7, '{"k":1}')]


def test_unfinished_last_frame_is_not_read(spark, tmp_path):
    rows = scan(spark, tmp_path, 'event: wal\ndata: {"lsn": 1, "event": {}}\n\nevent: wal\ndata: {"lsn": 2, "event": {}}\n')
    assert [r.lsn for r in rows] == [1]


def test_several_data_lines_and_other_events(spark, tmp_path):
    rows = scan(spark, tmp_path, 'event: wal\ndata:   {"lsn": 3,\ndata: "event": {"a": "b"}}\n\nevent: other\ndata: {"lsn": 4}\n\ndata: {"lsn": 5}\n\n')
    assert [(r.lsn, r.event) for r in rows] == [(3, '{"a":"b"}')]


def test_bad_json_is_kept_as_such(spark, tmp_path):
    rows = scan(spark, tmp_path, "event: wal\ndata: {broken\n\n")
    assert [(r.parse_error, r.raw) for r in rows] == [(True, "{broken")]


def test_bad_json_has_no_position_to_be_behind(spark, tmp_path):
    text = 'event: wal\ndata: {broken\n\nevent: wal\ndata: {"lsn": 1, "event": {}}\n\nevent: wal\ndata: {"lsn": 5, "event": {}}\n\n'
    assert sorted(str(r.lsn) for r in scan(spark, tmp_path, text, from_lsn=2)) == ["5", "None"]


def test_a_compressed_log_is_finished(spark, tmp_path):
    text = "".join(f'event: wal\ndata: {{"lsn": {i}, "event": {{}}}}\n\n' for i in range(100))
    (tmp_path / "a.log.gz").write_bytes(gzip.compress(text.encode()))
    assert wal.scan_log(spark, str(tmp_path)).count() == 100


def test_windows_line_ends(spark, tmp_path):
    rows = scan(spark, tmp_path, 'event: wal\r\ndata: {"lsn": 7, "event": {}}\r\n\r\n', newline="\r\n")
    assert [r.lsn for r in rows] == [7]


def test_from_position(spark, tmp_path):
    text = "".join(f'event: wal\ndata: {{"lsn": {i}, "event": {{}}}}\n\n' for i in range(5))
    assert sorted(r.lsn for r in scan(spark, tmp_path, text, from_lsn=3)) == [3, 4]


# --- versions ------------------------------------------------------------------


def test_versions_and_unfinished_writes(spark, tmp_path):
    root = str(tmp_path / "t")
    snapshots.write_version(spark.range(3), root)
    snapshots.write_version(spark.range(5), root)
    (tmp_path / "t" / "v=3").mkdir()  # a write that died
    assert snapshots.versions(spark, root) == [1, 2]
    assert snapshots.read_version(spark, root).count() == 5
    assert snapshots.read_version(spark, root, 1).count() == 3


def test_hot_key_is_spread_over_files(spark, many_segments):
    rows = spark.range(1000).withColumn("key", F.when(F.col("id") < 900, "hot").otherwise("cold"))
    parts = snapshots.spread_by(rows, "key", rows_per_file=100).where("key = 'hot'").groupBy(F.spark_partition_id()).count()
    assert parts.count() > 1


def test_few_long_rows_of_a_hot_key_are_spread_by_their_bytes(spark):
    rows = spark.range(200).select("id", F.lit("hot").alias("key"), F.repeat(F.lit("x"), 10_000).alias("text"), F.array(F.lit("ab")).alias("refs"))
    out = snapshots.spread_by(rows, "key", bytes_per_file=100_000)
    held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 200 and len(held) > 8 and max(held) < 100
    assert sorted(out.collect()) == sorted(rows.collect())


def test_work_dir_is_under_the_shared_root(spark):
    assert work_dir(spark, "x") != work_dir(spark, "x")
