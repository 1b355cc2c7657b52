import json
import re

import pytest
from pyspark.sql import functions as F

from eventloom.operators.quality import collect_errors
from eventloom.sources.topics import partition_of, read_topic_files
from eventloom.streaming import batches, ingest, keyed, ordering, windows
from eventloom.warehouse import bronze
from samples import COLLECTED, T, event


@pytest.fixture
def drop(tmp_path):
    """Put a file of records into a folder under tmp_path."""

    def put(folder, name, records):
        path = tmp_path / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")
        return str(path)

    return put


def test_restart_takes_only_new_files(spark, drop, tmp_path):
    landing = drop("in", "a.jsonl", COLLECTED[:2])
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")

    def run():
        ingest.append_parquet(ingest.file_stream(spark, landing), out, marks).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 2
    assert run() == 2
    drop("in", "b.jsonl", COLLECTED[2:])
    assert run() == 7


def test_ingestion_keeps_good_bad_and_metrics(spark, drop, tmp_path):
    landing, paths = drop("in", "a.jsonl", COLLECTED), ingest.Paths(str(tmp_path / "data"))
    for attempt in range(2):
        # A new checkpoint runs batch 0 again; its folders are replaced.
        stream = ingest.file_stream(spark, landing)
        ingest.for_each_batch(stream, ingest.ingest_batch(paths), str(tmp_path / f"marks{attempt}")).awaitTermination()
    assert spark.read.parquet(paths.valid).count() == 5
    reasons = {r.event_id: r.reject_reason for r in spark.read.parquet(paths.rejected).collect()}
    assert reasons == {"": "event_id is required", "evt_007": "user_id is required; event_ts is invalid"}
    row = spark.read.parquet(paths.metrics).first()
    assert ingest.log_line(row.batch_id, row.input_rows, row.valid, row.rejected) == (
        "ingest.batch batch_id=0 input_rows=7 valid=5 rejected=2"
    )


def test_batches_one_by_one(spark, drop, tmp_path):
    root = None
    for number in (1, 2, 3):
        root = drop(f"incoming/batch_{number:03d}", "p1.jsonl", [event(f"e{number}1", "page_view", "u", T(1))]).rsplit("/", 1)[0]
        drop(f"incoming/batch_{number:03d}", "p2.jsonl", [event(f"e{number}2", "purchase", "u", T(2))])
    drop("incoming/notes", "x.jsonl", [{}])
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    assert batches.processed_batches(spark, ledger).count() == 0
    done = []
    while (name := batches.run_next_batch(spark, root, out, ledger)) is not None:
        done.append(name)
    assert done == ["batch_001", "batch_002", "batch_003"]
    rows = spark.read.csv(f"{out}/batch_002", header=True).collect()
    assert {(r.event_type, r.source, r.event_count) for r in rows} == {("page_view", "web", "1"), ("purchase", "web", "1")}
    batches.mark_processed(spark, ledger, "batch_002")
    assert sorted(r.batch for r in batches.processed_batches(spark, ledger).collect()) == done
    drop("incoming/batch_004", "p.jsonl", [event("e4", "purchase", "u", T(3))])
    assert batches.run_next_batch(spark, root, out, ledger) == "batch_004"
    with pytest.raises(ValueError, match="nothing to summarise"):
        batches.summarize_folder(spark, str(tmp_path / "absent"))


def test_failed_batch_is_repeated(spark, drop, tmp_path, monkeypatch):
    root = drop("incoming/batch_001", "p.jsonl", [event("e", "purchase", "u", T(1))]).rsplit("/", 1)[0]
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    with monkeypatch.context() as patch:
        patch.setattr(batches, "mark_processed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            batches.run_next_batch(spark, root, out, ledger)
    assert batches.run_next_batch(spark, root, out, ledger) == "batch_001"
    assert spark.read.csv(f"{out}/batch_001", header=True).count() == 1


def test_repeats_are_dropped_across_restarts(spark, drop, tmp_path):
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    rows = [{"event_id": f"e{i}", "ts": f"2026-06-30T14:0{i}:00Z"} for i in range(3)]
    landing = drop("in", "a.jsonl", rows + rows[:1])

    def run():
        stream = spark.readStream.schema("event_id string, ts timestamp").json(landing)
        ingest.append_parquet(ingest.drop_repeats(stream, "event_id", "ts", "1 hour"), out, marks).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    assert run() == ["e0", "e1", "e2"]
    drop("in", "b.jsonl", rows[1:] + [{"event_id": "e9", "ts": "2026-06-30T14:09:00Z"}])
    assert run() == ["e0", "e1", "e2", "e9"]


def test_windowed_stream_emits_closed_windows(spark, drop, tmp_path):
    landing = drop("in", "a.jsonl", [{"kind": "a", "ts": f"2026-06-30T1{h}:30:00Z"} for h in (0, 0, 1, 4)])
    stream = spark.readStream.schema("kind string, ts timestamp").json(landing)
    counts = ingest.windowed_counts(stream, "ts", "1 hour", ["kind"], delay="30 minutes").drop("window_end")
    out = str(tmp_path / "out")
    ingest.append_parquet(counts, out, str(tmp_path / "marks")).awaitTermination()
    assert sorted((r.window_start.hour, r.event_count) for r in spark.read.parquet(out).collect()) == [(10, 2), (11, 1)]


def test_upserts_survive_replay(spark, drop, tmp_path):
    log = str(tmp_path / "log")
    shape = "k string, v int, at int"
    landing = drop("in", "a.jsonl", [{"k": "x", "v": 1, "at": 1}, {"k": "x", "v": 2, "at": 2}, {"k": "y", "v": 1, "at": 1}])
    for attempt in range(2):
        stream = spark.readStream.schema(shape).json(landing)
        ingest.for_each_batch(stream, keyed.upsert_log(log, "k", ["at"]), str(tmp_path / f"m{attempt}")).awaitTermination()
        assert {(r.k, r.v) for r in keyed.current_rows(spark, log, "k", ["at"]).collect()} == {("x", 2), ("y", 1)}


def test_observed_counts(spark, drop, tmp_path):
    landing = drop("in", "a.jsonl", COLLECTED)
    checked = collect_errors(ingest.file_stream(spark, landing))
    stream = ingest.observed(checked, "quality", F.size("validation_errors") > 0).select("event_id")
    query = ingest.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "marks"))
    query.awaitTermination()
    seen = [p.observedMetrics["quality"] for p in query.recentProgress if "quality" in p.observedMetrics]
    assert (sum(m.input_rows for m in seen), sum(m.bad_rows for m in seen)) == (7, 2)


def test_merge_task_runs_only_with_data(spark):
    spark.createDataFrame([(1, "a")], "id int, v string").createOrReplaceTempView("merge_target")
    published = []
    empty = spark.createDataFrame([], "id int, v string")
    assert not keyed.merge_task(spark, "merge_target", empty, "id", published.append)
    delta = spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string")
    assert keyed.merge_task(spark, "merge_target", delta, "id", published.append)
    assert {tuple(r) for r in published[0].collect()} == {(1, "b"), (2, "c")}


def test_topic_records(spark, drop, tmp_path):
    records = [
        {"key": "u1", "value": json.dumps({"n": i}), "topic": "t", "partition": 0, "offset": i, "timestamp": "2026-06-30T14:00:00Z"}
        for i in range(4)
    ]
    landing, out = drop("in", "a.jsonl", records), str(tmp_path / "out")
    ingest.append_parquet(read_topic_files(spark, landing), out, str(tmp_path / "m")).awaitTermination()
    rows = spark.read.parquet(out)
    assert [r.offset for r in keyed.per_key_order(rows).collect()] == [0, 1, 2, 3]
    assert keyed.key_partitions(rows).first().n_partitions == 1
    same = spark.range(3).select(partition_of(F.lit("u1"), 6).alias("p")).distinct().collect()
    assert len(same) == 1 and 0 <= same[0].p < 6


def test_versions(spark):
    bodies = ['{"k":1}', '{"k":2,"version":1}', '{"data":{"k":3},"version":2}', '{"version":9}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, b string").selectExpr("i", "parse_json(b) AS payload")
    readers = {1: lambda p: F.try_variant_get(p, "$.k", "int"), 2: lambda p: F.try_variant_get(p, "$.data.k", "int")}
    assert [(r.version, r.fields) for r in ingest.by_version(rows, readers).orderBy("i").collect()] == [(1, 1), (1, 2), (2, 3), (9, None)]


H = "2026-06-30T{:02d}:30:00Z".format


def test_every_row_is_in_a_window_or_kept_as_late(spark, drop, tmp_path):
    paths = windows.Paths(str(tmp_path / "w"))
    read = lambda: spark.readStream.schema("kind string, ts timestamp").json(str(tmp_path / "in"))
    run = lambda: windows.run_windows(read, paths, "ts", "1 hour", ["kind"], "30 minutes")
    drop("in", "a.jsonl", [{"kind": "a", "ts": H(h)} for h in (0, 0, 1, 4)] + [{"kind": "a"}])
    run()
    closed = lambda: sorted((r.window_start.hour, r.event_count) for r in spark.read.parquet(paths.closed).collect())
    late = lambda: sorted((r.ts.hour if r.ts else -1, r.reason) for r in spark.read.parquet(paths.late).collect())
    assert closed() == [(0, 2), (1, 1)] and late() == [(-1, "no event time")]
    drop("in", "b.jsonl", [{"kind": "a", "ts": H(h)} for h in (1, 3, 4, 9)])
    closing, _ = run()
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in closing.recentProgress if p.stateOperators) == 2
    # The mark stood at 04:00, so the windows of 01 and 03 had closed; 04 was open.
    expected = [(0, 2), (1, 1), (4, 2)], [(-1, "no event time"), (1, "window closed"), (3, "window closed")]
    assert (closed(), late()) == expected
    run()
    assert (closed(), late()) == expected


def test_late_rows_survive_a_replay(spark, drop, tmp_path):
    paths = windows.Paths(str(tmp_path / "w"))
    for attempt in range(2):
        for number, hours in enumerate(((5,), (1, 6), (2,))):
            drop(f"in{attempt}", f"{number}.jsonl", [{"ts": H(h)} for h in hours])
            stream = spark.readStream.schema("ts timestamp").json(str(tmp_path / f"in{attempt}"))
            handle = windows.keep_late(paths, "ts", "1 hour", "1 hour")
            ingest.for_each_batch(stream, handle, str(tmp_path / f"m{attempt}"), skip_empty=False).awaitTermination()
        assert sorted(r.ts.hour for r in spark.read.parquet(paths.late).collect()) == [1, 2]


def test_messages_are_put_in_order(spark, drop, tmp_path):
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")

    def run(name, messages):
        landing = drop("in", name, [{"k": k, "n": n, "ts": f"2026-06-30T14:{m:02d}:00Z"} for k, n, m in messages])
        stream = spark.readStream.schema("k string, n bigint, ts timestamp").json(landing)
        ingest.append_parquet(ordering.in_key_order(stream, "k", "n", "ts", "10 minutes", "n"), out, marks).awaitTermination()
        rows = spark.read.parquet(out).orderBy("key", "place").collect()
        return [(r.key, r.place, r.number, r.missing, r.body) for r in rows]

    first = run("a", [("x", 3, 7), ("x", 1, 1), ("y", 2, 2), ("x", 3, 7), (None, 9, 1), ("x", 6, 20)])
    assert first == [("x", 1, 1, 0, "1"), ("x", 2, 3, 1, "3"), ("y", 1, 2, 1, "2")]
    # Number 2 comes too late; 5 and 4 come out of order within the delay; 6 waits until the mark passes it.
    second = run("b", [("x", 2, 6), ("x", 5, 15), ("x", 4, 12), ("y", 3, 40)])
    assert second == [*first[:2], ("x", 3, 4, 0, "4"), ("x", 4, 5, 0, "5"), ("x", 5, 6, 0, "6"), first[2]]
    assert run("c", [("y", 4, 55), ("x", 6, 20)]) == [*second, ("y", 2, 3, 0, "3")]


def test_keys_in_order_share_the_state_of_a_group(spark, drop, tmp_path):
    out, marks, states = str(tmp_path / "out"), str(tmp_path / "marks"), []
    # 20 keys; of each, number 3 is lost, 1 and 2 come in turn, 2 comes twice, 5 comes before 4; 6 is still held.
    first = [(k, n, m) for n, m in ((2, 3), (1, 1), (2, 3)) for k in range(20)]
    second = [(k, n, m) for n, m in ((5, 9), (4, 7), (6, 40)) for k in range(20)]
    for name, messages in (("a", first), ("b", second)):
        landing = drop("in", name, [{"k": f"k{k}", "n": n, "ts": f"2026-06-30T14:{m:02d}:00Z"} for k, n, m in messages])
        stream = spark.readStream.schema("k string, n bigint, ts timestamp").json(landing)
        handle = ingest.append_parquet(ordering.in_key_order(stream, "k", "n", "ts", "10 minutes", "n", groups=3), out, marks)
        handle.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in handle.recentProgress if p["stateOperators"]]
    got = sorted((r.key, r.place, r.number, r.missing, r.body) for r in spark.read.parquet(out).collect())
    assert got == sorted((f"k{k}", p, n, gap, str(n)) for k in range(20) for p, n, gap in ((1, 1, 0), (2, 2, 0), (3, 4, 1), (4, 5, 0)))
    assert max(states) == 3


def test_log_is_compacted_and_a_crash_leaves_it_whole(spark, tmp_path, monkeypatch):
    log, order = str(tmp_path / "log"), ["at"]
    rows = lambda *values: spark.createDataFrame(list(values), "k string, v int, at int")
    state = lambda: {(r.k, r.v) for r in keyed.current_rows(spark, log, "k", order).collect()}
    handle = keyed.upsert_log(log, "k", order, compact_every=2)
    handle(rows(("x", 1, 1), ("y", 1, 1)), 0)
    with monkeypatch.context() as patch:
        patch.setattr(keyed, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            handle(rows(("x", 2, 2)), 1)
    assert keyed.published_snapshot(spark, log) is None and state() == {("x", 2), ("y", 1)}
    handle(rows(("x", 2, 2)), 1)  # the batch is run again
    assert keyed.published_snapshot(spark, log) == 1 and state() == {("x", 2), ("y", 1)}
    handle(rows(("x", 3, 2), ("z", 1, 1), ("y", 0, 0)), 2)
    assert state() == {("x", 3), ("y", 1), ("z", 1)}  # a later batch wins a tie
    plan = keyed.current_rows(spark, log, "k", order)
    scans = plan._jdf.queryExecution().executedPlan().toString()
    assert any("_snapshots/upto=1/" in f for f in plan.inputFiles()) and re.search(r"PartitionFilters: \[[^\]]*batch_id[^\]]* > 1", scans)
    handle(rows(("w", 1, 1)), 3)
    assert keyed.published_snapshot(spark, log) == 3 and state() == {("x", 3), ("y", 1), ("z", 1), ("w", 1)}
    keyed.compact_log(spark, log, "k", order, 1)
    assert keyed.published_snapshot(spark, log) == 3


def test_bronze_takes_each_file_once(spark, tmp_path, monkeypatch):
    landing, paths = tmp_path / "in", ingest.Paths(str(tmp_path / "bronze"))
    landing.mkdir()
    (landing / "a.jsonl").write_text('{"id": 1}\n{broken\n\n')
    load = lambda run: bronze.append_bronze(spark, str(landing), paths, "events", run)
    loaded = lambda: sorted((r.raw_text, r.raw_payload is None, r.ingest_run_id) for r in spark.read.parquet(paths.rows).collect())
    load("r1")
    first = [("", True, "r1"), ('{"id": 1}', False, "r1"), ("{broken", True, "r1")]
    assert loaded() == first
    load("r2")
    assert loaded() == first
    (landing / "b.jsonl").write_text('{"id": 2}\n')
    with monkeypatch.context() as patch:
        # The run stops after the rows and before the manifest; the next one does the batch again.
        patch.setattr(bronze.F, "count_if", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            load("r3")
    load("r4")
    assert loaded() == sorted([*first, ('{"id": 2}', False, "r4")])
    manifest = {(r.source_file.rsplit("/", 1)[1], r.lines, r.malformed, r.ingest_run_id) for r in spark.read.parquet(paths.manifest).collect()}
    assert manifest == {("a.jsonl", 3, 2, "r1"), ("b.jsonl", 1, 0, "r4")}


def test_a_hot_key_reaches_the_state_once_a_task(spark, drop, tmp_path):
    landing = drop("in", "a.jsonl", [{"event_id": "hot" if i % 3 else f"e{i}", "ts": T(1)} for i in range(600)])
    stream = spark.readStream.schema("event_id string, ts timestamp").json(landing)
    query = ingest.append_parquet(ingest.drop_repeats(stream, "event_id", "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "m"))
    query.awaitTermination()
    state = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert state[0].numRowsUpdated == 201 and state[0].customMetrics["numDroppedDuplicateRows"] == 0
    twice = spark.createDataFrame([(i % 5,) for i in range(40)], "k int").coalesce(1)
    assert ingest.first_in_task(twice, "k").count() == 5 and ingest.first_in_task(twice, "k", most_keys=2).count() <= 40
