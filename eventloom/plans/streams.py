"""Streaming: each query writes the tables as arriving files, runs the stream to its end, and reads the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import variants
from eventloom.operators.quality import collect_errors
from eventloom.plans.adapters import payload_events, with_feed
from eventloom.plans.aggregates import VALID_SQL
from eventloom.plans.registry import Tables, query
from eventloom.plans.scalars import _ERRORS_SQL
from eventloom.session import cut_lineage
from eventloom.sources import topics
from eventloom.streaming import batches, ingest, keyed, ordering, windows

_PARTITIONS = 8


def _topic_rows(t: Tables) -> DataFrame:
    """Events as records of a topic whose partition follows from the user and whose offset is the event id."""
    body = F.to_json(F.struct("event_id", "event_type", "user_id", F.col("value").alias("amount"))).alias("value")
    return t.events.select(
        F.col("user_id").cast("string").alias("key"), body, F.lit("app.events").alias("topic"),
        F.pmod("user_id", F.lit(_PARTITIONS)).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _topic(t: Tables, name: str) -> str:
    path = t.scratch(name)
    _topic_rows(t).write.json(path)
    return path


def _landing(t: Tables) -> str:
    path = t.scratch("landing")
    payload_events(t).drop("line_no").write.json(path)
    return path


#: Files a micro-batch takes at most, so that batches and not only their number grow with the feed.
_FILES_A_BATCH = 1000


@query("SELECT event_id, event_type, user_id, CAST(user_id % 8 AS INT) AS partition, event_id AS \"offset\" FROM events")
def st_kafka_source(t: Tables) -> DataFrame:
    # The connector is not on the class path here; the same plan runs on files of topic records.
    from pyspark.sql import types as T

    shape = T.StructType.fromDDL("event_id bigint, event_type string, user_id bigint")
    stream = topics.decode_events(topics.read_topic_files(t.spark, _topic(t, "topic")), shape)
    out = t.scratch("decoded")
    ingest.append_parquet(stream, out, t.scratch("marks")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "event_type", "user_id", "partition", "offset")


@query(with_feed("SELECT source, count(*) AS n FROM feed GROUP BY 1"))
def st_file_source(t: Tables) -> DataFrame:
    out, stream = t.scratch("taken"), ingest.file_stream(t.spark, _landing(t), max_files=_FILES_A_BATCH)
    ingest.append_parquet(stream, out, t.scratch("marks")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("source").agg(F.count("*").alias("n"))


@query(with_feed(f"SELECT event_id, array_to_string({_ERRORS_SQL}, '; ') AS errors FROM feed"))
def st_parse_validate(t: Tables) -> DataFrame:
    checked = collect_errors(ingest.file_stream(t.spark, _landing(t)))
    out = t.scratch("checked")
    stream = checked.select("event_id", F.array_join("validation_errors", "; ").alias("errors"))
    ingest.append_parquet(stream, out, t.scratch("marks")).awaitTermination()
    return t.spark.read.parquet(out)


@query(with_feed("SELECT event_type, count(*) AS n FROM feed GROUP BY 1"))
def st_raw_parquet(t: Tables) -> DataFrame:
    # Two runs over the same checkpoint: the second finds nothing new and adds nothing.
    landing, out, marks = _landing(t), t.scratch("raw"), t.scratch("marks")
    for _ in range(2):
        ingest.append_parquet(ingest.file_stream(t.spark, landing), out, marks).awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


def _ingested(t: Tables) -> ingest.Paths:
    paths = ingest.Paths(t.scratch("ingest"))
    stream = ingest.file_stream(t.spark, _landing(t), max_files=_FILES_A_BATCH)
    ingest.for_each_batch(stream, ingest.ingest_batch(paths), t.scratch("marks")).awaitTermination()
    return paths


@query(with_feed(f"SELECT event_id, array_to_string({_ERRORS_SQL}, '; ') AS reject_reason FROM feed WHERE NOT ({VALID_SQL})"))
def st_rejects_sink(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_ingested(t).rejected).select("event_id", "reject_reason")


@query(with_feed(f"SELECT count(*) AS input_rows, count(*) FILTER ({VALID_SQL}) AS valid, count(*) FILTER (NOT ({VALID_SQL})) AS rejected FROM feed"))
def st_batch_metrics(t: Tables) -> DataFrame:
    metrics = t.spark.read.parquet(_ingested(t).metrics)
    return metrics.agg(*[F.sum(c).alias(c) for c in ("input_rows", "valid", "rejected")])


@query(with_feed("SELECT event_type, source, count(*) AS event_count FROM feed GROUP BY 1, 2"))
def st_batch_summary(t: Tables) -> DataFrame:
    out = t.scratch("per-batch")
    stream = ingest.file_stream(t.spark, _landing(t), max_files=_FILES_A_BATCH)
    ingest.for_each_batch(stream, ingest.batch_counts(out, ["event_type", "source"]), t.scratch("marks")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type", "source").agg(F.sum("event_count").alias("event_count"))


@query(with_feed("SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids FROM feed"))
def st_available_now(t: Tables) -> DataFrame:
    landing, out, marks = _landing(t), t.scratch("finite"), t.scratch("marks")
    query_ = ingest.append_parquet(ingest.file_stream(t.spark, landing), out, marks, available_now=True)
    query_.awaitTermination()
    return t.spark.read.parquet(out).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def _batch_folders(t: Tables) -> str:
    """The feed as three batch folders, by a third of the event ids each, written in one go."""
    root = t.scratch("incoming")
    numbered = payload_events(t).withColumn("batch_", F.lpad((F.pmod("line_no", F.lit(3)) + 1).cast("string"), 3, "0"))
    numbered.drop("line_no").write.partitionBy("batch_").json(root)
    return root


def _batch_name() -> Column:
    return F.concat(F.lit("batch_"), F.regexp_extract("_metadata.file_path", r"/batch_=(\d+)/", 1))


@query(with_feed("SELECT 'batch_00' || (line_no % 3 + 1) AS batch, event_type, source, count(*) AS event_count FROM feed GROUP BY 1, 2, 3"))
def st_next_batch(t: Tables) -> DataFrame:
    root, out, ledger = _batch_folders(t), t.scratch("summaries"), t.scratch("ledger")
    while batches.run_next_batch(t.spark, root, out, ledger, files="part-*"):
        pass
    rows = t.spark.read.option("recursiveFileLookup", True).schema("event_type string, source string, event_count bigint").csv(out, header=True)
    return rows.select(_batch_name().alias("batch"), "event_type", "source", "event_count")


@query("SELECT 'batch_' || isodow(ts) AS batch, count(*) AS n_events, isodow(ts) <= 5 AS processed FROM events GROUP BY 1, 3")
def st_state_file(t: Tables) -> DataFrame:
    # A batch per weekday; Monday to Friday are marked, one of them twice.
    ledger = t.scratch("ledger")
    for day in (2, 1, 3, 4, 5, 2):
        batches.mark_processed(t.spark, ledger, f"batch_{day}")
    done = batches.processed_batches(t.spark, ledger).select("batch", F.lit(True).alias("marked"))
    per_day = t.events.groupBy(F.concat(F.lit("batch_"), F.weekday("ts") + 1).alias("batch")).agg(F.count("*").alias("n_events"))
    return per_day.join(done, "batch", "left").select("batch", "n_events", F.coalesce("marked", F.lit(False)).alias("processed"))


@query(with_feed("SELECT 'batch_00' || (line_no % 3 + 1) AS batch, event_type, source, count(*) AS event_count FROM feed GROUP BY 1, 2, 3"))
def st_commit_after_write(t: Tables) -> DataFrame:
    # A first run that wrote its output but stopped before the ledger moved is repeated and overwrites it.
    root, out, ledger = _batch_folders(t), t.scratch("summaries"), t.scratch("ledger")
    batches.summarize_folder(t.spark, f"{root}/batch_=001", "part-*").write.option("header", True).csv(f"{out}/batch_=001")
    while batches.run_next_batch(t.spark, root, out, ledger, files="part-*"):
        pass
    rows = t.spark.read.option("recursiveFileLookup", True).schema("event_type string, source string, event_count bigint").csv(out, header=True)
    return rows.select(_batch_name().alias("batch"), "event_type", "source", "event_count")


@query("SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS event_count FROM events GROUP BY 1, 2, 3")
def st_windowed_batch(t: Tables) -> DataFrame:
    return ingest.windowed_counts(t.events, "ts", "1 hour", ["event_type"])


@query("""WITH arrived AS (SELECT event_type, ts, (day(ts) - 1) // 10 + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS arrival,
  date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM events),
marks AS (SELECT arrival, lag(seen) OVER (ORDER BY arrival) - INTERVAL 1 DAY AS mark, max(seen) OVER () - INTERVAL 1 DAY AS final
 FROM (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival) AS seen FROM arrived GROUP BY arrival)),
judged AS (SELECT a.*, coalesce(window_end <= mark, FALSE) AS late, final FROM arrived a JOIN marks m ON a.arrival = m.arrival)
SELECT window_start, window_end, event_type, CASE WHEN any_value(window_end <= final) AND count(*) FILTER (NOT late) > 0 THEN count(*) FILTER (NOT late) END AS event_count,
 count(*) FILTER (late) AS late_rows FROM judged GROUP BY 1, 2, 3
HAVING count(*) FILTER (late) > 0 OR any_value(window_end <= final)""")
def st_windowed_agg(t: Tables) -> DataFrame:
    # Arrivals of ten days each; every fiftieth event comes with the arrival after its own. The stream is started
    # anew for each arrival and goes on from its checkpoint.
    landing, paths = t.scratch("arrivals"), windows.Paths(t.scratch("windows"))
    late_by = F.when(F.pmod("event_id", F.lit(50)) == 0, 1).otherwise(0)
    arrival = F.expr("(day(ts) - 1) div 10") + late_by
    events = t.events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), arrival.alias("arrival"))
    shape = "event_id bigint, event_type string, ts timestamp"

    def read() -> DataFrame:
        return t.spark.readStream.schema(shape).option("recursiveFileLookup", True).parquet(landing)

    for number in range(5):
        events.where(F.col("arrival") == number).drop("arrival").write.parquet(f"{landing}/arrival-{number}")
        windows.run_windows(read, paths, "ts", "1 hour", ["event_type"], "1 day")
    late = t.spark.read.parquet(paths.late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("late_rows"))
    late = late.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "late_rows")
    both = t.spark.read.parquet(paths.closed).join(late, ["window_start", "window_end", "event_type"], "full")
    local = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return both.select(*local, "event_type", "event_count", F.coalesce("late_rows", F.lit(0)).alias("late_rows"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st_dedup(t: Tables) -> DataFrame:
    # Every event arrives twice; the repeats fall within the delay and are dropped.
    landing, out = t.scratch("twice"), t.scratch("once")
    once = t.events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    once.unionByName(once).write.parquet(landing)
    stream = t.spark.readStream.schema("event_id bigint, event_type string, ts timestamp").parquet(landing)
    kept = ingest.drop_repeats(stream, "event_id", "ts", "60 days")
    ingest.append_parquet(kept, out, t.scratch("marks")).awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def st_idempotent_sink(t: Tables) -> DataFrame:
    # Three arrivals, compacted after every second batch: the result is read from one snapshot and one batch after it.
    # Then a fresh checkpoint replays everything; what it stores again changes nothing.
    landing, log, order = t.scratch("updates"), t.scratch("log"), ["ts", "event_id"]
    updates = t.events.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    shape, marks = "user_id bigint, event_id bigint, event_type string, ts timestamp", t.scratch("marks")

    def run(checkpoint: str) -> None:
        stream = t.spark.readStream.schema(shape).option("recursiveFileLookup", True).parquet(landing)
        handle = keyed.upsert_log(log, "user_id", order, compact_every=2)
        ingest.for_each_batch(stream, handle, checkpoint).awaitTermination()

    for number in range(3):
        updates.where(F.pmod("event_id", F.lit(3)) == number).write.parquet(f"{landing}/part-{number}")
        run(marks)
    run(t.scratch("marks"))
    return keyed.current_rows(t.spark, log, "user_id", order).select("user_id", "event_id", "event_type")


@query("SELECT CAST(user_id AS VARCHAR) AS key, count(DISTINCT user_id % 8) AS n_partitions, CAST(min(user_id % 8) AS INT) AS partition, count(*) AS n_messages FROM events GROUP BY 1")
def st_key_partitions(t: Tables) -> DataFrame:
    return keyed.key_partitions(_topic_rows(t))


@query("""WITH numbered AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM events),
kept AS (SELECT * FROM numbered WHERE number % 17 <> 0)
SELECT key, row_number() OVER (PARTITION BY key ORDER BY number) AS place, number, number - lag(number, 1, 0) OVER (PARTITION BY key ORDER BY number) - 1 AS missing,
 CAST(event_id AS VARCHAR) AS body FROM kept WHERE ts <= (SELECT max(ts) - INTERVAL 12 HOUR FROM kept)""")
def st_keyed_order(t: Tables) -> DataFrame:
    # Messages carry a number in their key; every seventeenth is lost, some come up to six hours late, some twice.
    landing, out, marks = t.scratch("messages"), t.scratch("ordered"), t.scratch("marks")
    in_key = Window.partitionBy("user_id").orderBy("ts", "event_id")
    numbered = t.events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.row_number().over(in_key).cast("long").alias("number"))
    sent = cut_lineage(numbered.where("number % 17 <> 0"))
    sent = sent.unionByName(sent.where("event_id % 29 = 0"))
    arrival = F.expr("cast((unix_seconds(ts) - unix_seconds(timestamp'2024-01-01') + (event_id % 7) * 3600) div (10 * 86400) as int)")
    for number in range(4):
        sent.where(arrival == number).write.parquet(f"{landing}/part-{number}")
        stream = t.spark.readStream.schema(sent.schema).option("recursiveFileLookup", True).parquet(landing)
        ordered = ordering.in_key_order(stream, "user_id", "number", "ts", "12 hours", "event_id")
        ingest.append_parquet(ordered, out, marks).awaitTermination()
    return t.spark.read.parquet(out).select("key", "place", "number", "missing", "body")


@query("""SELECT event_type, user_id AS hot_key, n AS key_rows, CAST(total AS BIGINT) AS group_rows, round(n / CAST(total AS DOUBLE), 6) AS share FROM (
 SELECT event_type, user_id, count(*) AS n, sum(count(*)) OVER (PARTITION BY event_type) AS total,
  row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id DESC) AS r FROM events GROUP BY 1, 2) WHERE r = 1""")
def st_hot_key(t: Tables) -> DataFrame:
    return keyed.key_load(t.events, "event_type", "user_id")


@query("""SELECT 'analytics' AS "group", 'app.events' AS topic, CAST(p AS INT) AS partition, CASE WHEN p = 7 THEN 0 ELSE c END AS current_offset, e AS log_end_offset,
 e - CASE WHEN p = 7 THEN 0 ELSE c END AS lag
FROM (SELECT user_id % 8 AS p, count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS c, count(*) AS e FROM events GROUP BY 1)""")
def st_lag_report(t: Tables) -> DataFrame:
    # Two groups; partition 7 was never read by the one reported on.
    rows = _topic_rows(t)
    where = ["topic", "partition"]
    ends = rows.groupBy(*where).agg(F.count("*").alias("log_end_offset"))
    read = rows.where("timestamp < TIMESTAMP '2024-01-20' AND partition <> 7").groupBy(*where).agg(F.count("*").alias("current_offset"))
    all_read = ends.withColumnRenamed("log_end_offset", "current_offset").withColumn("group", F.lit("archive"))
    committed = read.withColumn("group", F.lit("analytics")).unionByName(all_read)
    return keyed.lag_report(committed, ends, "analytics")


@query("SELECT g.name AS \"group\", count(*) AS n FROM events, (VALUES ('analytics'), ('archive')) g(name) GROUP BY 1")
def st_group_fanout(t: Tables) -> DataFrame:
    # Each group has a checkpoint of its own, so each reads everything.
    source, counted = _topic(t, "fanout"), []
    for group in ("analytics", "archive"):
        out = t.scratch(group)
        ingest.append_parquet(topics.read_topic_files(t.spark, source), out, t.scratch("marks")).awaitTermination()
        counted.append(t.spark.read.parquet(out).agg(F.count("*").alias("n")).withColumn("group", F.lit(group)))
    return counted[0].unionByName(counted[1])


@query("SELECT 'app.' || event_type AS topic, count(*) AS n FROM events GROUP BY 1")
def st_multi_topic(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type", "user_id")
    messages = topics.encode_events(events, "user_id", topics.topic_for_type(F.col("event_type"), "app"))
    return messages.groupBy("topic").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 3 END AS version, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def st_schema_version(t: Tables) -> DataFrame:
    # Version 1 keeps k at the top and may leave the version out; version 2 keeps it inside "data".
    k, version = F.get_json_object("props", "$.k").cast("int"), F.col("event_id") % 3
    body = F.when(version == 0, F.to_json(F.struct(k.alias("k")))).when(
        version == 1, F.to_json(F.struct(k.alias("k"), F.lit(1).alias("version")))
    ).otherwise(F.to_json(F.struct(F.struct(k.alias("k")).alias("data"), F.lit(2).alias("version"))))
    events = t.events.select("event_id", variants.parse_json(body, strict=True).alias("payload"))
    readers = {1: lambda p: variants.path(p, "$.k", "int"), 2: lambda p: variants.path(p, "$.data.k", "int")}
    return ingest.by_version(events, readers).select("event_id", F.col("version").cast("bigint").alias("version"), F.col("fields").alias("k"))
