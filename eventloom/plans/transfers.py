"""Sources and sinks: each query writes whole tables with a sink, reads them back with a source, and returns the rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.contract import EVENT_SCHEMA
from eventloom.operators.measures import count_by
from eventloom.operators.quality import first_reason, split_reason
from eventloom.operators.skew import broadcast_if_small
from eventloom.plans.adapters import flat, payload_events, with_feed, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.sinks import files as sinks
from eventloom.sinks.tables import TableScope
from eventloom.sources import files as sources
from eventloom.sources.topics import encode_events
from eventloom.streaming.batches import summarize_folder
from eventloom.streaming.ingest import append_parquet, file_stream
from eventloom.warehouse.gold import event_categories


def _feed_lines(t: Tables) -> DataFrame:
    """The feed as JSON lines; some lines are cut off."""
    line = F.to_json(F.struct(*[F.col(f.name) for f in EVENT_SCHEMA]))
    broken = F.col("line_no") % 131 == 0
    return payload_events(t).select("line_no", F.when(broken, F.left(line, F.lit(9))).otherwise(line).alias("value"))


_WHOLE = "line_no % 131 <> 0"


@query(with_feed(f"""SELECT {", ".join(f"CASE WHEN {_WHOLE} THEN {c} END AS {c}" for c in ("event_id", "event_type", "user_id", "event_ts", "source", "amount"))},
 NOT ({_WHOLE}) AS malformed FROM feed"""))
def scan_jsonl_schema(t: Tables) -> DataFrame:
    path = t.scratch("lines")
    _feed_lines(t).select("value").write.text(path)
    rows = sources.read_json_lines(t.spark, path, keep_corrupt=True)
    names = [f.name for f in EVENT_SCHEMA if f.name != "payload"]
    amount = F.col("payload").getItem("amount").alias("amount")
    return rows.select(*names, amount, F.col(sources.CORRUPT).isNotNull().alias("malformed"))


@query(with_feed("SELECT event_type, source, COUNT(*) AS event_count FROM feed GROUP BY 1, 2"))
def scan_jsonl_multi(t: Tables) -> DataFrame:
    path = t.scratch("batch")
    line = F.to_json(F.struct(*[F.col(f.name) for f in EVENT_SCHEMA]))
    # Two part files at least, and as many more as the feed has tasks.
    for part in (0, 1):
        payload_events(t).where(F.pmod("line_no", F.lit(2)) == part).select(line.alias("value")).write.mode("append").text(path)
    return summarize_folder(t.spark, path, files="part-*")


@query("SELECT event_id, user_id, event_type FROM events")
def scan_json_infer(t: Tables) -> DataFrame:
    path = t.scratch("inferred")
    t.events.select("event_id", "user_id", "event_type").write.json(path)
    return t.spark.read.json(path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(t: Tables) -> DataFrame:
    path = t.scratch("customers")
    sinks.write_csv(t.customer, path)
    return t.spark.read.csv(path, header=True, inferSchema=True)


@query("""SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment || '|x' END AS segment,
 CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer""")
def scan_csv_options(t: Tables) -> DataFrame:
    path = t.scratch("options")
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "NULL").otherwise(F.concat("c_mktsegment", F.lit("|x")))
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("")
    rows = t.customer.select("c_custkey", segment.alias("segment"), balance.alias("balance"))
    rows.write.option("header", True).option("sep", "|").option("quote", '"').option("emptyValue", "").csv(path)
    return sources.read_csv(t.spark, path, "c_custkey bigint, segment string, balance double", sep="|", null_if=("NULL",))


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'R'")
def scan_parquet(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity < 10 AND l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""SELECT count(*) AS n_lines, sum(length(line)) AS n_chars
FROM (SELECT unnest(string_split(regexp_replace(text, '[\\r\\n]', '/', 'g') || chr(10) || source, chr(10))) AS line FROM documents)""")
def scan_text(t: Tables) -> DataFrame:
    path = t.scratch("text")
    body = F.concat_ws("\n", F.regexp_replace("text", r"[\r\n]", "/"), "source")
    t.documents.select(body.alias("value")).write.text(path)
    lines = t.spark.read.text(path)
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query("SELECT round(avg(CAST(value AS DECIMAL(18,2))), 6) AS average FROM events WHERE event_id % 10 <> 0")
def scan_scores_avg(t: Tables) -> DataFrame:
    # One score per line; every tenth line is blank.
    path = t.scratch("scores")
    score = F.format_string("%.2f", "value")
    t.events.select(F.when(F.col("event_id") % 10 == 0, " ").otherwise(score).alias("value")).write.text(path)
    return sources.average_score(t.spark, path).select(F.round("average", 6).alias("average"))


_CATEGORIES = "(VALUES ('page_view', 'engagement'), ('video_play', 'engagement'), ('add_to_cart', 'commerce'), ('purchase', 'commerce')) m(event_type, event_category)"


@query(with_flat(f"SELECT event_category, count(*) AS n FROM flat LEFT JOIN {_CATEGORIES} USING (event_type) GROUP BY 1"))
def scan_memory(t: Tables) -> DataFrame:
    counts = flat(t).groupBy("event_type").agg(F.count("*").alias("n"))
    mapped = counts.join(event_categories(t.spark), "event_type", "left")
    return mapped.groupBy("event_category").agg(F.sum("n").alias("n"))


@query(with_flat("SELECT event_category, source, count(*) AS n FROM flat LEFT JOIN (SELECT event_type, event_category FROM "
                 f"{_CATEGORIES}) USING (event_type) GROUP BY 1, 2"))
def seed_csv(t: Tables) -> DataFrame:
    path = t.scratch("seed")
    sinks.write_csv(event_categories(t.spark), path, single_file=True)
    seed = sources.read_csv(t.spark, path, "event_type string, event_category string")
    joined = flat(t).join(broadcast_if_small(seed), "event_type", "left")
    return joined.groupBy("event_category", "source").agg(F.count("*").alias("n"))


@query(with_flat("SELECT source, count(*) AS n FROM flat WHERE event_type = 'purchase' GROUP BY 1"))
def scan_view(t: Tables) -> DataFrame:
    flat(t).createOrReplaceTempView("loom_events")
    return t.spark.sql("SELECT source, count(*) AS n FROM loom_events WHERE event_type = 'purchase' GROUP BY source")


@query(with_flat("SELECT event_type, count(*) AS n FROM flat GROUP BY 1"))
def scan_global_view(t: Tables) -> DataFrame:
    flat(t).createOrReplaceGlobalTempView("loom_events_everywhere")
    other = t.spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return other.sql("SELECT event_type, count(*) AS n FROM global_temp.loom_events_everywhere GROUP BY event_type")


@query("""SELECT 'orc' AS format, o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'xml', c_mktsegment, count(*) FROM customer GROUP BY ALL""")
def scan_other_formats(t: Tables) -> DataFrame:
    orc, xml = t.scratch("orc"), t.scratch("xml")
    t.orders.write.orc(orc)
    t.customer.select("c_custkey", "c_mktsegment").write.option("rowTag", "customer").xml(xml)
    orders = t.spark.read.orc(orc).groupBy(F.col("o_orderstatus").alias("kind")).agg(F.count("*").alias("n"))
    people = t.spark.read.schema("c_custkey bigint, c_mktsegment string").option("rowTag", "customer").xml(xml)
    segments = people.groupBy(F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("n"))
    return orders.withColumn("format", F.lit("orc")).unionByName(segments.withColumn("format", F.lit("xml")))


_LOAD = {
    "event_id": ("$.event_id", "bigint"), "event_type": ("$.event_type", "string"), "user_id": ("$.user_id", "bigint"),
    "event_ts": ("$.event_ts", "timestamp"), "k": ("$.payload.k", "int"),
}


def _stage(t: Tables, broken: Column | None = None) -> DataFrame:
    """Events as staged JSON lines, with the day they belong to."""
    payload = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")).alias("payload")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_ts")
    line = F.to_json(F.struct("event_id", "event_type", "user_id", stamp, payload))
    if broken is not None:
        line = F.when(broken, F.concat(F.lit("x"), line)).otherwise(line)
    return t.events.select(line.alias("value"), F.to_date("ts").alias("day"))


@query("""SELECT event_id, event_type, user_id, date_trunc('second', ts) AS event_ts, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def copy_into_json(t: Tables) -> DataFrame:
    path = t.scratch("stage")
    _stage(t).select("value").write.text(path)
    loaded = sources.copy_json(t.spark, path, _LOAD, on_error="abort")
    return loaded.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("""SELECT event_id, event_type, user_id, date_trunc('second', ts) AS event_ts, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_id % 1999 = 0)""")
def copy_on_error(t: Tables) -> DataFrame:
    # One file per day, as the rule that leaves out whole files needs; a day with a malformed line goes.
    path = t.scratch("stage-days")
    _stage(t, broken=F.col("event_id") % 1999 == 0).repartition("day").write.partitionBy("day").text(path)
    loaded = sources.copy_json(t.spark, path, _LOAD, on_error="skip_file")
    return loaded.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("""SELECT CASE WHEN event_id % 131 = 0 THEN 'invalid JSON' ELSE 'user_id is no bigint' END AS error, count(*) AS n
FROM events WHERE event_id % 131 = 0 OR event_id % 127 = 0 GROUP BY 1""")
def copy_validate_only(t: Tables) -> DataFrame:
    path = t.scratch("stage-check")
    number = F.col("event_id")
    user = F.when(number % 127 == 0, F.lit("nobody")).otherwise(F.col("user_id").cast("string"))
    line = F.concat(F.lit('{"event_id":'), number, F.lit(',"user_id":"'), user, F.lit('"}'))
    t.events.select(F.when(number % 131 == 0, F.lit("{")).otherwise(line).alias("value")).write.text(path)
    errors = sources.validate_load(t.spark, path, {k: _LOAD[k] for k in ("event_id", "user_id")})
    return errors.groupBy("error").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, c_acctbal, NULL AS c_phone FROM customer")
def copy_into_csv_by_name(t: Tables) -> DataFrame:
    path = t.scratch("by-name")
    # Three orders of columns in one folder.
    names = [F.col("c_acctbal").alias("C_ACCTBAL"), F.col("c_custkey").alias("C_CustKey"), F.col("c_name").alias("c_NAME")]
    for part, columns in ((0, names), (1, names[::-1]), (2, [names[1], names[0], names[2]])):
        t.customer.where(F.col("c_custkey") % 3 == part).select(*columns).write.mode("append").option("header", True).csv(path)
    target = "c_custkey bigint, c_name string, c_acctbal double, c_phone string"
    return sources.read_csv_by_name(t.spark, path, target)


@query("SELECT event_id, 'events.parquet' AS source_file, event_id AS file_row_number FROM events")
def load_metadata(t: Tables) -> DataFrame:
    rows = sources.read_with_metadata(t.spark, t.path("events"))
    return rows.select("event_id", "source_file", "file_row_number")


@query(with_flat("SELECT event_type, source, COUNT(*) AS event_count FROM flat GROUP BY 1, 2"))
def sink_csv_single(t: Tables) -> DataFrame:
    path = t.scratch("summary")
    sinks.write_csv(count_by(flat(t), ["event_type", "source"]), path, single_file=True)
    return sources.read_csv(t.spark, path, "event_type string, source string, event_count bigint")


@query(with_flat("SELECT event_id, event_type, source, event_date FROM flat"))
def sink_parquet_partitioned(t: Tables) -> DataFrame:
    path = t.scratch("partitioned")
    sinks.write_partitioned(flat(t).select("event_id", "event_type", "source", "event_date"), path)
    return t.spark.read.parquet(path)


@query("""SELECT f.format, s_suppkey, s_name, s_acctbal FROM supplier, (VALUES ('json'), ('parquet'), ('csv')) f(format)""")
def sink_json_parquet_csv(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    shape, out = "s_suppkey bigint, s_name string, s_acctbal double", []
    for kind in ("json", "parquet", "csv"):
        path = t.scratch(kind)
        rows.write.format(kind).save(path)
        out.append(t.spark.read.format(kind).schema(shape).load(path).withColumn("format", F.lit(kind)))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""SELECT c_mktsegment, 2 * count(*) AS n, TRUE AS error_raised FROM customer GROUP BY 1""")
def write_modes(t: Tables) -> DataFrame:
    path, rows = t.scratch("modes"), t.customer.select("c_custkey", "c_mktsegment")
    rows.write.mode("error").parquet(path)
    rows.write.mode("overwrite").parquet(path)
    rows.write.mode("append").parquet(path)
    rows.write.mode("ignore").parquet(path)
    try:
        rows.write.mode("error").parquet(path)
        raised = False
    except AnalysisException:
        raised = True
    counts = t.spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return counts.withColumn("error_raised", F.lit(raised))


@query("SELECT p_partkey || chr(9) || p_name AS value FROM part")
def sink_text(t: Tables) -> DataFrame:
    path = t.scratch("parts")
    sinks.write_text(t.part, path, ["p_partkey", "p_name"])
    return t.spark.read.text(path)


@query(with_feed("""SELECT nullif(event_id, '') AS event_id, event_type, nullif(user_id, '') AS user_id, event_ts, source,
 CASE WHEN trim(coalesce(event_id, ''), ' ') = '' THEN 'missing event_id' WHEN trim(coalesce(user_id, ''), ' ') = '' THEN 'missing user_id'
 ELSE 'invalid event_ts' END AS reject_reason FROM feed
WHERE trim(coalesce(event_id, ''), ' ') = '' OR trim(coalesce(user_id, ''), ' ') = '' OR true_time IS NULL"""))
def sink_rejects(t: Tables) -> DataFrame:
    path = t.scratch("rejects")
    _, bad = split_reason(first_reason(payload_events(t)))
    sinks.write_rejects(bad, path)
    columns = "event_id string, event_type string, user_id string, event_ts string, source string, reject_reason string"
    return sources.read_csv(t.spark, path, columns)


@query(with_flat("""SELECT '{"total_events":' || sum(n) || ',"events_by_type":{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type)
 || '}}' AS value FROM (SELECT event_type, count(*) AS n FROM flat GROUP BY 1)"""))
def sink_json_summary(t: Tables) -> DataFrame:
    path = t.scratch("json-summary")
    sinks.write_json_summary(flat(t), path)
    return t.spark.read.text(path)


@query(with_flat("SELECT event_type, count(*) AS n FROM flat GROUP BY 1"))
def ctas(t: Tables) -> DataFrame:
    with TableScope(t.spark) as scope:
        name, path = scope.table("counts")
        t.spark.sql(
            f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT event_type, count(*) AS n FROM {{events}} GROUP BY event_type",
            events=flat(t),
        )
        return scope.keep(t.spark.table(name))


@query("SELECT o_orderpriority, count(*) AS n, 'first' AS run FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*), 'second' FROM orders GROUP BY 1")
def insert_select(t: Tables) -> DataFrame:
    with TableScope(t.spark) as scope:
        name, path = scope.table("runs")
        t.spark.sql(f"CREATE TABLE {name} (o_orderpriority STRING, n BIGINT, run STRING) USING parquet LOCATION '{path}'")
        for run in ("first", "second"):
            t.spark.sql(
                f"INSERT INTO {name} SELECT o_orderpriority, count(*), '{run}' FROM {{orders}} GROUP BY o_orderpriority", orders=t.orders
            )
        return scope.keep(t.spark.table(name))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def create_view(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("loom_raw_events")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY VIEW loom_typed_events AS
        SELECT event_id, try_variant_get(try_parse_json(props), '$.k', 'int') AS k FROM loom_raw_events"""
    )
    return t.spark.table("loom_typed_events")


@query(with_feed("SELECT event_id, event_type, user_id, event_ts, source FROM feed"))
def sink_stream_parquet(t: Tables) -> DataFrame:
    landing, out, marks = t.scratch("landing"), t.scratch("raw"), t.scratch("marks")
    payload_events(t).drop("line_no").write.json(landing)
    append_parquet(file_stream(t.spark, landing), out, marks).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "event_type", "user_id", "event_ts", "source")


@query("""SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS value,
 'app.events' AS topic FROM events""")
def sink_kafka_keyed(t: Tables) -> DataFrame:
    return encode_events(t.events.select("event_id", "event_type", "user_id"), "user_id", "app.events")
