"""Validation and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import money
from eventloom.functions import variants
from eventloom.functions.text import is_blank
from eventloom.operators import checks
from eventloom.operators.quality import (
    all_errors,
    collect_errors,
    dq_summary as summary_of,
    first_reason,
    payload_facts,
    payload_rules,
    quality_check,
    require_fields,
    require_rows,
    run_summary,
    split_errors,
    validate_lines,
)
from eventloom.operators.windows import count_per_key, later_copies
from eventloom.plans.adapters import feed, payload_events, users, with_feed, with_flat
from eventloom.plans.aggregates import VALID_SQL
from eventloom.plans.registry import Tables, query
from eventloom.plans.scalars import _ERRORS_SQL
from eventloom.warehouse.gold import fact_dim_orphans
from eventloom.warehouse.silver import reject_log


@query(with_feed(f"SELECT line_no, event_id, array_to_string({_ERRORS_SQL}, '; ') AS validation_errors FROM feed"))
def dq_collect_errors(t: Tables) -> DataFrame:
    checked = collect_errors(payload_events(t))
    return checked.select("line_no", "event_id", F.array_join("validation_errors", "; ").alias("validation_errors"))


@query(with_feed("""SELECT line_no, CASE WHEN trim(coalesce(event_id, ''), ' ') = '' THEN 'missing event_id'
 WHEN trim(coalesce(user_id, ''), ' ') = '' THEN 'missing user_id' WHEN true_time IS NULL THEN 'invalid event_ts' END AS reject_reason FROM feed"""))
def dq_first_reason(t: Tables) -> DataFrame:
    return first_reason(payload_events(t)).select("line_no", "reject_reason")


@query(with_feed(f"SELECT line_no, CASE WHEN {VALID_SQL} THEN 'valid' ELSE 'invalid' END AS side FROM feed"))
def dq_split(t: Tables) -> DataFrame:
    valid, invalid = split_errors(collect_errors(payload_events(t)).select("line_no", "validation_errors"))
    return valid.select("line_no", F.lit("valid").alias("side")).union(invalid.select("line_no", F.lit("invalid").alias("side")))


# Payloads with typed values, some of them of the wrong type, chosen by arithmetic on the event id.
_PAYLOAD = """CASE event_type
 WHEN 'page_view' THEN CASE WHEN base_id % 7 = 0 THEN '{"page":"  "}' ELSE '{"page":"/p' || base_id || '"}' END
 WHEN 'video_play' THEN CASE WHEN base_id % 7 = 0 THEN '{"video_id":"v1","position_seconds":-1}'
  WHEN base_id % 7 = 1 THEN '{"video_id":"v1","position_seconds":true}' ELSE '{"video_id":"v1","position_seconds":2.5}' END
 WHEN 'video_pause' THEN CASE WHEN base_id % 7 = 0 THEN '{"position_seconds":0}' ELSE '{"video_id":"v2","position_seconds":0}' END
 WHEN 'add_to_cart' THEN CASE WHEN base_id % 7 = 0 THEN '{"sku":"s","quantity":2.0}' WHEN base_id % 7 = 1 THEN '{"sku":"","quantity":0}'
  ELSE '{"sku":"s","quantity":2}' END
 WHEN 'purchase' THEN CASE WHEN base_id % 7 = 0 THEN '{"amount":0}' WHEN base_id % 7 = 1 THEN '{"amount":9.5,"plan":null}'
  ELSE '{"amount":9.5,"plan":"pro"}' END
 ELSE '{}' END"""

_PAYLOAD_ERRORS = """CASE
 WHEN event_type = 'page_view' AND base_id % 7 = 0 THEN 'page_view payload.page must be a non-empty string'
 WHEN event_type = 'video_play' AND base_id % 7 <= 1 THEN 'video_play payload.position_seconds must be a non-negative number'
 WHEN event_type = 'video_pause' AND base_id % 7 = 0 THEN 'video_pause payload.video_id must be a non-empty string'
 WHEN event_type = 'add_to_cart' AND base_id % 7 = 0 THEN 'add_to_cart payload.quantity must be a positive integer'
 WHEN event_type = 'add_to_cart' AND base_id % 7 = 1
  THEN 'add_to_cart payload.sku must be a non-empty string; add_to_cart payload.quantity must be a positive integer'
 WHEN event_type = 'purchase' AND base_id % 7 = 0 THEN 'purchase payload.amount must be a positive number'
 WHEN event_type = 'purchase' AND base_id % 7 = 1 THEN 'purchase payload.plan must be a non-empty string'
 ELSE '' END"""


@query(with_feed(f"SELECT line_no, {_PAYLOAD_ERRORS} AS errors FROM feed"))
def dq_payload_rules(t: Tables) -> DataFrame:
    events = feed(t).selectExpr("line_no", "event_type", f"parse_json({_PAYLOAD}) AS payload")
    errors = all_errors(payload_rules(F.col("event_type")))
    return payload_facts(events).select("line_no", F.array_join(errors, "; ").alias("errors"))


_NUMBER = "CASE base_id % 5 WHEN 0 THEN '{\"n\":1}' WHEN 1 THEN '{\"n\":1.5}' WHEN 2 THEN '{\"n\":true}' WHEN 3 THEN '{\"n\":\"1\"}' ELSE '{}' END"


@query(with_feed("SELECT line_no, base_id % 5 <= 1 AS is_number, base_id % 5 = 0 AS is_integer FROM feed"))
def dq_is_number(t: Tables) -> DataFrame:
    value = variants.get(F.col("v"), "n")
    return feed(t).selectExpr("line_no", f"parse_json({_NUMBER}) AS v").select(
        "line_no", variants.is_number(value).alias("is_number"), variants.is_integer(value).alias("is_integer")
    )


# Whole lines: a missing user key, a null user, broken text, or a complete event.
_LINE = """CASE WHEN base_id % 131 = 0 THEN '{"event_id":"x'
 WHEN base_id % 17 = 0 THEN '{"event_id":"' || event_id || '","event_type":"page_view","event_ts":"2024-01-01T00:00:00Z","payload":{"page":"/"}}'
 WHEN base_id % 19 = 0 THEN '{"event_id":"' || event_id || '","event_type":"page_view","user_id":null,"event_ts":"2024-01-01T00:00:00","source":"web","payload":{"page":"/"}}'
 WHEN base_id % 23 = 0 THEN '[1]'
 ELSE '{"event_id":"' || event_id || '","event_type":"page_view","user_id":"u","event_ts":"2024-01-01T00:00:00Z","source":"web","payload":{"page":"/"}}' END"""
_BLANK_ID = "trim(event_id, ' ') = ''"
_ID_ERROR = f"CASE WHEN {_BLANK_ID} THEN 'event_id must be a non-empty string' END"
_LINE_ERRORS = f"""CASE WHEN base_id % 131 = 0 THEN ['invalid JSON at column 13: Unterminated string starting at']
 WHEN base_id % 17 = 0 THEN ['missing fields: [''source'', ''user_id'']', {_ID_ERROR}]
 WHEN base_id % 19 = 0 THEN [{_ID_ERROR}, 'user_id must be a non-empty string', 'event_ts must be an ISO 8601 timestamp with a timezone']
 WHEN base_id % 23 = 0 THEN ['event must be a JSON object'] ELSE [{_ID_ERROR}] END"""
_LINE_IS_EVENT = "base_id % 131 <> 0 AND (base_id % 17 = 0 OR base_id % 19 = 0 OR base_id % 23 <> 0)"


def lines(t: Tables) -> DataFrame:
    return feed(t).selectExpr("line_no AS line_number", "base_id", f"{_LINE} AS value")


@query(with_feed(f"""SELECT line_no AS line_number, array_to_string(list_filter(list_concat({_LINE_ERRORS}, [CASE WHEN {_LINE_IS_EVENT}
 AND NOT {_BLANK_ID} AND line_no <> base_id THEN 'duplicate event_id: ' || event_id END]), lambda x: x IS NOT NULL), '; ') AS errors FROM feed"""))
def dq_validate_lines(t: Tables) -> DataFrame:
    judged = validate_lines(lines(t))
    return judged.select("line_number", F.array_join("errors", "; ").alias("errors"))


@query(with_feed(f"SELECT line_no, CASE WHEN {_LINE_IS_EVENT} AND base_id % 17 = 0 THEN 'source,user_id' WHEN {_LINE_IS_EVENT} THEN '' END AS missing FROM feed"))
def dq_missing_fields(t: Tables) -> DataFrame:
    from eventloom.contract import REQUIRED_FIELDS

    # The key test needs an object; other JSON values, and text that is no JSON, have no keys.
    is_object = variants.is_object(F.try_parse_json("value"))
    expected = F.array(*[F.lit(f) for f in sorted(REQUIRED_FIELDS)])
    keys = F.when(is_object, F.json_object_keys("value"))
    return lines(t).select(
        F.col("line_number").alias("line_no"), F.array_join(F.array_except(expected, keys), ",").alias("missing")
    )


@query(with_feed("SELECT line_no, base_id % 131 = 0 AS is_bad FROM feed"))
def dq_bad_json(t: Tables) -> DataFrame:
    return lines(t).select(F.col("line_number").alias("line_no"), F.try_parse_json("value").isNull().alias("is_bad"))


@query(with_feed("""SELECT line_no, event_id, row_number() OVER (PARTITION BY event_id ORDER BY line_no) > 1
 AND trim(event_id, ' ') <> '' AS is_duplicate FROM feed"""))
def dq_dup_later(t: Tables) -> DataFrame:
    copies = later_copies(feed(t).select("line_no", "event_id"), ["event_id"], "line_no", "_later")
    return copies.select("line_no", "event_id", (F.col("_later") & ~is_blank(F.col("event_id"))).alias("is_duplicate"))


@query(with_feed("SELECT line_no, event_id FROM (SELECT *, count(*) OVER (PARTITION BY event_id) AS n FROM feed) WHERE n > 1"))
def dq_dup_all(t: Tables) -> DataFrame:
    counted = count_per_key(feed(t).select("line_no", "event_id"), ["event_id"], "n")
    return counted.where("n > 1").select("line_no", "event_id")


@query(with_feed("""SELECT line_no, event_type = 'purchase' AND (try_cast(amount AS DOUBLE) IS NULL OR try_cast(amount AS DOUBLE) < 0) AS is_invalid
FROM feed"""))
def dq_purchase_amount(t: Tables) -> DataFrame:
    amount = F.col("amount").try_cast("double")
    bad = (F.col("event_type") == "purchase") & (amount.isNull() | (amount < 0))
    return feed(t).select("line_no", bad.alias("is_invalid"))


_QUALITY = """judged AS (SELECT *, CASE WHEN event_id IS NULL OR event_id = '' THEN 'missing event_id'
 WHEN user_id IS NULL OR user_id = '' THEN 'missing user_id' WHEN true_time IS NULL THEN 'invalid event_ts'
 WHEN count(*) OVER (PARTITION BY event_id) > 1 THEN 'duplicate event_id'
 WHEN event_type = 'purchase' AND (try_cast(amount AS DOUBLE) IS NULL OR try_cast(amount AS DOUBLE) < 0) THEN 'invalid purchase amount'
 END AS reject_reason FROM feed)"""


@query(with_feed("SELECT 1").replace("\nSELECT 1", f", {_QUALITY} SELECT CASE WHEN reject_reason IS NULL THEN 'pass' ELSE 'fail' END AS dq_status, reject_reason, COUNT(*) AS record_count FROM judged GROUP BY 1, 2"))
def dq_summary(t: Tables) -> DataFrame:
    return summary_of(quality_check(payload_events(t)))


@query(with_feed(f"SELECT count(*) FILTER ({VALID_SQL}) AS valid, count(*) FILTER (NOT ({VALID_SQL})) AS invalid, bool_and({VALID_SQL}) AS passed FROM feed"))
def dq_run_summary(t: Tables) -> DataFrame:
    return run_summary(collect_errors(payload_events(t)))


@query("SELECT event_id AS line_number, event_type FROM events")
def dq_fail_fast(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("event_id", "event_type", "user_id")]))
    # Every field is present as text, so the rule lets all lines pass; a bad line would end the job.
    complete = t.events.select(F.col("event_id").alias("line_number"), F.concat(F.lit("e"), "event_id").alias("id"), "event_type", body.alias("value"))
    named = complete.withColumn("value", F.regexp_replace("value", r':"(\d+)"', ':"n$1"'))
    checked = require_fields(require_rows(named, "no events"), ["event_id", "event_type", "user_id"])
    return checked.select("line_number", "event_type")


# The expected shape as rows, compared with what the catalogue says of the table.
@query("""WITH expected AS (SELECT * FROM (VALUES (1, 'event_id', 'BIGINT', 'bigint'), (2, 'user_id', 'BIGINT', 'bigint'), (3, 'source', 'VARCHAR', 'string'),
  (4, 'value', 'DECIMAL(18,2)', 'decimal(18,2)')) e(place, name, kind, shown)),
found AS (SELECT column_name AS name, column_type AS kind FROM (DESCRIBE SELECT * FROM events)),
differences AS (SELECT place, CASE WHEN f.name IS NULL THEN 'missing column ' || e.name
  WHEN f.kind <> e.kind THEN 'column ' || e.name || ' is ' || lower(f.kind) || ', expected ' || shown END AS says
 FROM expected e LEFT JOIN found f ON e.name = f.name)
SELECT (SELECT count(*) FROM events) AS n_rows, string_agg(says, ',' ORDER BY place) AS differences FROM differences WHERE says IS NOT NULL""")
def dq_schema_contract(t: Tables) -> DataFrame:
    from pyspark.sql import types as T

    expected = T.StructType.fromDDL("event_id bigint, user_id bigint, source string, value decimal(18,2)")
    found = ",".join(checks.schema_differences(t.events.schema, expected))
    return t.events.agg(F.count("*").alias("n_rows")).withColumn("differences", F.lit(found))


@query(with_feed("SELECT line_no FROM feed WHERE user_id IS NULL"))
def dq_not_null(t: Tables) -> DataFrame:
    return checks.not_null(feed(t), "user_id").select("line_no")


@query(with_feed("SELECT event_id, count(*) AS n_rows FROM feed WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"))
def dq_unique(t: Tables) -> DataFrame:
    return checks.unique(feed(t), "event_id")


@query(with_feed("SELECT source, count(*) AS n_rows FROM feed WHERE source NOT IN ('web', 'mobile', 'api', 'system') GROUP BY 1"))
def dq_accepted_values(t: Tables) -> DataFrame:
    return checks.accepted_values(feed(t), "source", ("web", "mobile", "api", "system"))


@query(with_flat("SELECT user_id, count(*) AS n_rows FROM flat WHERE user_id NOT IN (SELECT user_id FROM users) GROUP BY 1"))
def dq_relationships(t: Tables) -> DataFrame:
    return checks.relationships(t.events, "user_id", users(t), "user_id")


@query(with_feed("SELECT line_no, amount FROM feed WHERE event_type = 'purchase' AND try_cast(amount AS DOUBLE) <= 0"))
def dq_singular(t: Tables) -> DataFrame:
    failing = (F.col("event_type") == "purchase") & (F.col("amount").try_cast("double") <= 0)
    return feed(t).where(failing).select("line_no", "amount")


@query(with_feed("""SELECT 'user_id not null' AS test, 'warning' AS severity, count(*) FILTER (user_id IS NULL) AS failures, count(*) FILTER (user_id IS NULL) = 0 AS passed FROM feed
UNION ALL SELECT 'source allowed', 'error', count(*) FILTER (source = 'partner'), count(*) FILTER (source = 'partner') = 0 FROM feed
UNION ALL SELECT 'no negative price', 'critical', count(*) FILTER (o_totalprice < 0), count(*) FILTER (o_totalprice < 0) = 0 FROM orders"""))
def dq_severity(t: Tables) -> DataFrame:
    return checks.report(
        [
            checks.outcome("user_id not null", checks.not_null(feed(t), "user_id"), "warning"),
            checks.outcome("source allowed", feed(t).where(~F.col("source").isin("web", "mobile", "api", "system")), "error"),
            checks.outcome("no negative price", t.orders.where("o_totalprice < 0"), "critical"),
        ]
    )


@query("SELECT max(ts) AS latest, max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR AS passed FROM events")
def dq_freshness(t: Tables) -> DataFrame:
    return checks.freshness(t.events, "ts", F.lit("2024-01-31").cast("timestamp_ntz"), "1 HOUR")


@query("SELECT max(o_orderdate) AS latest, max(o_orderdate) >= TIMESTAMP '2001-08-02' - INTERVAL 3 DAY AS passed FROM orders")
def source_freshness_decl(t: Tables) -> DataFrame:
    # A declared source: its table, the column that says when rows were loaded, and how late it may be.
    source = {"table": "orders", "loaded_at_field": "o_orderdate", "limit": "3 DAYS"}
    as_of = F.lit("2001-08-02").cast("timestamp_ntz")
    return checks.freshness(getattr(t, source["table"]), source["loaded_at_field"], as_of, source["limit"])


@query("SELECT count(*) AS n_rows, count(*) BETWEEN 100 AND 1000000000000 AS passed FROM events")
def dq_volume(t: Tables) -> DataFrame:
    return checks.volume(t.events, 100, 1_000_000_000_000)


@query("""SELECT CAST(d AS DATE) AS day FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) g(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""")
def dq_partitions_arrived(t: Tables) -> DataFrame:
    return checks.missing_dates(t.events, "ts", "2023-12-30", "2024-02-02")


@query(with_feed("""SELECT count(*) FILTER (true_time IS NULL) AS bad, count(*) AS total,
 round(count(*) FILTER (true_time IS NULL) / CAST(count(*) AS DOUBLE), 6) AS rate,
 count(*) FILTER (true_time IS NULL) / CAST(count(*) AS DOUBLE) <= 0.05 AS passed FROM feed"""))
def dq_parse_error_rate(t: Tables) -> DataFrame:
    return checks.error_rate(feed(t), F.try_to_timestamp("event_ts").isNull(), 0.05)


@query(with_feed("""SELECT 'user_id' AS "column", count(user_id) AS filled, round(100 * count(user_id) / CAST(count(*) AS DOUBLE), 4) AS pct_filled FROM feed
UNION ALL SELECT 'amount', count(amount), round(100 * count(amount) / CAST(count(*) AS DOUBLE), 4) FROM feed"""))
def dq_completeness(t: Tables) -> DataFrame:
    return checks.completeness(feed(t), ["user_id", "amount"])


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount NOT BETWEEN 0.01 AND 0.09")
def dq_validity_range(t: Tables) -> DataFrame:
    return checks.out_of_range(t.lineitem, "l_discount", 0.01, 0.09).select("l_orderkey", "l_linenumber", "l_discount")


@query("""SELECT o_orderkey, o_orderstatus, n_open FROM orders JOIN (SELECT l_orderkey, count(*) FILTER (l_linestatus = 'O') AS n_open
 FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' AND n_open > 0""")
def dq_consistency(t: Tables) -> DataFrame:
    # A finished order must have no open line.
    open_lines = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "O").alias("n_open"))
    finished = t.orders.where("o_orderstatus = 'F'").join(open_lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return finished.where("n_open > 0").select("o_orderkey", "o_orderstatus", "n_open")


@query(with_feed("""SELECT CASE WHEN trim(coalesce(event_id, ''), ' ') = '' THEN 'missing event_id' WHEN trim(coalesce(user_id, ''), ' ') = '' THEN 'missing user_id'
 ELSE 'invalid event_ts' END AS reject_reason, source, count(*) AS rejected_count, TIMESTAMP '2024-02-01' AS detected_at
FROM feed WHERE trim(coalesce(event_id, ''), ' ') = '' OR trim(coalesce(user_id, ''), ' ') = '' OR true_time IS NULL GROUP BY 1, 2"""))
def dq_reject_log(t: Tables) -> DataFrame:
    rejected = first_reason(payload_events(t)).where(F.col("reject_reason").isNotNull())
    return reject_log(rejected, "source", F.lit("2024-02-01").cast("timestamp_ntz"))


@query("""SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS raw_amount,
 CAST((SELECT SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders) AS DOUBLE) AS modeled_amount FROM lineitem
HAVING abs(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) - (SELECT SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)) > 0.01""")
def dq_reconcile_sums(t: Tables) -> DataFrame:
    apart = checks.reconcile_sums(t.lineitem, "l_extendedprice", t.orders, "o_totalprice")
    return apart.select(*[F.col(c).cast("double").alias(c) for c in apart.columns])


@query(with_flat("""SELECT 'users' AS dimension, count(*) FILTER (user_id NOT IN (SELECT user_id FROM users)) AS lost_rows FROM flat
UNION ALL SELECT 'parts', count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem"""))
def dq_fact_dim_integrity(t: Tables) -> DataFrame:
    lost = [
        fact_dim_orphans(t.events, users(t), "user_id", "user_id", "users"),
        fact_dim_orphans(t.lineitem, t.part, "l_partkey", "p_partkey", "parts"),
    ]
    return checks.report(lost)


@query("""SELECT 'revenue' AS kpi, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS warehouse, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS report,
 TRUE AS passed FROM events WHERE event_type = 'purchase'""")
def dq_kpi_match(t: Tables) -> DataFrame:
    # The report adds up daily figures; the warehouse adds up rows.
    purchases = t.events.where("event_type = 'purchase'").withColumn("amount", money(F.col("value")))
    daily = purchases.groupBy(F.to_date("ts").alias("day")).agg(F.sum("amount").alias("amount"))
    both = checks.one_row(warehouse=(purchases, F.sum("amount")), report=(daily, F.sum("amount")))
    return both.select(
        F.lit("revenue").alias("kpi"), F.col("warehouse").cast("double").alias("warehouse"),
        F.col("report").cast("double").alias("report"), (F.col("warehouse") == F.col("report")).alias("passed"),
    )


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def dq_empty_output(t: Tables) -> DataFrame:
    return require_rows(t.events.groupBy("event_type").agg(F.count("*").alias("n")), "summary has no rows")
