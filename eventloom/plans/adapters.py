"""The given tables in the shapes of the event domain.

``events`` is clean, so defects are planted by arithmetic on the event id: the arithmetic decides which rows are
damaged and how, while every row stays in. Spark and SQL texts state the same rules, so both see the same data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.plans.registry import Tables

# Rules both dialects read the same way.
_TYPE = """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'video_play'
 WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'video_pause' ELSE event_type END"""
_SOURCE = "CASE user_id % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' WHEN 2 THEN 'api' ELSE 'system' END"


def _feed_columns(iso: str, second: str, k: str) -> dict[str, str]:
    return {
        "line_no": "event_id",
        "event_id": "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 113 = 0 THEN '  ' ELSE concat('evt_', event_id) END",
        "event_type": f"CASE WHEN event_id % 71 = 0 THEN 'logout' ELSE {_TYPE} END",
        "user_id": """CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 109 = 0 THEN ' '
            ELSE concat('user_', user_id) END""",
        "event_ts": f"CASE WHEN event_id % 89 = 0 THEN 'not-a-timestamp' ELSE {iso} END",
        "true_time": f"CASE WHEN event_id % 89 = 0 THEN NULL ELSE {second} END",
        "source": f"CASE WHEN event_id % 101 = 0 THEN 'partner' ELSE {_SOURCE} END",
        "k": f"CASE WHEN event_id % 103 = 0 THEN NULL ELSE {k} END",
        "amount": f"""CASE WHEN event_id % 103 = 0 OR event_type <> 'purchase' THEN NULL WHEN event_id % 61 = 0 THEN '-5'
            WHEN event_id % 67 = 0 THEN 'abc' ELSE {k} END""",
        "no_payload": "event_id % 103 = 0",
        "base_id": "event_id",
    }


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


_COPIES = "base_id % 83 = 0"
_COPY_OFFSET = 1_000_000_000_000

_DUCK_FEED = _feed_columns(
    iso="strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", second="date_trunc('second', ts)", k="json_extract_string(props, '$.k')"
)
_SPARK_FEED = _feed_columns(
    iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", second="CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ)",
    k="get_json_object(props, '$.k')",
)

FEED_SQL = f"""feed AS (
 WITH one AS (SELECT {", ".join(_select(_DUCK_FEED))} FROM events)
 SELECT * FROM one
 UNION ALL
 SELECT * REPLACE (line_no + {_COPY_OFFSET} AS line_no) FROM one WHERE {_COPIES})"""


def feed(t: Tables) -> DataFrame:
    """Raw events as they arrive: text columns, defects, and later copies of some lines."""
    one = t.events.selectExpr(*_select(_SPARK_FEED))
    copies = one.where(_COPIES).withColumn("line_no", F.col("line_no") + _COPY_OFFSET)
    return one.unionByName(copies)


def payload_events(t: Tables) -> DataFrame:
    """The feed in the declared event shape, with the payload as a text map and the line number kept."""
    payload = F.when(~F.col("no_payload"), F.create_map(F.lit("k"), "k", F.lit("amount"), "amount"))
    return feed(t).select("line_no", "event_id", "event_type", "user_id", "event_ts", "source", payload.alias("payload"))


FLAT_SQL = f"""flat AS (
 SELECT event_id, {_TYPE} AS event_type, user_id, {_SOURCE} AS source, ts AS event_time, CAST(ts AS DATE) AS event_date,
  CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS amount
 FROM events)"""


def flat(t: Tables) -> DataFrame:
    """Clean events with a source and a typed amount for purchases."""
    return t.events.selectExpr(
        "event_id", f"{_TYPE} AS event_type", "user_id", f"{_SOURCE} AS source", "ts AS event_time",
        "CAST(ts AS DATE) AS event_date", "CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS amount",
    )


USERS_SQL = """users AS (
 SELECT c_custkey AS user_id, c_mktsegment AS plan, n_name AS region
 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0)"""


def users(t: Tables) -> DataFrame:
    """Users with plan and region. Accounts in debt are not listed, so some events have no user."""
    known = t.customer.where(F.col("c_acctbal") >= 0)
    return known.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("plan"), F.col("n_name").alias("region")
    )


def with_feed(sql: str) -> str:
    return f"WITH {FEED_SQL}\n{sql}"


def with_flat(sql: str) -> str:
    return f"WITH {FLAT_SQL}, {USERS_SQL}\n{sql}"
