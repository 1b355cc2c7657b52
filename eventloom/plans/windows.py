"""Questions about the rows around a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import money
from eventloom.operators import checks
from eventloom.operators.measures import pct_of_total
from eventloom.operators.windows import count_per_key, latest_per_key, running_balance, top_per_group, with_neighbour
from eventloom.plans.adapters import feed, flat, with_feed, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.warehouse.changes import history


@query(with_feed("SELECT line_no, event_id, count(*) OVER (PARTITION BY event_id) AS id_count FROM feed"))
def win_count_partition(t: Tables) -> DataFrame:
    return count_per_key(feed(t).select("line_no", "event_id"), ["event_id"], "id_count")


@query("""SELECT user_id, event_id, event_type, ts FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def win_latest_row(t: Tables) -> DataFrame:
    return latest_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"])


@query(with_flat("""SELECT event_date, source, n FROM (
 SELECT event_date, source, count(*) AS n, row_number() OVER (PARTITION BY event_date ORDER BY count(*) DESC, source) AS r
 FROM flat GROUP BY 1, 2) WHERE r = 1"""))
def win_top_source_per_day(t: Tables) -> DataFrame:
    counts = flat(t).groupBy("event_date", "source").agg(F.count("*").alias("n"))
    return top_per_group(counts, ["event_date"], [F.desc("n"), F.asc("source")])


@query(with_flat("""SELECT source, event_type, count(*) AS n,
 round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY source) AS DOUBLE), 6) AS share FROM flat GROUP BY 1, 2"""))
def win_share(t: Tables) -> DataFrame:
    counts = flat(t).groupBy("source", "event_type").agg(F.count("*").alias("n"))
    return pct_of_total(counts, "n", ["source"], "share")


_MOVES = """moves AS (SELECT user_id, event_id, CAST(CASE WHEN event_type IN ('purchase', 'error') THEN -3 * value ELSE value END
 AS DECIMAL(18,2)) AS amount, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""


@query(f"""WITH RECURSIVE {_MOVES},
ledger AS (
 SELECT user_id, event_id, amount, n, 50 + amount >= 0 AS accepted,
  CAST(CASE WHEN 50 + amount >= 0 THEN 50 + amount ELSE 50 END AS DECIMAL(18,2)) AS balance FROM moves WHERE n = 1
 UNION ALL
 SELECT m.user_id, m.event_id, m.amount, m.n, balance + m.amount >= 0,
  CAST(CASE WHEN balance + m.amount >= 0 THEN balance + m.amount ELSE balance END AS DECIMAL(18,2))
 FROM ledger l JOIN moves m ON m.user_id = l.user_id AND m.n = l.n + 1)
SELECT user_id, event_id, CAST(amount AS DOUBLE) AS amount, accepted, CAST(balance AS DOUBLE) AS balance FROM ledger""")
def win_running_balance(t: Tables) -> DataFrame:
    spends = F.col("event_type").isin("purchase", "error")
    moves = t.events.select(
        "user_id", "event_id", "ts", F.when(spends, -3 * F.col("value")).otherwise(F.col("value")).alias("amount")
    ).withColumn("amount", money(F.col("amount")))
    ledger = running_balance(moves, "user_id", ["ts", "event_id"], "amount", opening="50")
    return ledger.select(
        "user_id", "event_id", F.col("amount").cast("double").alias("amount"), "accepted", F.col("balance").cast("double").alias("balance")
    )


# A customer's order priority seen as an attribute that changes over time.
_HISTORY = """seen AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority AS priority,
  lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
changes AS (SELECT * FROM seen WHERE before IS NULL OR before <> priority),
history AS (SELECT o_custkey, priority, o_orderdate AS valid_from,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to FROM changes)"""


def priority_history(t: Tables) -> DataFrame:
    versions = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("priority"))
    return history(versions, "o_custkey", ["o_orderdate", "o_orderkey"], ["priority"])


@query(f"WITH {_HISTORY} SELECT o_custkey, priority, valid_from, valid_to, valid_to IS NULL AS is_current FROM history")
def win_scd2_validity(t: Tables) -> DataFrame:
    return priority_history(t)


@query("""WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate AS valid_from, o_orderdate + INTERVAL 90 DAY AS valid_to FROM orders),
n AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey) AS following FROM v)
SELECT o_custkey, o_orderkey FROM n WHERE following < valid_to""")
def win_overlap_check(t: Tables) -> DataFrame:
    windows = t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("valid_to"),
    )
    followed = with_neighbour(
        windows, ["o_custkey"], ["valid_from", "o_orderkey"], ["valid_from"], "following", 1
    )
    return checks.overlapping(followed, "following", "valid_to", "valid_from").select("o_custkey", "o_orderkey")
