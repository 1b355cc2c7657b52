"""Grouped and global aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import money, total_with_tax
from eventloom.operators.joins import enrich
from eventloom.operators.measures import count_by, summarize, value_counts, values_per_key, weighted_moments, word_count
from eventloom.operators.quality import collect_errors, first_reason, split_errors, split_reason
from eventloom.operators.windows import median_of_counts
from eventloom.plans.adapters import feed, flat, payload_events, users, with_feed, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.plans.rows import WORDS_SQL
from eventloom.session import cut_lineage

VALID_SQL = """trim(coalesce(event_id, ''), ' ') <> '' AND event_type IN ('page_view', 'video_play', 'video_pause', 'add_to_cart', 'purchase')
 AND trim(coalesce(user_id, ''), ' ') <> '' AND true_time IS NOT NULL AND source IN ('web', 'mobile', 'api', 'system')
 AND NOT no_payload"""
GOOD_SQL = "trim(coalesce(event_id, ''), ' ') <> '' AND trim(coalesce(user_id, ''), ' ') <> '' AND true_time IS NOT NULL"


@query(with_feed(f"""SELECT event_type, source, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
 MIN(true_time) AS first_event_time, MAX(true_time) AS last_event_time FROM feed WHERE {VALID_SQL} GROUP BY 1, 2"""))
def agg_event_summary(t: Tables) -> DataFrame:
    valid, _ = split_errors(collect_errors(payload_events(t)))
    summary = summarize(valid, ["event_type", "source"], time="event_time")
    return summary.select(
        "event_type", "source", "event_count", "unique_users",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_event_time", "last_event_time")],
    )


@query(with_feed(f"""SELECT event_type, source, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users
FROM feed WHERE {GOOD_SQL} GROUP BY 1, 2"""))
def agg_batch_summary(t: Tables) -> DataFrame:
    good, _ = split_reason(first_reason(payload_events(t)))
    return summarize(good, ["event_type", "source"])


@query(with_feed("SELECT event_type, source, COUNT(*) AS event_count FROM feed GROUP BY 1, 2"))
def agg_count_by_type_source(t: Tables) -> DataFrame:
    return count_by(feed(t), ["event_type", "source"])


@query(with_feed("""SELECT event_type, source, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users
FROM feed WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND true_time IS NOT NULL GROUP BY 1, 2"""))
def agg_null_filtered(t: Tables) -> DataFrame:
    timed = feed(t).withColumn("event_time", F.try_to_timestamp("event_ts"))
    return summarize(timed.dropna(subset=["event_id", "user_id", "event_time"]), ["event_type", "source"])


@query(with_flat("""SELECT e.event_date, COALESCE(u.plan, 'unknown') AS plan, COUNT(*) AS event_count
FROM flat e LEFT JOIN users u ON e.user_id = u.user_id GROUP BY 1, 2"""))
def agg_cached_by_date_plan(t: Tables) -> DataFrame:
    # Kept in memory (then on executor disks) until its result is stored, then released.
    kept = enrich(flat(t), users(t), "user_id", ["plan", "region"]).select("event_date", "plan").persist()
    try:
        return cut_lineage(kept.groupBy("event_date", "plan").agg(F.count("*").alias("event_count"))).orderBy("event_date", "plan")
    finally:
        kept.unpersist()


@query("""SELECT COUNT(*) AS n, CAST(AVG(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value
FROM events""")
def agg_global(t: Tables) -> DataFrame:
    exact_mean = F.sum(money(F.col("value"))).cast("double") / F.count("value")
    return t.events.agg(
        F.count("*").alias("n"), exact_mean.alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value")
    )


@query("""SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS avg_price
FROM orders GROUP BY 1""")
def agg_grouped(t: Tables) -> DataFrame:
    mean = F.sum(money(F.col("o_totalprice"))).cast("double") / F.count("o_totalprice")
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), mean.alias("avg_price"))


@query("SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 HAVING COUNT(*) > 60")
def agg_having(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).where("n > 60")


@query("""SELECT COUNT(l_quantity) AS n, round(AVG(l_quantity), 6) AS mean, round(STDDEV_SAMP(l_quantity), 6) AS sd,
 MIN(l_quantity) AS lo, MAX(l_quantity) AS hi FROM lineitem""")
def agg_describe(t: Tables) -> DataFrame:
    q = "l_quantity"
    return t.lineitem.agg(
        F.count(q).alias("n"), F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev_samp(q), 6).alias("sd"),
        F.min(q).alias("lo"), F.max(q).alias("hi"),
    )


@query("SELECT CAST(SUM(user_id) AS BIGINT) AS total FROM events")
def agg_reduce(t: Tables) -> DataFrame:
    return t.events.agg(F.sum("user_id").alias("total"))


@query(f"WITH {WORDS_SQL} SELECT word, count(*) AS n FROM words GROUP BY word")
def agg_reduce_by_key(t: Tables) -> DataFrame:
    return word_count(t.documents)


@query(f"WITH {WORDS_SQL} SELECT word AS item, count(*) AS n FROM words GROUP BY word")
def agg_count_words(t: Tables) -> DataFrame:
    from eventloom.functions.text import words
    from eventloom.operators.measures import count_items

    return count_items(t.documents.select(words(F.col("text")).alias("words")), "words")


@query("""SELECT user_id, place // 1000 AS piece, (total + 999) // 1000 AS n_pieces, string_agg(event_type, ',' ORDER BY event_id) AS types
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS total FROM events)
GROUP BY 1, 2, 3""")
def agg_group_by_key(t: Tables) -> DataFrame:
    grouped = values_per_key(t.events, "user_id", "event_type", "event_id")
    return grouped.select("user_id", "piece", "n_pieces", F.array_join("values", ",").alias("types"))


@query("SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1")
def agg_count_by_key(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"))


@query(with_flat("""SELECT CAST(date_trunc('day', event_time) AS DATE) AS event_date, event_type, source, COUNT(*) AS event_count,
 COUNT(DISTINCT user_id) AS unique_users FROM flat GROUP BY 1, 2, 3"""))
def agg_daily_mart(t: Tables) -> DataFrame:
    from eventloom.warehouse.gold import daily_mart

    return daily_mart(flat(t), "event_time")


@query("""SELECT l_orderkey, CAST(round(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * CAST(1.08 AS DECIMAL(5,4)), 2) AS DOUBLE) AS total
FROM lineitem GROUP BY 1""")
def agg_total_with_tax(t: Tables) -> DataFrame:
    subtotal = F.sum(money(F.col("l_extendedprice")))
    return t.lineitem.groupBy("l_orderkey").agg(total_with_tax(subtotal, "0.08").cast("double").alias("total"))


@query("""SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross
FROM lineitem GROUP BY 1""")
def agg_sum_expr(t: Tables) -> DataFrame:
    row = money(F.col("l_quantity")) * money(F.col("l_extendedprice"))
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(row).cast("double").alias("gross"))


@query(with_feed("""SELECT COUNT(try_cast(amount AS DOUBLE)) AS count_numbers, COUNT(amount) AS count_nonblank, COUNT(*) AS count_rows,
 COUNT(DISTINCT user_id) AS distinct_nonblank, COUNT(DISTINCT user_id) + MAX(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS distinct_with_blank
FROM feed"""))
def agg_counts_kinds(t: Tables) -> DataFrame:
    distinct = F.count_distinct("user_id")
    return feed(t).agg(
        F.count(F.col("amount").try_cast("double")).alias("count_numbers"), F.count("amount").alias("count_nonblank"),
        F.count("*").alias("count_rows"), distinct.alias("distinct_nonblank"),
        (distinct + F.max(F.col("user_id").isNull().cast("int"))).alias("distinct_with_blank"),
    )


@query("""SELECT c_mktsegment, round(AVG(o_totalprice), 4) AS mean, round(MEDIAN(o_totalprice), 4) AS median,
 round(STDDEV_POP(o_totalprice), 4) AS sd_pop, round(STDDEV_SAMP(o_totalprice), 4) AS sd_samp
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def agg_stats(t: Tables) -> DataFrame:
    # The join is read once, for the counts of prices; all four figures come from these.
    priced = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_totalprice")
    by, price = ["c_mktsegment"], "o_totalprice"
    counts = value_counts(priced, price, by)
    figures = weighted_moments(counts, price, by).join(median_of_counts(counts, price, by, "n"), by)
    return figures.select(*by, *[F.round(c, 4).alias(c) for c in ("mean", "median", "sd_pop", "sd_samp")])


@query("""SELECT COUNT(*) FILTER (valid) AS good, COUNT(*) FILTER (NOT valid) AS bad FROM
 (SELECT try_cast(amount AS DOUBLE) IS NOT NULL AS valid FROM feed WHERE amount IS NOT NULL)""".replace("SELECT COUNT", with_feed("SELECT COUNT"), 1))
def agg_bad_counter(t: Tables) -> DataFrame:
    # The counts are an aggregate of the parse itself, so a task that runs twice is counted once.
    number = F.col("amount").try_cast("double")
    parsed = feed(t).where(F.col("amount").isNotNull()).select(number.alias("number"))
    return parsed.agg(F.count("number").alias("good"), F.count_if(F.col("number").isNull()).alias("bad"))
