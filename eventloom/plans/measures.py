"""Business measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.numbers import money, safe_ratio
from eventloom.operators.measures import (
    count_sources,
    funnel,
    kpis,
    mastery,
    pct_of_total,
    retention,
    review_queue,
    Step,
    sum_through,
    year_over_year,
    z_scores,
)
from eventloom.plans.adapters import flat, with_flat
from eventloom.plans.registry import Tables, query


def _orders(t: Tables, *attributes: str) -> Step:
    """From an order line to its order; the columns a measure needs are named."""
    made = {
        "year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate"), "customer": F.col("o_custkey"), "order": F.col("o_orderkey")
    }
    lookup = t.orders.select(F.col("o_orderkey").alias("_order"), *[made[a].alias(a) for a in attributes])
    return Step("l_orderkey", lookup, "_order", attributes, how="inner")


def _part(t: Tables, name: str, attribute: str) -> Step:
    return Step("l_partkey", t.part.select("p_partkey", F.col(attribute).alias(name)), "p_partkey", (name,))


def _segment(t: Tables) -> Step:
    return Step("customer", t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")), "c_custkey", ("segment",))


def _amount() -> Column:
    return money(F.col("l_extendedprice"))


SALES_SQL = """sales AS (
 SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, o_orderkey, o_custkey, c_mktsegment AS segment,
  p_brand AS brand, p_type AS category, l_returnflag, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
 LEFT JOIN part ON l_partkey = p_partkey)"""


@query(f"""WITH {SALES_SQL} SELECT year, CAST(SUM(amount) AS DOUBLE) AS total_sales,
 CAST(SUM(amount) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned_sales FROM sales GROUP BY 1""")
def agg_filtered(t: Tables) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", _amount())
    sums = sum_through(t.lineitem, {"total_sales": _amount(), "returned_sales": returned}, [_orders(t, "year")])
    return sums.select("year", *[F.col(c).cast("double").alias(c) for c in ("total_sales", "returned_sales")])


@query(f"""WITH {SALES_SQL}, g AS (SELECT year, brand, SUM(amount) AS s FROM sales GROUP BY 1, 2)
SELECT year, brand, CAST(s AS DOUBLE) AS sales, round(CAST(s AS DOUBLE) / CAST(SUM(s) OVER (PARTITION BY year) AS DOUBLE), 6) AS pct FROM g""")
def agg_pct_of_total(t: Tables) -> DataFrame:
    by_brand = sum_through(t.lineitem, {"sales": _amount()}, [_orders(t, "year"), _part(t, "brand", "p_brand")])
    return pct_of_total(by_brand, "sales", ["year"]).withColumn("sales", F.col("sales").cast("double"))


@query(f"""WITH {SALES_SQL}
SELECT segment, CAST(SUM(amount) FILTER (category IN ('ECONOMY', 'PROMO') AND category IN ('ECONOMY', 'STANDARD')) AS DOUBLE) AS kept,
 CAST(SUM(amount) FILTER (category IN ('ECONOMY', 'STANDARD')) AS DOUBLE) AS replaced,
 CAST((SELECT SUM(amount) FROM sales) AS DOUBLE) AS everything FROM sales GROUP BY 1""")
def agg_filter_modifiers(t: Tables) -> DataFrame:
    # The outer filter lists two categories. Keeping filters intersects with it, a plain filter replaces it,
    # and removing all filters takes the total over every row.
    outer = F.col("category").isin("ECONOMY", "PROMO")
    inner = F.col("category").isin("ECONOMY", "STANDARD")
    customers = t.orders.select(F.col("o_orderkey").alias("_order"), F.col("o_custkey").alias("customer"))
    segments = customers.join(_segment(t).lookup, F.col("customer") == F.col("c_custkey"), "left").select("_order", "segment")
    by_both = sum_through(
        t.lineitem, {"amount": _amount()},
        [Step("l_orderkey", segments, "_order", ("segment",), how="inner"), _part(t, "category", "p_type")],
    )
    by_segment = by_both.groupBy("segment").agg(
        F.sum(F.when(outer & inner, F.col("amount"))).alias("kept"),
        F.sum(F.when(inner, F.col("amount"))).alias("replaced"),
        F.sum("amount").alias("_all"),
    )
    total = F.sum("_all").over(Window.partitionBy())  # one row for each segment
    return by_segment.select(
        "segment", F.col("kept").cast("double").alias("kept"), F.col("replaced").cast("double").alias("replaced"),
        total.cast("double").alias("everything"),
    )


@query(f"""WITH {SALES_SQL}, g AS (SELECT year, quarter, SUM(amount) AS s FROM sales GROUP BY 1, 2)
SELECT a.year, a.quarter, CAST(a.s AS DOUBLE) AS sales, CAST(b.s AS DOUBLE) AS previous_year, CAST(a.s - b.s AS DOUBLE) AS yoy_change,
 round(CAST(a.s - b.s AS DOUBLE) / CAST(b.s AS DOUBLE), 6) AS yoy_pct
FROM g a LEFT JOIN g b ON a.year = b.year + 1 AND a.quarter = b.quarter""")
def agg_yoy(t: Tables) -> DataFrame:
    by_quarter = sum_through(t.lineitem, {"sales": _amount()}, [_orders(t, "year", "quarter")])
    compared = year_over_year(by_quarter, "sales", "year", ["quarter"])
    return compared.select(
        "year", "quarter", *[F.col(c).cast("double").alias(c) for c in ("sales", "previous_year", "yoy_change")], "yoy_pct"
    )


@query(f"""WITH {SALES_SQL} SELECT year, category, CAST(SUM(amount) AS DOUBLE) AS sales, COUNT(DISTINCT o_orderkey) AS orders
FROM sales GROUP BY 1, 2""")
def agg_summarize_cols(t: Tables) -> DataFrame:
    # One row for each order and category, so counting rows counts orders.
    per_order = sum_through(t.lineitem, {"sales": _amount()}, [_part(t, "category", "p_type")], by=("l_orderkey",))
    per_order = per_order.withColumn("orders", F.lit(1).cast("long"))
    grouped = sum_through(per_order, {"sales": F.col("sales"), "orders": F.col("orders")}, [_orders(t, "year")], by=("category",))
    return grouped.select("year", "category", F.col("sales").cast("double").alias("sales"), "orders").orderBy("year", F.desc("sales"))


@query(f"""WITH {SALES_SQL} SELECT segment, CAST(SUM(amount) AS DOUBLE) / COUNT(DISTINCT o_custkey) AS sales_per_customer
FROM sales GROUP BY 1""")
def agg_ratio_measure(t: Tables) -> DataFrame:
    per_customer = sum_through(t.lineitem, {"sales": _amount()}, [_orders(t, "customer")])
    counted = F.when(F.col("customer").isNotNull(), 1).cast("long")
    by_segment = sum_through(per_customer, {"sales": F.col("sales"), "customers": counted}, [_segment(t)])
    return by_segment.select("segment", safe_ratio(F.col("sales"), F.col("customers")).alias("sales_per_customer"))


@query("""SELECT COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS distinct_entities,
 COUNT(*) FILTER (event_type = 'purchase') AS key_event_count,
 round(COUNT(*) FILTER (event_type = 'purchase') / CAST(COUNT(*) AS DOUBLE), 6) AS event_rate,
 round(COUNT(*) FILTER (event_type = 'purchase') / CAST(COUNT(DISTINCT user_id) AS DOUBLE), 6) AS key_events_per_entity,
 CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS domain_metric FROM events""")
def agg_kpis(t: Tables) -> DataFrame:
    return kpis(flat(t), "user_id", "event_type", "purchase", F.col("amount"))


@query(with_flat("SELECT source, COUNT(*) AS event_count FROM flat GROUP BY 1"))
def agg_kpis_by_source(t: Tables) -> DataFrame:
    return flat(t).groupBy("source").agg(F.count("*").alias("event_count"))


@query(with_flat("SELECT event_date, COUNT(*) AS event_count FROM flat GROUP BY 1"))
def agg_kpis_over_time(t: Tables) -> DataFrame:
    return flat(t).groupBy("event_date").agg(F.count("*").alias("event_count"))


@query("""WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT event_id, event_type, round((value - m) / sd, 4) AS z, abs((value - m) / sd) > 3 AS is_outlier
FROM events JOIN s USING (event_type)""")
def agg_zscore(t: Tables) -> DataFrame:
    scored = z_scores(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])
    return scored.select("event_id", "event_type", F.round("z", 4).alias("z"), "is_outlier")


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 5) AS r FROM lineitem GROUP BY 1")
def agg_correlation(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 5).alias("r"))


@query("""WITH s1 AS (SELECT user_id, min(ts) AS reached FROM events WHERE event_type = 'signup' GROUP BY 1),
s2 AS (SELECT e.user_id, min(ts) AS reached FROM events e JOIN s1 ON e.user_id = s1.user_id AND ts >= reached WHERE event_type = 'view' GROUP BY 1),
s3 AS (SELECT e.user_id, min(ts) AS reached FROM events e JOIN s2 ON e.user_id = s2.user_id AND ts >= reached WHERE event_type = 'purchase' GROUP BY 1),
c AS (SELECT 1 AS step_no, 'signup' AS step, count(*) AS users FROM s1 UNION ALL SELECT 2, 'view', count(*) FROM s2
 UNION ALL SELECT 3, 'purchase', count(*) FROM s3)
SELECT step_no, step, users, round(users / CAST(lag(users) OVER (ORDER BY step_no) AS DOUBLE), 6) AS conversion FROM c""")
def agg_funnel(t: Tables) -> DataFrame:
    return funnel(t.events, ["signup", "view", "purchase"], "user_id", "event_type", "ts")


@query("""WITH a AS (SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) AS w FROM events),
f AS (SELECT user_id, min(w) AS cohort FROM a GROUP BY 1)
SELECT cohort, date_diff('day', cohort, w) // 7 AS period_offset, count(*) AS active_users
FROM a JOIN f USING (user_id) GROUP BY 1, 2""")
def agg_cohort_retention(t: Tables) -> DataFrame:
    return retention(t.events, "user_id", "ts")


@query("""WITH c AS (SELECT w.source, count(d.doc_id) AS event_count FROM (VALUES ('src1'), ('src5'), ('src7')) w(source)
 LEFT JOIN documents d ON d.source = w.source GROUP BY 1)
SELECT source, event_count, CAST(SUM(event_count) OVER () AS BIGINT) AS total_events, 3 AS source_count FROM c""")
def agg_source_params(t: Tables) -> DataFrame:
    return count_sources(t.documents, ["src5", "src1", "src7", "src1"], {f"src{i}" for i in range(20)})


@query("""SELECT lang, count(*) AS attempts, count(*) FILTER (quality = 1) AS correct,
 CAST(floor(count(*) FILTER (quality = 1) * 100 / CAST(count(*) AS DOUBLE) + 0.5) AS BIGINT) AS pct
FROM labels JOIN documents USING (doc_id) GROUP BY 1""")
def agg_topic_mastery(t: Tables) -> DataFrame:
    answers = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    return mastery(answers, "lang", F.col("quality") == 1)


_PROGRESS = """SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS wrong,
 CAST(sum(CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 ELSE 3 END) AS BIGINT) AS confidence_total FROM events GROUP BY 1"""


@query(f"""SELECT user_id, attempts, wrong, confidence_total FROM ({_PROGRESS})
WHERE wrong > 0 OR confidence_total / greatest(attempts, 1) < 2.4 ORDER BY wrong DESC, user_id LIMIT 8""")
def agg_review_queue(t: Tables) -> DataFrame:
    confidence = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    progress = t.events.groupBy("user_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("event_type") == "error").alias("wrong"),
        F.sum(confidence).alias("confidence_total"),
    )
    return review_queue(progress, "user_id")
