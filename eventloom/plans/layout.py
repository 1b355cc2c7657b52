"""Order, limits and physical layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.plans.adapters import flat, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.session import cut_lineage
from eventloom.sinks.files import write_bucketed, write_partitioned
from eventloom.sinks.tables import TableScope, bucket_count


def _tasks(t: Tables) -> int:
    """Twice the tasks that the session gives a shuffle."""
    return 2 * int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sort_multi(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rows.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")


@query("SELECT user_id AS key, event_id AS value FROM events")
def sort_by_key(t: Tables) -> DataFrame:
    # The value follows the key in the order, so one heavy key does not end in one task.
    return t.events.select(F.col("user_id").alias("key"), F.col("event_id").alias("value")).orderBy("key", "value")


@query("SELECT monthname(o_orderdate) AS month_name, COUNT(*) AS n FROM orders GROUP BY 1")
def sort_month_name(t: Tables) -> DataFrame:
    by_month = t.orders.groupBy(F.month("o_orderdate").alias("m"), F.date_format("o_orderdate", "MMMM").alias("month_name"))
    return by_month.agg(F.count("*").alias("n")).orderBy("m").drop("m")


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 5")
def take_first(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").orderBy("ts", "event_id").limit(5)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def repartition(t: Tables) -> DataFrame:
    return t.events.repartition(_tasks(t)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def coalesce(t: Tables) -> DataFrame:
    return t.events.repartition(_tasks(t)).coalesce(max(1, _tasks(t) // 4)).groupBy("event_type").agg(F.count("*").alias("n"))


@query(with_flat("SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT event_date) AS n_days FROM flat GROUP BY 1"))
def cache_reuse(t: Tables) -> DataFrame:
    days = flat(t).select("event_type", "event_date").persist()
    counts = days.groupBy("event_type").agg(F.count("*").alias("n"))
    distinct_days = days.groupBy("event_type").agg(F.count_distinct("event_date").alias("n_days"))
    try:
        return cut_lineage(counts.join(distinct_days, "event_type"))
    finally:
        days.unpersist()


@query(with_flat("""SELECT event_id, event_type, user_id, event_date FROM flat
WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""))
def partition_prune(t: Tables) -> DataFrame:
    path = t.scratch("by-date")
    write_partitioned(flat(t).select("event_id", "event_type", "user_id", "event_date"), path)
    return t.spark.read.parquet(path).where("event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")


def bucketed_join(t: Tables, scope: TableScope) -> DataFrame:
    """Lines per priority from two bucketed tables of the scope."""
    orders, lines = t.orders.select("o_orderkey", "o_orderpriority"), t.lineitem.select("l_orderkey")
    buckets, names = bucket_count(orders, lines), []
    for rows, kind, key in ((orders, "orders", "o_orderkey"), (lines, "lines", "l_orderkey")):
        name, path = scope.table(kind)
        write_bucketed(rows, name, key, buckets, path=path)
        names.append(name)
    joined = t.spark.table(names[0]).join(t.spark.table(names[1]), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n_lines"))


@query("""SELECT o_orderpriority, COUNT(*) AS n_lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def sink_bucketed(t: Tables) -> DataFrame:
    with TableScope(t.spark) as scope:
        return scope.keep(bucketed_join(t, scope))
