"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import money
from eventloom.operators.checks import one_row
from eventloom.operators.joins import enrich, lookup_join, outer_join, star
from eventloom.operators.measures import Step, sum_through
from eventloom.plans.adapters import flat, users, with_flat
from eventloom.plans.registry import Tables, query


def _rich(t: Tables) -> DataFrame:
    """All customers; those in debt under another key, so that some orders find no customer and some customers no order."""
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).otherwise(F.col("c_custkey") + 1_000_000_000)
    return t.customer.select(key.alias("c_custkey"), "c_mktsegment")


def _large(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey")


_RICH = "(SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey ELSE c_custkey + 1000000000 END AS c_custkey, c_mktsegment FROM customer) c"
_LARGE = "(SELECT o_orderkey, o_custkey FROM orders) o"


@query(f"SELECT o_custkey AS custkey, o_orderkey, c_mktsegment FROM {_LARGE} JOIN {_RICH} ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    left = _large(t).withColumnRenamed("o_custkey", "custkey")
    return left.join(_rich(t).withColumnRenamed("c_custkey", "custkey"), "custkey", "inner")


# Both shapes of events beside users: those with an entry, and the others with a stand-in.
_PLACED = """placed AS (
 SELECT flat.*, plan, region FROM flat JOIN users USING (user_id)
 UNION ALL SELECT flat.*, 'unknown', 'unknown' FROM flat ANTI JOIN users USING (user_id))"""


@query(with_flat(f", {_PLACED}\nSELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM placed"))
def join_left_enrich(t: Tables) -> DataFrame:
    enriched = enrich(flat(t), users(t), "user_id", ["plan", "region"])
    return enriched.withColumn("amount", F.col("amount").cast("double"))


@query(with_flat(f""", {_PLACED}
SELECT plan, region, CAST(sum(n) AS BIGINT) AS purchase_count, CAST(sum(spent) AS DOUBLE) AS revenue
FROM (SELECT plan, region, count(amount) AS n, sum(amount) AS spent FROM placed WHERE event_type = 'purchase' GROUP BY ALL)
GROUP BY ALL"""))
def join_left_agg(t: Tables) -> DataFrame:
    # One row per user before the join: a user with very many purchases is one row in the shuffle.
    per_user = flat(t).where("event_type = 'purchase'").groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    by_group = enrich(per_user, users(t), "user_id", ["plan", "region"]).groupBy("plan", "region")
    totals = by_group.agg(F.sum("n").alias("purchase_count"), F.round(F.sum("amount"), 2).cast("double").alias("revenue"))
    return totals.orderBy(F.desc("revenue"), "plan", "region")


@query(f"SELECT o_orderkey, c_custkey, c_mktsegment FROM {_LARGE} RIGHT JOIN {_RICH} ON o_custkey = c_custkey")
def join_right(t: Tables) -> DataFrame:
    joined = outer_join(_large(t), _rich(t), "o_custkey", "c_custkey", "right")
    return joined.select("o_orderkey", "c_custkey", "c_mktsegment")


@query(f"SELECT o_orderkey, o_custkey, c_custkey, c_mktsegment FROM {_LARGE} FULL JOIN {_RICH} ON o_custkey = c_custkey")
def join_full(t: Tables) -> DataFrame:
    return outer_join(_large(t), _rich(t), "o_custkey", "c_custkey", "full")


@query(f"SELECT * FROM {_RICH} WHERE EXISTS (SELECT 1 FROM {_LARGE} WHERE o_custkey = c_custkey)")
def join_semi(t: Tables) -> DataFrame:
    # A customer with very many orders is one row on the right side.
    ordered = _large(t).select("o_custkey").distinct()
    return _rich(t).join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query(with_flat("""SELECT e.event_id, e.user_id, e.event_type, e.source FROM flat e
WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = e.user_id)"""))
def join_anti(t: Tables) -> DataFrame:
    lost = flat(t).join(users(t), "user_id", "left_anti")
    return lost.select("event_id", "user_id", "event_type", "source").orderBy("event_id")


@query("""SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate + INTERVAL 5 DAY""")
def join_expr(t: Tables) -> DataFrame:
    soon = (F.col("l_orderkey") == F.col("o_orderkey")) & (
        F.col("l_shipdate") < F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS")
    )
    return t.lineitem.join(t.orders, soon).select("l_orderkey", "l_linenumber", "o_orderpriority")


@query("SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast(t: Tables) -> DataFrame:
    joined = lookup_join(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return joined.select("c_custkey", "c_name", "n_name")


@query("""SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN n_name END AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def map_side_lookup(t: Tables) -> DataFrame:
    # Suppliers in debt carry a code that no nation has.
    code = F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey"))
    suppliers = t.supplier.select("s_suppkey", code.alias("code"))
    return lookup_join(suppliers, t.nation, F.col("code") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("nation"))


@query("SELECT c_custkey AS key, c_mktsegment AS left_value, o_orderpriority AS right_value FROM customer JOIN orders ON c_custkey = o_custkey")
def pair_join(t: Tables) -> DataFrame:
    left = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("left_value"))
    right = t.orders.select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("right_value"))
    return left.join(right, "key")


@query("""SELECT CAST(sum(x) FILTER (side = 'l') AS DOUBLE) AS raw_amount, CAST(sum(x) FILTER (side = 'o') AS DOUBLE) AS modeled_amount
FROM (SELECT 'l' AS side, CAST(l_extendedprice AS DECIMAL(18,2)) AS x FROM lineitem UNION ALL SELECT 'o', CAST(o_totalprice AS DECIMAL(18,2)) FROM orders)
HAVING abs(sum(CASE side WHEN 'l' THEN x ELSE -x END)) > 0.01""")
def join_cross_theta(t: Tables) -> DataFrame:
    totals = one_row(
        raw_amount=(t.lineitem, F.sum(money(F.col("l_extendedprice")))),
        modeled_amount=(t.orders, F.sum(money(F.col("o_totalprice")))),
    )
    apart = totals.where(F.abs(F.col("raw_amount") - F.col("modeled_amount")) > 0.01)
    return apart.select(*[F.col(c).cast("double").alias(c) for c in apart.columns])


@query("""SELECT r_name AS region, p_brand, c_mktsegment, COUNT(*) AS n_lines,
 CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def join_star(t: Tables) -> DataFrame:
    # The two outer dimensions are flattened first; the lines are grouped by what is left of their keys at every step.
    segments = star(t.orders, [(t.customer, F.col("o_custkey") == F.col("c_custkey"))], ["o_orderkey", "c_mktsegment"])
    regions = star(
        t.supplier, [(t.nation, F.col("s_nationkey") == F.col("n_nationkey")), (t.region, F.col("n_regionkey") == F.col("r_regionkey"))],
        ["s_suppkey", F.col("r_name").alias("region")],
    )
    sums = sum_through(
        t.lineitem, {"n_lines": F.lit(1).cast("long"), "sales": money(F.col("l_extendedprice"))},
        [
            Step("l_orderkey", segments, "o_orderkey", ("c_mktsegment",)), Step("l_partkey", t.part, "p_partkey", ("p_brand",)),
            Step("l_suppkey", regions, "s_suppkey", ("region",)),
        ],
    )
    return sums.withColumn("sales", F.col("sales").cast("double"))


@query("""SELECT d.year, count(*) FILTER (role = 'ordered') AS ordered_lines, count(*) FILTER (role = 'shipped') AS shipped_lines
FROM (SELECT year(o_orderdate) AS year, 'ordered' AS role FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 UNION ALL SELECT year(l_shipdate), 'shipped' FROM lineitem) d GROUP BY 1""")
def join_role_date(t: Tables) -> DataFrame:
    # One calendar in two roles. Each role is reduced to rows per day before it meets the calendar.
    from eventloom.warehouse.gold import dim_date

    span = t.orders.select(F.col("o_orderdate").alias("d")).union(t.lineitem.select("l_shipdate"))
    calendar = dim_date(span, "d").select("date", "year")
    ordered = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.to_date("o_orderdate").alias("date")
    ).agg(F.count("*").alias("n"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").alias("n"))
    roles = ordered.withColumn("role", F.lit("ordered")).unionByName(shipped.withColumn("role", F.lit("shipped")))
    return calendar.join(roles, "date").groupBy("year").agg(
        *[F.coalesce(F.sum(F.when(F.col("role") == r, F.col("n"))), F.lit(0)).alias(f"{r}_lines") for r in ("ordered", "shipped")]
    )


@query(with_flat("""SELECT e.event_id, e.user_id, e.event_type, u.plan, u.region FROM flat e LEFT JOIN users u ON e.user_id = u.user_id"""))
def join_intermediate(t: Tables) -> DataFrame:
    events = flat(t).select("event_id", "user_id", "event_type")
    return events.join(users(t), "user_id", "left")
