"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.joins import except_all, intersect, subtract, subtract_keep_copies
from eventloom.plans.adapters import flat, users, with_flat
from eventloom.plans.registry import Tables, query

_HIGH = "(SELECT o_custkey + CASE WHEN o_totalprice > 200000 THEN 0 ELSE 1000000000 END AS o_custkey, o_orderpriority FROM orders)"
_DONE = "(SELECT o_custkey + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1000000000 END AS o_custkey, o_orderpriority FROM orders)"


def _high(t: Tables) -> DataFrame:
    """All orders; the small ones under another customer, so that the two sides differ."""
    return t.orders.select(F.expr("o_custkey + IF(o_totalprice > 200000, 0, 1000000000)").alias("o_custkey"), "o_orderpriority")


def _done(t: Tables) -> DataFrame:
    """All orders; the open ones under another customer."""
    return t.orders.select(F.expr("o_custkey + IF(o_orderstatus = 'F', 0, 1000000000)").alias("o_custkey"), "o_orderpriority")


@query(f"SELECT * FROM {_HIGH} UNION ALL SELECT * FROM {_DONE}")
def set_union_all(t: Tables) -> DataFrame:
    return _high(t).union(_done(t))


@query(f"SELECT * FROM {_HIGH} UNION SELECT * FROM {_DONE}")
def set_union_distinct(t: Tables) -> DataFrame:
    return _high(t).union(_done(t)).distinct()


@query(f"""SELECT o_custkey, o_orderpriority, NULL AS o_totalprice FROM {_HIGH}
UNION ALL SELECT o_custkey, o_orderpriority, o_totalprice FROM orders""")
def set_union_by_name(t: Tables) -> DataFrame:
    other = t.orders.select("o_totalprice", "o_orderpriority", "o_custkey")
    return _high(t).unionByName(other, allowMissingColumns=True)


@query(f"SELECT * FROM {_HIGH} INTERSECT SELECT * FROM {_DONE}")
def set_intersect(t: Tables) -> DataFrame:
    return intersect(_high(t), _done(t))


@query(f"SELECT * FROM {_HIGH} EXCEPT ALL SELECT * FROM {_DONE}")
def set_except_all(t: Tables) -> DataFrame:
    return except_all(_high(t), _done(t))


@query(with_flat("SELECT user_id FROM flat WHERE event_type = 'purchase' EXCEPT SELECT user_id FROM users WHERE plan = 'BUILDING'"))
def set_except_distinct(t: Tables) -> DataFrame:
    purchasers = flat(t).where("event_type = 'purchase'").select("user_id")
    return subtract(purchasers, users(t).where("plan = 'BUILDING'").select("user_id"))


@query("""SELECT c_nationkey AS nation, c_acctbal AS balance, 'customer' AS kind FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, 'supplier' FROM supplier""")
def set_append(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return customers.withColumn("kind", F.lit("customer")).unionByName(suppliers.withColumn("kind", F.lit("supplier")))


@query(f"""SELECT * FROM {_HIGH} h WHERE NOT EXISTS (SELECT 1 FROM {_DONE} d
 WHERE d.o_custkey IS NOT DISTINCT FROM h.o_custkey AND d.o_orderpriority IS NOT DISTINCT FROM h.o_orderpriority)""")
def rdd_subtract(t: Tables) -> DataFrame:
    return subtract_keep_copies(_high(t), _done(t))
