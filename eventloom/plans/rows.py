"""Projections, filters and column operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import money
from eventloom.functions.text import words
from eventloom.operators.rows import computed_once, hash_sample, seeded_pick
from eventloom.operators.skew import broadcast_if_small
from eventloom.plans.adapters import feed, flat, with_feed, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.session import cut_lineage


@query("SELECT c_custkey, c_name FROM customer")
def select_cols(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name")


@query("SELECT c_custkey AS customer_id, c_mktsegment AS plan FROM customer")
def alias_col(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("plan"))


@query(with_flat("SELECT event_id, event_type, user_id, event_time, source FROM flat WHERE source = 'web' ORDER BY event_time"))
def filter_eq(t: Tables) -> DataFrame:
    # The id breaks ties, so that equal times can still be spread over tasks.
    web = flat(t).where("source = 'web'").select("event_id", "event_type", "user_id", "event_time", "source")
    return web.orderBy("event_time", "event_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45")
def filter_range(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice > 300000) OR NOT (o_orderpriority <> '1-URGENT')""")
def filter_compound(t: Tables) -> DataFrame:
    finished = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
    urgent = ~(F.col("o_orderpriority") != "1-URGENT")
    return t.orders.where(finished | urgent).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(with_feed("""SELECT line_no, event_id, source, user_id FROM feed
WHERE source IS NULL OR source NOT IN ('web', 'mobile', 'api', 'system') OR user_id IS NULL"""))
def filter_isin_null(t: Tables) -> DataFrame:
    source = F.col("source")
    bad = source.isNull() | ~source.isin("web", "mobile", "api", "system") | F.col("user_id").isNull()
    return feed(t).where(bad).select("line_no", "event_id", "source", "user_id")


@query("""SELECT CAST(o_orderdate AS DATE) AS sale_date, o_orderpriority, COUNT(*) AS order_count,
 CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31' GROUP BY ALL""")
def filter_between(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT CAST(o_orderdate AS DATE) AS sale_date, o_orderpriority, COUNT(*) AS order_count,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM {orders} WHERE o_orderdate BETWEEN CAST(:first AS TIMESTAMP_NTZ) AND CAST(:last AS TIMESTAMP_NTZ)
        GROUP BY ALL ORDER BY sale_date, o_orderpriority""",
        args={"first": "1996-01-01", "last": "1996-12-31"}, orders=t.orders,
    )


@query("""SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type""")
def filter_recent(t: Tables) -> DataFrame:
    newest = t.events.select(F.max("ts")).scalar()
    recent = t.events.where(F.col("ts") >= newest - F.expr("INTERVAL 7 DAYS"))
    return recent.groupBy("event_type").agg(
        F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users")
    ).orderBy(F.desc("event_count"), "event_type")


@query("SELECT c_custkey, c_acctbal > 0 AS in_credit, 'tpch' AS origin FROM customer")
def add_column(t: Tables) -> DataFrame:
    added = t.customer.withColumn("in_credit", F.col("c_acctbal") > 0).withColumn("origin", F.lit("tpch"))
    return added.select("c_custkey", "in_credit", "origin")


@query("SELECT event_id, round(value / 100, 6) AS value FROM events")
def transform_column(t: Tables) -> DataFrame:
    return t.events.select("event_id", "value").withColumn("value", F.round(F.col("value") / 100, 6))


@query("SELECT s_suppkey AS supplier_id, s_name FROM supplier")
def rename_column(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", "s_name").withColumnRenamed("s_suppkey", "supplier_id")


@query("SELECT p_partkey, p_name, p_brand, p_type FROM part")
def drop_column(t: Tables) -> DataFrame:
    return t.part.drop("p_size", "p_retailprice")


@query("""SELECT CASE WHEN l_extendedprice < 20000 THEN 'small' WHEN l_extendedprice < 60000 THEN 'medium' ELSE 'large' END
 AS bucket, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def case_bucket(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    bucket = F.when(price < 20000, "small").when(price < 60000, "medium").otherwise("large")
    return t.lineitem.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id * 2 + 1 AS mapped FROM events")
def map_rows(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("user_id") * 2 + 1).alias("mapped"))


WORDS_SQL = r"""words AS (
 SELECT doc_id, source, unnest(list_filter(
  regexp_split_to_array(lower(text), '[\s\x0b\x1c-\x1f\x{85}\pZ]+'), lambda w: w <> '')) AS word FROM documents)"""


@query(f"""WITH {WORDS_SQL} SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct, sum(length(word)) AS n_letters
FROM words GROUP BY doc_id""")
def flat_map_words(t: Tables) -> DataFrame:
    # Words meet in the task that split the text; the different words of an id travel only if it has several texts.
    split = t.documents.select("doc_id", words(F.col("text")).alias("words"))
    sized = computed_once(split, {"_different": F.size(F.array_distinct("words"))})
    one_per_word = sized.select("doc_id", "_different", F.posexplode("words").alias("_place", "word"))
    counts = cut_lineage(one_per_word.groupBy("doc_id").agg(
        F.count("*").alias("n_words"), F.max("_different").cast("long").alias("n_distinct"),
        F.sum(F.length("word")).alias("n_letters"), F.count_if(F.col("_place") == 0).alias("_texts"),
    ))
    once, several = counts.where("_texts = 1").drop("_texts"), counts.where("_texts > 1").drop("n_distinct", "_texts")
    if several.isEmpty():
        return once
    ids = broadcast_if_small(several.select(F.col("doc_id").alias("_id")))
    again = split.join(ids, F.col("doc_id").eqNullSafe(F.col("_id"))).select("_id", F.explode(F.array_distinct("words")).alias("word"))
    different = again.groupBy("_id").agg(F.count_distinct("word").alias("n_distinct"))
    joined = several.join(different, F.col("doc_id").eqNullSafe(F.col("_id")))
    return once.unionByName(joined.select(once.columns))


@query("SELECT user_id AS key, CAST(CAST(value AS DECIMAL(18,2)) * 2 AS DOUBLE) AS value FROM events")
def map_values(t: Tables) -> DataFrame:
    pairs = t.events.select(F.col("user_id").alias("key"), "value")
    return pairs.withColumn("value", (money(F.col("value")) * 2).cast("double"))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT event_id, event_type FROM events WHERE left(md5('42:' || event_id), 15) < '199999999999999'")
def sample_rows(t: Tables) -> DataFrame:
    return hash_sample(t.events.select("event_id", "event_type"), "event_id", 0.1, seed=42)


@query("SELECT event_id, event_type FROM events ORDER BY md5('quiz-7:' || event_id), event_id LIMIT 20")
def seeded_sample(t: Tables) -> DataFrame:
    return seeded_pick(t.events.select("event_id", "event_type"), "event_id", 20, seed="quiz-7")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial'
 ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def replace_values(t: Tables) -> DataFrame:
    codes = {"F": "finished", "O": "open", "P": "partial"}
    return t.orders.select("o_orderkey", "o_orderstatus").replace(codes, subset=["o_orderstatus"])


@query("""SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number,
 concat_ws('/', c_mktsegment, split_part(c_name, '#', 2)) AS label FROM customer""")
def split_merge_cols(t: Tables) -> DataFrame:
    parts = F.split("c_name", "#")
    return t.customer.select(
        "c_custkey", parts[0].alias("kind"), parts[1].alias("number"), F.concat_ws("/", "c_mktsegment", parts[1]).alias("label")
    )


@query("""SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS net_amount FROM orders WHERE o_orderkey IS NOT NULL AND o_totalprice >= 0""")
def cast_select_filter(t: Tables) -> DataFrame:
    typed = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").try_cast("date").alias("order_date"),
        F.col("o_custkey").alias("customer_id"), money(F.col("o_totalprice")).alias("net_amount"),
    )
    valid = typed.where(F.col("order_id").isNotNull() & (F.col("net_amount") >= 0))
    return valid.withColumn("net_amount", F.col("net_amount").cast("double"))


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
 count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def pivot_rows(t: Tables) -> DataFrame:
    # Naming the values spares a pass over the data to find them.
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()


@query("""SELECT l_orderkey, l_linenumber, measure, amount FROM (
 SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
UNPIVOT (amount FOR measure IN (l_quantity, l_discount, l_tax))""")
def unpivot_cols(t: Tables) -> DataFrame:
    return t.lineitem.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount")
