"""Bronze, silver and gold tables, history, marts and governance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import checks
from eventloom.plans.adapters import FEED_SQL, flat, feed, users, with_feed, with_flat
from eventloom.plans.registry import Tables, query
from eventloom.plans.windows import _HISTORY, priority_history
from eventloom.session import cut_lineage
from eventloom.sources.files import load_history as history_of_loads
from eventloom.streaming import ingest
from eventloom.warehouse import bronze, changes, gold, governance, silver


def raw_lines(t: Tables) -> DataFrame:
    """The feed as JSON lines of the project shape, with a batch file per day and a load time per line."""
    body = F.struct(
        "event_id", F.concat(F.lit(" "), F.upper("event_type")).alias("event_type"), F.col("user_id").alias("entity_id"),
        "event_ts", "source",
        F.when(~F.col("no_payload"), F.struct(F.col("amount").try_cast("decimal(12,2)").alias("amount"), "k")).alias("payload"),
    )
    loaded = (F.lit("2024-02-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod("line_no", F.lit(1000)))).alias("loaded_at")
    return feed(t).select(
        "line_no", F.to_json(body).alias("value"), F.concat(F.lit("batch-"), F.pmod("base_id", F.lit(10))).alias("source_file"), loaded
    )


def bronze_rows(t: Tables) -> DataFrame:
    return bronze.load_bronze(raw_lines(t), "events", "run_001", loaded_at=F.col("loaded_at"))


_BRONZE = f"""{FEED_SQL}, bronze AS (SELECT *, 'batch-' || base_id % 10 AS source_file,
 TIMESTAMP '2024-02-01' + to_seconds(line_no % 1000) AS loaded_at FROM feed),
judged AS (SELECT *, CASE WHEN trim(event_id, ' ') = '' THEN 'missing event_id' WHEN true_time IS NULL THEN 'invalid event_ts'
 WHEN no_payload THEN 'missing payload' END AS reject_reason FROM bronze),
silver AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY loaded_at DESC, true_time DESC) AS r
 FROM judged WHERE reject_reason IS NULL) WHERE r = 1)"""


def _with(sql: str) -> str:
    return f"WITH {_BRONZE}\n{sql}"


@query(_with("""SELECT source_file, 'events' AS stream_topic, CASE WHEN base_id % 10 < 5 THEN 'run_001' ELSE 'run_003' END AS ingest_run_id,
 line_no % 131 = 0 AS malformed, CASE WHEN line_no % 131 <> 0 THEN event_id END AS event_id, CASE WHEN line_no % 131 <> 0 THEN source END AS source
FROM bronze"""))
def bronze_load(t: Tables) -> DataFrame:
    # Half of the files arrive; the load is run twice; the others arrive and it runs again. Some lines are cut short.
    landing, paths = t.scratch("bronze-landing"), ingest.Paths(t.scratch("bronze"))
    cut = F.when(F.pmod("line_no", F.lit(131)) == 0, F.left("value", F.lit(20))).otherwise(F.col("value")).alias("value")
    lines = raw_lines(t).select(F.col("source_file").alias("file"), cut)
    first = F.substring("file", 7, 2).cast("int") < 5
    lines.where(first).write.partitionBy("file").text(f"{landing}/first")
    for run in ("run_001", "run_002"):
        bronze.append_bronze(t.spark, landing, paths, "events", run)
    lines.where(~first).write.partitionBy("file").text(f"{landing}/second")
    bronze.append_bronze(t.spark, landing, paths, "events", "run_003")
    rows = t.spark.read.parquet(paths.rows)
    return rows.select(
        F.regexp_extract("source_file", "file=([^/]+)/", 1).alias("source_file"), "stream_topic", "ingest_run_id",
        F.col("raw_payload").isNull().alias("malformed"), F.try_variant_get("raw_payload", "$.event_id", "string").alias("event_id"),
        F.try_variant_get("raw_payload", "$.source", "string").alias("source"),
    )


@query(_with("SELECT source_file, loaded_at, count(*) AS row_count FROM bronze WHERE loaded_at >= TIMESTAMP '2024-02-01 00:10:00' GROUP BY 1, 2"))
def load_history(t: Tables) -> DataFrame:
    since = F.lit("2024-02-01 00:10:00").cast("timestamp_ntz")
    return history_of_loads(bronze_rows(t), since)


@query(_with("""SELECT event_id, event_type, user_id AS entity_id, true_time AS event_ts, CAST(true_time AS DATE) AS event_date, source,
 CAST(try_cast(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, loaded_at FROM bronze"""))
def silver_typed(t: Tables) -> DataFrame:
    amount = F.try_variant_get("payload", "$.amount", "decimal(12,2)").cast("double").alias("amount")
    typed = silver.typed(bronze_rows(t))
    return typed.select(
        "event_id", "event_type", "entity_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "event_date",
        "source", amount, "loaded_at",
    )


@query(_with("SELECT event_id, event_type, user_id AS entity_id, loaded_at FROM silver"))
def silver_dedup(t: Tables) -> DataFrame:
    return silver.build_silver(bronze_rows(t)).events.select("event_id", "event_type", "entity_id", "loaded_at")


@query(_with("SELECT event_id, reject_reason, loaded_at, source_file FROM judged WHERE reject_reason IS NOT NULL"))
def silver_rejected(t: Tables) -> DataFrame:
    return silver.build_silver(bronze_rows(t)).rejected.select("event_id", "reject_reason", "loaded_at", "source_file")


@query(_with("""SELECT *, bronze - silver - rejected - duplicates AS unexplained, bronze = silver + rejected + duplicates AS passed
FROM (SELECT (SELECT count(*) FROM bronze) AS bronze, (SELECT count(*) FROM silver) AS silver,
 (SELECT count(*) FROM judged WHERE reject_reason IS NOT NULL) AS rejected,
 (SELECT count(*) - count(DISTINCT event_id) FROM judged WHERE reject_reason IS NULL) AS duplicates)"""))
def dq_reconcile_layers(t: Tables) -> DataFrame:
    # Stored once, since four counts read the rows.
    rows = cut_lineage(bronze_rows(t))
    built = silver.build_silver(rows)
    repeats = F.count("*") - F.count_distinct("event_id")
    n = F.count("*")
    counts = checks.one_row(
        bronze=(rows, n), silver=(built.events, n), rejected=(built.rejected, n), duplicates=(built.valid, repeats)
    )
    rest = F.col("bronze") - F.col("silver") - F.col("rejected") - F.col("duplicates")
    return counts.withColumn("unexplained", rest).withColumn("passed", rest == 0)


# Updates for a third of the customers, two per customer, and some new customers.
_UPDATES = """updates AS (
 SELECT c_custkey, 'VIP' AS c_mktsegment, c_acctbal + 1 AS c_acctbal, 1 AS seq FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT c_custkey, 'GOLD', c_acctbal + 2, 2 FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT c_custkey + 1000000000, 'NEW', 0.0, 1 FROM customer WHERE c_custkey % 5 = 0)"""


def _customer_updates(t: Tables) -> DataFrame:
    base = t.customer
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    first = base.where(key % 3 == 0).select(key, F.lit("VIP").alias("c_mktsegment"), (balance + 1).alias("c_acctbal"), F.lit(1).alias("seq"))
    second = base.where(key % 3 == 0).select(key, F.lit("GOLD").alias("c_mktsegment"), (balance + 2).alias("c_acctbal"), F.lit(2).alias("seq"))
    new = base.where(key % 5 == 0).select((key + 1000000000).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"), F.lit(0.0).alias("c_acctbal"), F.lit(1).alias("seq"))
    return first.unionByName(second).unionByName(new)


def _customer_state(t: Tables) -> DataFrame:
    """Customers now; the one with key 7 has lost its key."""
    key = F.when(F.col("c_custkey") != 7, F.col("c_custkey"))
    return t.customer.select(key.alias("c_custkey"), "c_mktsegment", "c_acctbal")


_BEFORE = "before AS (SELECT CASE WHEN c_custkey <> 7 THEN c_custkey END AS c_custkey, c_mktsegment, c_acctbal FROM customer)"


@query(f"""WITH {_BEFORE}, {_UPDATES}, newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS r FROM updates) WHERE r = 1)
SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
 coalesce(n.c_acctbal, c.c_acctbal) AS c_acctbal FROM before c FULL JOIN newest n ON c.c_custkey IS NOT DISTINCT FROM n.c_custkey""")
def merge_upsert(t: Tables) -> DataFrame:
    return changes.merge_upsert(_customer_state(t), _customer_updates(t), "c_custkey", order=["seq"])


def _snapshot_after(t: Tables) -> DataFrame:
    """Customers later on: some gone, some in another segment, some new."""
    key = F.col("c_custkey")
    kept = _customer_state(t).where(key.isNull() | (key % 11 != 0))
    moved = kept.withColumn("c_mktsegment", F.when(key.isNull() | (key % 7 == 0), "MOVED").otherwise(F.col("c_mktsegment")))
    new = _customer_state(t).where(key % 13 == 0).withColumn("c_custkey", key + 1000000000)
    return moved.unionByName(new)


_AFTER = f"""{_BEFORE}, after AS (SELECT c_custkey, CASE WHEN c_custkey IS NULL OR c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c_acctbal
 FROM before WHERE c_custkey IS NULL OR c_custkey % 11 <> 0
 UNION ALL SELECT c_custkey + 1000000000, c_mktsegment, c_acctbal FROM before WHERE c_custkey % 13 = 0)"""
_DELTA = """SELECT *, 'DELETE' AS action, EXISTS (SELECT 1 FROM after a WHERE a.c_custkey IS NOT DISTINCT FROM x.c_custkey) AS is_update
FROM (SELECT * FROM before EXCEPT SELECT * FROM after) x
UNION ALL SELECT *, 'INSERT', EXISTS (SELECT 1 FROM before b WHERE b.c_custkey IS NOT DISTINCT FROM y.c_custkey)
FROM (SELECT * FROM after EXCEPT SELECT * FROM before) y"""


@query(f"WITH {_AFTER} {_DELTA}")
def cdc_changes(t: Tables) -> DataFrame:
    return changes.change_delta(_customer_state(t), _snapshot_after(t), "c_custkey")


@query(f"WITH {_AFTER} SELECT * FROM after UNION ALL SELECT * FROM before b WHERE NOT EXISTS (SELECT 1 FROM after a WHERE a.c_custkey IS NOT DISTINCT FROM b.c_custkey)")
def cdc_merge_task(t: Tables) -> DataFrame:
    delta = cut_lineage(changes.change_delta(_customer_state(t), _snapshot_after(t), "c_custkey"))
    if delta.isEmpty():
        return _customer_state(t)
    return changes.apply_delta(_customer_state(t), delta, "c_custkey")


@query(with_flat("SELECT event_date, event_type, source, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users FROM flat GROUP BY 1, 2, 3"))
def incremental_model(t: Tables) -> DataFrame:
    # Files of the events before the high-water mark arrive and are built, then those of what came after it. The second
    # run reads the new files and the older ones that share a day with them.
    mark = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    source, path, manifest = t.scratch("flat-events"), t.scratch("daily-mart"), t.scratch("file-days")
    events = flat(t).drop("event_date")
    for part in (F.col("event_time") < mark, F.col("event_time") >= mark):
        events.where(part).write.mode("append").parquet(source)
        changes.rebuild_from_files(t.spark, source, lambda rows: gold.daily_mart(rows, "event_time"), path, manifest, F.to_date("event_time"))
    mart = t.spark.read.parquet(path)
    return mart.select("event_date", "event_type", "source", "event_count", "unique_users")


@query(f"""WITH {_HISTORY}, cur AS (SELECT o_custkey, priority, valid_from, valid_to, valid_to IS NULL AS is_current FROM history),
inc AS (SELECT c_custkey AS o_custkey, CASE WHEN c_custkey % 2 = 0 THEN '9-NEW' ELSE '1-URGENT' END AS priority FROM customer),
j AS (SELECT c.o_custkey AS ck, c.priority AS cp, c.valid_from, i.o_custkey AS ik, i.priority AS ip,
 i.o_custkey IS NOT NULL AND (c.o_custkey IS NULL OR c.priority <> i.priority) AS changed
 FROM (SELECT * FROM cur WHERE is_current) c FULL JOIN inc i ON c.o_custkey = i.o_custkey)
SELECT * FROM cur WHERE NOT is_current
UNION ALL SELECT ck, cp, valid_from, CASE WHEN changed THEN TIMESTAMP '2002-01-01' END, NOT changed FROM j WHERE ck IS NOT NULL
UNION ALL SELECT ik, ip, TIMESTAMP '2002-01-01', NULL, TRUE FROM j WHERE changed""")
def scd2_snapshot(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    incoming = t.customer.select(key.alias("o_custkey"), F.when(key % 2 == 0, "9-NEW").otherwise("1-URGENT").alias("priority"))
    at = F.lit("2002-01-01").cast("timestamp_ntz")
    return changes.snapshot_increment(priority_history(t), incoming, "o_custkey", ["priority"], at)


@query("""SELECT CAST(d AS DATE) AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
 weekofyear(d) AS week, isodow(d) AS day_of_week, isodow(d) >= 6 AS is_weekend, year(d + INTERVAL 6 MONTH) AS fiscal_year,
 quarter(d + INTERVAL 6 MONTH) AS fiscal_quarter
FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""")
def dim_date(t: Tables) -> DataFrame:
    return gold.dim_date(t.orders, "o_orderdate")


_CATEGORIES = "(VALUES ('page_view', 'engagement'), ('video_play', 'engagement'), ('add_to_cart', 'commerce'), ('purchase', 'commerce')) m(event_type, event_category)"


@query(with_flat(f"SELECT DISTINCT f.event_type, coalesce(event_category, 'other') AS event_category FROM flat f LEFT JOIN {_CATEGORIES} USING (event_type)"))
def dim_event_type(t: Tables) -> DataFrame:
    return gold.dim_event_type(flat(t), gold.event_categories(t.spark))


@query(with_flat("SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen, count(*) AS event_count FROM flat GROUP BY 1"))
def dim_entity(t: Tables) -> DataFrame:
    return gold.dim_entity(flat(t), "user_id", "event_time")


@query(_with("SELECT md5(event_id) AS event_key, event_id, user_id AS entity_id, event_type, CAST(true_time AS DATE) AS event_date, true_time AS event_ts, source, 'run_001' AS ingest_run_id FROM silver"))
def fact_events(t: Tables) -> DataFrame:
    return gold.fact_events(silver.build_silver(bronze_rows(t)).events)


@query(_with("""SELECT event_id, user_id AS entity_id, CAST(true_time AS DATE) AS event_date,
 CAST(try_cast(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, k FROM silver WHERE event_type = 'purchase'"""))
def fact_domain(t: Tables) -> DataFrame:
    built = silver.build_silver(bronze_rows(t)).events
    facts = gold.fact_domain(built, "purchase", {"amount": ("$.amount", "decimal(12,2)"), "k": ("$.k", "string")})
    return facts.withColumn("amount", F.col("amount").cast("double"))


@query(with_flat("SELECT event_date, event_type, source, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users FROM flat GROUP BY 1, 2, 3"))
def mart_daily(t: Tables) -> DataFrame:
    return gold.daily_mart(flat(t), "event_time")


@query(with_feed("SELECT 1").replace("\nSELECT 1", """, u AS (SELECT 'user_' || c_custkey AS user_id, c_mktsegment FROM customer WHERE c_acctbal >= 0)
SELECT CAST(true_time AS DATE) AS event_date, event_type, coalesce(c_mktsegment, 'unknown') AS plan, count(*) AS event_count,
 count(DISTINCT f.user_id) AS unique_users, CAST(SUM(try_cast(amount AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM feed f LEFT JOIN u ON f.user_id = u.user_id WHERE event_id <> '' AND true_time IS NOT NULL GROUP BY 1, 2, 3"""))
def model_chain(t: Tables) -> DataFrame:
    """Source, staging, intermediate and mart as functions of the step before."""

    def staging() -> DataFrame:
        payload = F.parse_json(F.to_json(F.struct(F.col("amount").try_cast("decimal(12,2)").alias("amount"))))
        time = F.try_to_timestamp("event_ts").cast("timestamp_ntz")
        raw = feed(t).where("event_id <> ''").select(
            "event_id", "event_type", "user_id", time.alias("event_ts"), "source", payload.alias("payload"), time.alias("ingested_at")
        )
        return silver.staging_events(raw)

    def intermediate(events: DataFrame) -> DataFrame:
        plans = users(t).select(F.concat(F.lit("user_"), "user_id").alias("user_id"), "plan")
        return events.join(plans, "user_id", "left").withColumn("plan", F.coalesce("plan", F.lit("unknown")))

    def mart(enriched: DataFrame) -> DataFrame:
        day = F.to_date("event_at").alias("event_date")
        return enriched.where(F.col("event_at").isNotNull()).groupBy(day, "event_type", "plan").agg(
            F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"),
            F.sum("purchase_amount").cast("double").alias("revenue"),
        )

    return mart(intermediate(staging()))


_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9][0-9 ().-]{7,}[0-9]",
    "government_id": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}


@query(" UNION ALL ".join(
    f"SELECT '{column}' AS \"column\", '{kind}' AS kind, count(*) FILTER (regexp_matches({column}, '{pattern}')) AS matches,"
    f" count(*) FILTER (regexp_matches({column}, '{pattern}')) > 0 AS is_pii FROM documents"
    for column in ("text", "source") for kind, pattern in _PII.items()
))
def pii_scan(t: Tables) -> DataFrame:
    return governance.pii_scan(t.documents, ["text", "source"])


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY THEN 'keep' ELSE 'delete' END AS fate FROM events""")
def retention_filter(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    keep = governance.retained(t.events, "ts", as_of, "14 DAYS").select("event_id", F.lit("keep").alias("fate"))
    drop = governance.expired(t.events, "ts", as_of, "14 DAYS").select("event_id", F.lit("delete").alias("fate"))
    return keep.union(drop)


@query(r"""SELECT c_custkey, regexp_replace(lower(c_name) || '@' || lower(c_mktsegment) || '.example', '^[^@]*', '***') AS email FROM customer""")
def mask_policy(t: Tables) -> DataFrame:
    email = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    return governance.masked_view(t.customer.select("c_custkey", email.alias("email")), "email")


@query("""SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
 WHERE r_name IN ('ASIA', 'EUROPE'))""")
def row_policy(t: Tables) -> DataFrame:
    # Entitlements derive from the region table: each region's analysts see its nations.
    entitled = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("r_name").isin("ASIA", "EUROPE"), "analyst_east").otherwise("analyst_west").alias("role")
    )
    return governance.visible_rows(t.customer.select("c_custkey", "c_nationkey"), entitled, "analyst_east", "c_nationkey")
