"""Scalar, semi-structured and SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import numbers, privacy, sql_functions, text, times, variants
from eventloom.operators.quality import all_errors, field_rules
from eventloom.plans.adapters import feed, payload_events, with_feed
from eventloom.plans.registry import Tables, query
from eventloom.session import cut_lineage
from eventloom.warehouse.governance import tokenize


@query(with_feed("SELECT line_no, event_id IS NULL OR length(trim(event_id, ' ')) = 0 AS is_blank, length(user_id) AS user_length FROM feed"))
def fn_trim_length(t: Tables) -> DataFrame:
    return feed(t).select("line_no", text.is_blank(F.col("event_id")).alias("is_blank"), F.length("user_id").alias("user_length"))


@query("SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS plan FROM customer")
def fn_lower_trim(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    return t.customer.select("c_custkey", text.normalise_code(padded).alias("plan"))


@query("SELECT p_partkey, reverse(p_name) AS reversed FROM part")
def fn_reverse(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.reverse("p_name").alias("reversed"))


@query("""SELECT event_id, lower(replace(x, ' ', '')) = reverse(lower(replace(x, ' ', ''))) AS is_palindrome
FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id || ' Race car ' || reverse(CAST(event_id AS VARCHAR)) ELSE CAST(event_id AS VARCHAR) END AS x FROM events)""")
def fn_palindrome(t: Tables) -> DataFrame:
    number = F.col("event_id").cast("string")
    sample = F.when(F.col("event_id") % 2 == 0, F.concat(number, F.lit(" Race car "), F.reverse(number))).otherwise(number)
    return t.events.select("event_id", text.is_palindrome(sample).alias("is_palindrome"))


@query(r"""SELECT conv_id, turn, len(w) AS n_words, array_to_string(w, ' ') AS words FROM (SELECT conv_id, turn,
 list_filter(regexp_split_to_array(lower(text), '[\s\x0b\x1c-\x1f\x{85}\pZ]+'), lambda x: x <> '') AS w FROM conversations)""")
def fn_split_words(t: Tables) -> DataFrame:
    split = text.words(F.col("text"))
    return t.conversations.select("conv_id", "turn", F.size(split).alias("n_words"), F.array_join(split, " ").alias("words"))


@query("""SELECT c_custkey, regexp_replace(lower(c_name) || '@' || lower(c_mktsegment) || '.example', '.+@', '***@') AS email,
 lower(c_name) || '@' || lower(c_mktsegment) || '.example' AS email_for_reader FROM customer""")
def fn_mask_email(t: Tables) -> DataFrame:
    email = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    return t.customer.select(
        "c_custkey", privacy.mask_email(email).alias("email"),
        privacy.mask_email(email, roles=("pii_reader",)).alias("email_for_reader"),
    )


@query("""WITH ids AS (SELECT DISTINCT user_id FROM events)
SELECT event_id, sha256('pepper' || user_id) AS digest, 'tok_' || sha256('vault' || user_id) AS user_id FROM events""")
def fn_hash_token(t: Tables) -> DataFrame:
    ids = t.events.select(F.col("user_id").cast("string").alias("value")).distinct()
    vault = ids.withColumn("token", F.concat(F.lit("tok_"), privacy.hash_token(F.col("value"), "vault")))
    digested = t.events.select(
        "event_id", privacy.hash_token(F.col("user_id"), "pepper").alias("digest"), F.col("user_id").cast("string").alias("user_id")
    )
    return tokenize(digested, "user_id", cut_lineage(vault))


@query(with_feed("SELECT line_no, COALESCE(user_id, 'unknown') AS user_id FROM feed"))
def fn_coalesce(t: Tables) -> DataFrame:
    return feed(t).select("line_no", F.coalesce("user_id", F.lit("unknown")).alias("user_id"))


@query("SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DOUBLE) AS tax FROM lineitem")
def fn_round(t: Tables) -> DataFrame:
    tax = numbers.money(F.col("l_extendedprice")) * numbers.money(F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(tax, 2).cast("double").alias("tax"))


@query("""SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE round(event_id / CAST(user_id % 3 AS DOUBLE), 6) END AS ratio,
 user_id % 3 = 0 AS by_zero, CASE WHEN user_id % 3 = 0 THEN 'Cannot divide by zero' END AS message FROM events""")
def fn_safe_divide(t: Tables) -> DataFrame:
    by = F.col("user_id") % 3
    shown = numbers.divide_or_message(F.col("event_id"), by)
    return t.events.select(
        "event_id", F.round(numbers.safe_ratio(F.col("event_id"), by), 6).alias("ratio"), (by == 0).alias("by_zero"),
        F.when(shown == numbers.DIVIDE_BY_ZERO, shown).alias("message"),
    )


@query("SELECT c_custkey, abs(c_acctbal) AS size, abs(c_acctbal - round(c_acctbal)) <= 0.01 AS whole FROM customer")
def fn_abs(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.abs(balance).alias("size"), (F.abs(balance - F.round(balance)) <= 0.01).alias("whole")
    )


@query(with_feed("SELECT line_no, try_cast(amount AS DOUBLE) AS amount, CAST(try_cast(amount AS DECIMAL(12,2)) AS DOUBLE) AS exact FROM feed"))
def fn_cast(t: Tables) -> DataFrame:
    amount = F.col("amount")
    return feed(t).select(
        "line_no", amount.try_cast("double").alias("amount"), amount.try_cast("decimal(12,2)").cast("double").alias("exact")
    )


@query(with_feed("SELECT line_no, true_time AS event_time FROM feed"))
def fn_to_timestamp(t: Tables) -> DataFrame:
    return feed(t).select("line_no", times.parse_time(F.col("event_ts")).cast("timestamp_ntz").alias("event_time"))


@query(with_feed("""SELECT line_no, CASE line_no % 4 WHEN 0 THEN true_time IS NOT NULL WHEN 1 THEN FALSE WHEN 2 THEN true_time IS NOT NULL
 ELSE FALSE END AS zoned FROM feed"""))
def fn_is_tz_timestamp(t: Tables) -> DataFrame:
    # Four spellings by line: Z, no zone, an offset, and a date alone.
    stamp, kind = F.col("event_ts"), F.col("line_no") % 4
    bare = F.rtrim(stamp, F.lit("Z"))
    spelled = F.when(kind == 0, stamp).when(kind == 1, bare).when(kind == 2, F.concat(bare, F.lit("-04:00"))).otherwise(
        F.left(stamp, F.lit(10))
    )
    return feed(t).select("line_no", times.is_zoned_timestamp(spelled).alias("zoned"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def fn_to_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@query("SELECT event_id, date_trunc('hour', ts) AS hour, CAST(date_trunc('day', ts) AS DATE) AS day FROM events")
def fn_date_trunc(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return t.events.select("event_id", hour.alias("hour"), F.date_trunc("day", "ts").cast("date").alias("day"))


@query("""SELECT o_orderkey, o_orderdate - INTERVAL 7 DAY AS week_before, CAST(o_orderdate AS DATE) - 1 AS day_before,
 CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS month_after FROM orders""")
def fn_date_arith(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", (F.col("o_orderdate") - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        F.date_sub(day, 1).alias("day_before"), F.add_months(day, 1).alias("month_after"),
    )


@query("""SELECT o_orderkey, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, month(o_orderdate) AS month,
 monthname(o_orderdate) AS month_name, weekofyear(o_orderdate) AS week, isodow(o_orderdate) AS day_of_week,
 isodow(o_orderdate) >= 6 AS is_weekend, year(o_orderdate + INTERVAL 6 MONTH) AS fiscal_year,
 quarter(o_orderdate + INTERVAL 6 MONTH) AS fiscal_quarter FROM orders""")
def fn_date_parts(t: Tables) -> DataFrame:
    parts = times.date_parts(F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", *[column.alias(name) for name, column in parts.items()])


_ERRORS_SQL = """list_filter([
 CASE WHEN trim(coalesce(event_id, ''), ' ') = '' THEN 'event_id is required' END,
 CASE WHEN event_type NOT IN ('page_view', 'video_play', 'video_pause', 'add_to_cart', 'purchase') THEN 'event_type is not allowed' END,
 CASE WHEN trim(coalesce(user_id, ''), ' ') = '' THEN 'user_id is required' END,
 CASE WHEN true_time IS NULL THEN 'event_ts is invalid' END,
 CASE WHEN source NOT IN ('web', 'mobile', 'api', 'system') THEN 'source is not allowed' END,
 CASE WHEN no_payload THEN 'payload is required' END], lambda x: x IS NOT NULL)"""


@query(with_feed(f"SELECT line_no, array_to_string({_ERRORS_SQL}, '; ') AS errors FROM feed"))
def fn_array_compact(t: Tables) -> DataFrame:
    timed = payload_events(t).withColumn("event_time", times.parse_time(F.col("event_ts")))
    return timed.select("line_no", F.array_join(all_errors(field_rules()), "; ").alias("errors"))


@query(with_feed(f"SELECT len({_ERRORS_SQL}) AS n_errors, COUNT(*) AS n_rows FROM feed GROUP BY 1"))
def fn_size(t: Tables) -> DataFrame:
    timed = payload_events(t).withColumn("event_time", times.parse_time(F.col("event_ts")))
    return timed.groupBy(F.size(all_errors(field_rules())).alias("n_errors")).agg(F.count("*").alias("n_rows"))


@query(with_feed("SELECT line_no, k, amount FROM feed"))
def fn_map_get(t: Tables) -> DataFrame:
    payload = F.col("payload")
    return payload_events(t).select("line_no", payload.getItem("k").alias("k"), payload.getItem("amount").alias("amount"))


@query("SELECT label, count(*) AS n, round(sum(CAST(x AS DOUBLE)), 3) AS total FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY 1")
def fn_explode(t: Tables) -> DataFrame:
    values = t.embeddings.select("label", F.explode("embedding").alias("x"))
    return values.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(F.col("x").cast("double")), 3).alias("total"))


@query("SELECT event_id, user_id, event_type AS kind FROM events")
def fn_nested_field(t: Tables) -> DataFrame:
    nested = t.events.select("event_id", F.struct(F.col("user_id").alias("id"), F.struct("event_type").alias("what")).alias("user"))
    return nested.select("event_id", F.col("user.id").alias("user_id"), F.col("user.what.event_type").alias("kind"))


@query("""SELECT event_id, event_id % 131 <> 0 AS is_json, CASE WHEN event_id % 131 <> 0 THEN CAST(json_extract(props, '$.k') AS INT) END AS k FROM events""")
def json_parse(t: Tables) -> DataFrame:
    body = F.when(F.col("event_id") % 131 == 0, F.left("props", F.lit(4))).otherwise(F.col("props"))
    parsed = t.events.select("event_id", variants.parse_json(body).alias("v"))
    return parsed.select("event_id", F.col("v").isNotNull().alias("is_json"), variants.path(F.col("v"), "$.k", "int").alias("k"))


@query("""SELECT event_id, event_type AS os, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, NULL AS absent FROM events""")
def json_path(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(F.struct(F.col("event_type").alias("os")).alias("device"), F.col("value").alias("amount")))
    v = F.col("v")
    return t.events.select("event_id", variants.parse_json(body, strict=True).alias("v")).select(
        "event_id", variants.path(v, "$.device.os", "string").alias("os"),
        variants.path(v, "$.amount", "decimal(12,2)").cast("double").alias("amount"),
        variants.path(v, "$.campaign.id", "string").alias("absent"),
    )


_ITEMS_SQL = """SELECT l_orderkey AS order_id, 'part-' || l_partkey AS sku, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem
UNION ALL SELECT l_orderkey, 'supplier-' || l_suppkey, l_linenumber FROM lineitem"""


def _order_documents(t: Tables) -> DataFrame:
    """One JSON document per order line with an array of two items; built row by row, so no order is gathered."""
    part = F.struct(F.concat(F.lit("part-"), "l_partkey").alias("sku"), F.col("l_quantity").cast("bigint").alias("quantity"))
    supplier = F.struct(F.concat(F.lit("supplier-"), "l_suppkey").alias("sku"), F.col("l_linenumber").cast("bigint").alias("quantity"))
    document = F.struct(F.col("l_orderkey").alias("order_id"), F.array(part, supplier).alias("items"))
    return t.lineitem.select(F.to_json(document).alias("body"))


@query(_ITEMS_SQL)
def json_flatten(t: Tables) -> DataFrame:
    orders = _order_documents(t).select(variants.parse_json(F.col("body"), strict=True).alias("v"))
    keyed = orders.select(variants.path(F.col("v"), "$.order_id", "bigint").alias("order_id"), "v")
    return variants.flatten(keyed, "v", "$.items", {"sku": ("$.sku", "string"), "quantity": ("$.quantity", "bigint")})


@query(_ITEMS_SQL)
def udtf_flatten(t: Tables) -> DataFrame:
    sql_functions.register(t.spark)
    return t.spark.sql(
        """SELECT try_variant_get(parse_json(body), '$.order_id', 'bigint') AS order_id,
         variant_get(item.value, '$.sku', 'string') AS sku, variant_get(item.value, '$.quantity', 'bigint') AS quantity
        FROM {orders}, LATERAL flatten_items(body, '$.items') AS item""",
        orders=_order_documents(t),
    )


@query("SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def json_typed_decode(t: Tables) -> DataFrame:
    body = F.to_json(F.struct("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k")))
    messages = t.events.select(body.cast("binary").alias("value"))
    from pyspark.sql import types as T

    shape = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, k int")
    return messages.select(variants.decode(F.col("value"), shape).alias("e")).select("e.*")


@query("""SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def json_encode(t: Tables) -> DataFrame:
    return t.events.select("event_id", variants.encode("event_id", "user_id", "event_type").alias("value"))


_DEVICES = "['iOS ', ' android', 'Website', 'browser', ' API', 'Kiosk']"


@query(f"""WITH known(name, source) AS (VALUES ('android', 'mobile'), ('browser', 'web'), ('ios', 'mobile'), ('website', 'web'))
SELECT event_id, coalesce(source, s) AS source
FROM (SELECT event_id, lower(trim(({_DEVICES})[user_id % 6 + 1])) AS s FROM events) LEFT JOIN known ON name = s""")
def udf_sql_normalize_source(t: Tables) -> DataFrame:
    sql_functions.register(t.spark)
    names = _DEVICES.strip("[]")
    return t.spark.sql(
        f"SELECT event_id, normalize_source(element_at(array({names}), CAST(user_id % 6 + 1 AS INT))) AS source FROM {{events}}",
        events=t.events,
    )


@query(with_feed("SELECT line_no, try_cast(amount AS DOUBLE) AS number, amount IS NOT NULL AND try_cast(amount AS DOUBLE) IS NULL AS is_bad FROM feed"))
def udf_python_parse(t: Tables) -> DataFrame:
    number = numbers.parse_number(F.col("amount"))
    return feed(t).select("line_no", number.alias("number"), (F.col("amount").isNotNull() & number.isNull()).alias("is_bad"))
