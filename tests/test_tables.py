"""Known answers for joins, summaries, sources, sinks and changing tables."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.contract import FLAT_EVENT_SCHEMA, USER_SCHEMA
from eventloom.functions import numbers, text, variants
from eventloom.operators import joins
from eventloom.operators.joins import enrich, subtract_keep_copies
from eventloom.operators.measures import count_by, count_items, count_sources, funnel, json_summary, mastery, review_queue, summarize, values_per_key, word_count
from eventloom.functions.numbers import lost_amounts, money
from eventloom.operators.rows import hash_sample
from eventloom.plans import load_all
from eventloom.plans.registry import PLANS, Tables
from eventloom.sinks import files as sinks
from eventloom.sinks.tables import TableScope, bucket_count, measured_bytes
from eventloom.sources import files as sources
from eventloom.sources.topics import encode_events, topic_options
from eventloom.warehouse import changes, gold, governance, silver
from eventloom.warehouse.bronze import load_bronze
from samples import FLAT, USERS, T, event


@pytest.fixture
def events(spark, write_lines):
    rows = spark.read.schema(FLAT_EVENT_SCHEMA).json(write_lines(FLAT))
    return rows.withColumn("event_time", F.try_to_timestamp("event_ts")).withColumn("event_date", F.to_date("event_time"))


@pytest.fixture
def users(spark, write_lines):
    return spark.read.schema(USER_SCHEMA).json(write_lines(USERS, "users.jsonl"))


def test_named_questions(events, users):
    web = events.where("source = 'web'").orderBy("event_time").collect()
    assert (len(web), web[0].event_id, web[-1].event_id) == (5, "evt_001", "evt_008")
    groups = {(r.event_type, r.source): (r.event_count, r.unique_users) for r in summarize(events, ["event_type", "source"]).collect()}
    assert groups[("page_view", "web")] == (3, 2) and len(groups) == 6
    bought = enrich(events.where("event_type = 'purchase'"), users, "user_id", ["plan", "region"])
    revenue = bought.groupBy("plan", "region").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("r"))
    assert {(r.plan, r.region): (r.n, r.r) for r in revenue.collect()} == {
        ("unknown", "unknown"): (1, 49.99), ("premium", "us-west"): (1, 29.99), ("premium", "us-east"): (1, 19.99),
        ("free", "us-central"): (1, 9.99),
    }
    assert [(r.event_id, r.user_id) for r in events.join(users, "user_id", "left_anti").collect()] == [("evt_010", "user_999")]
    buyers, premium = events.where("event_type = 'purchase'").select("user_id"), users.where("plan = 'premium'").select("user_id")
    assert {r.user_id for r in buyers.subtract(premium).collect()} == {"user_104", "user_999"}
    by_day = enrich(events, users, "user_id", ["plan", "region"]).groupBy("event_date", "plan").count()
    assert {(str(r.event_date)[5:], r.plan): r["count"] for r in by_day.collect()} == {
        ("07-06", "free"): 4, ("07-06", "premium"): 2, ("07-07", "free"): 1, ("07-07", "premium"): 2, ("07-07", "unknown"): 1
    }


def test_partitioned_output_and_pruning(spark, events, users, tmp_path):
    path = str(tmp_path / "enriched")
    sinks.write_partitioned(enrich(events, users, "user_id", ["plan", "region"]), path)
    assert sorted(p.name for p in Path(path).glob("event_date=*")) == ["event_date=2026-07-06", "event_date=2026-07-07"]
    assert (Path(path) / "_SUCCESS").is_file()
    back = spark.read.parquet(path)
    assert back.count() == 10
    one_day = back.where("event_date = DATE '2026-07-07'")
    assert "PartitionFilters: [isnotnull(event_date" in one_day._jdf.queryExecution().toString()
    assert one_day.count() == 4


def test_json_reader_keeps_malformed_lines(spark, write_lines):
    path = write_lines([event("e1", "page_view", "u", T(0)), "{broken"])
    rows = sources.read_json_lines(spark, path, keep_corrupt=True).collect()
    assert [(r.event_id, r[sources.CORRUPT]) for r in rows] == [("e1", None), (None, "{broken")]


def test_csv_options_and_names(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('A;b\n1;"x;y"\n2;NULL\nz;\n', encoding="utf-8")
    rows = sources.read_csv(spark, str(path), "A int, b string", sep=";", null_if=("NULL",)).collect()
    assert [tuple(r) for r in rows] == [(1, "x;y"), (2, None), (None, None)]
    other = tmp_path / "named.csv"
    other.write_text("NAME,Id\nann,1\n", encoding="utf-8")
    assert tuple(sources.read_csv_by_name(spark, str(other), "id int, name string, note string").first()) == (1, "ann", None)


def test_scores(spark, tmp_path):
    path = tmp_path / "scores.txt"
    path.write_text("80\n\n90\n \t\n100\n", encoding="utf-8")
    assert sources.average_score(spark, str(path)).first().average == 90.0
    path.write_text("\n", encoding="utf-8")
    assert sources.average_score(spark, str(path)).first().average == 0


def test_staged_loads(spark, write_lines):
    good, bad = event("e1", "purchase", "u", T(0)), event("e2", "purchase", "u", T(1))
    a = Path(write_lines([good, bad], "stage/a.jsonl")).parent
    write_lines([event("e3", "purchase", "u", T(2)), "{broken"], "stage/b.jsonl")
    columns = {"event_id": ("$.event_id", "string"), "event_ts": ("$.event_ts", "timestamp")}
    loaded = sources.copy_json(spark, str(a), columns, on_error="skip_file")
    assert {r.event_id for r in loaded.collect()} == {"e1", "e2"}
    with pytest.raises(Exception, match="MALFORMED|RECORD"):
        sources.copy_json(spark, str(a), columns).collect()
    with pytest.raises(ValueError):
        sources.copy_json(spark, str(a), columns, on_error="continue")
    errors = sources.validate_load(spark, str(a), {"event_id": ("$.event_id", "int")}).collect()
    assert sorted(r.error for r in errors) == ["event_id is no int"] * 3 + ["invalid JSON"]


def test_summary_document(spark, tmp_path):
    rows = spark.createDataFrame([("purchase",), ("page_view",), ("video_play",)], "event_type string")
    sinks.write_json_summary(rows, str(tmp_path / "s"))
    assert json.loads(spark.read.text(str(tmp_path / "s")).first().value) == {
        "total_events": 3, "events_by_type": {"page_view": 1, "purchase": 1, "video_play": 1}
    }
    assert json.loads(json_summary(rows.where("false")).first().value) == {"total_events": 0, "events_by_type": {}}


def test_single_report_file_and_rejects(spark, events, tmp_path):
    sinks.write_csv(count_by(events, ["event_type", "source"]), str(tmp_path / "r"), single_file=True)
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1
    bad = events.withColumn("reject_reason", F.lit("x")).withColumn("event_id", F.lit("  "))
    sinks.write_rejects(bad, str(tmp_path / "bad"))
    assert {r.event_id for r in spark.read.csv(str(tmp_path / "bad"), header=True).collect()} == {"  "}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("left_b", "right_b"):
            sinks.write_bucketed(spark.range(200), name, "id", 8, path=str(tmp_path / name))
        plan = spark.table("left_b").join(spark.table("right_b"), "id")
        assert plan.count() == 200
        assert "Exchange hashpartitioning" not in spark.table("left_b").join(spark.table("right_b"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_words(spark):
    rows = spark.createDataFrame([(["apple", "banana", "apple", "orange", "banana", "apple"],)], "words array<string>")
    assert {r["item"]: r.n for r in count_items(rows, "words").collect()} == {"apple": 3, "banana": 2, "orange": 1}
    texts = spark.createDataFrame([("To be or\tNOT to\x1cbe  ",), ("",)], "text string")
    assert [tuple(r) for r in word_count(texts).collect()] == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]


def test_scalars(spark):
    row = spark.range(1).select(
        F.reverse(F.lit("python")).alias("rev"), text.is_palindrome(F.lit("Race car")).alias("p1"),
        text.is_palindrome(F.lit("hello")).alias("p2"), numbers.divide_or_message(F.lit(10), F.lit(2)).alias("d1"),
        numbers.divide_or_message(F.lit(10), F.lit(0)).alias("d2"),
        numbers.total_with_tax(F.lit(15).cast("decimal(18,2)"), "0.08").cast("double").alias("tax"),
        numbers.parse_number(F.lit("x1")).alias("bad"),
    ).first()
    assert tuple(row) == ("nohtyp", True, False, "5.0", "Cannot divide by zero", 16.2, None)


def test_sources_are_checked(spark):
    rows = spark.createDataFrame([("web",), ("web",), ("api",)], "source string")
    out = count_sources(rows, ["mobile", "web", "web"], {"web", "mobile", "api"}).orderBy("source").collect()
    assert [tuple(r) for r in out] == [("mobile", 0, 2, 2), ("web", 2, 2, 2)]
    with pytest.raises(Exception, match="fax"):
        count_sources(rows, ["fax"], {"web"}).collect()


def test_progress(spark):
    answers = spark.createDataFrame([("sql", True)] * 5 + [("sql", False)] * 3, "topic string, ok boolean")
    assert mastery(answers, "topic", F.col("ok")).first().pct == 63
    progress = spark.createDataFrame(
        [("a", 4, 0, 12), ("b", 4, 2, 12), ("c", 4, 0, 8), ("d", 0, 0, 0), ("e", 4, 5, 12)], "id string, attempts int, wrong int, confidence_total int"
    )
    assert [r.id for r in review_queue(progress, "id").collect()] == ["e", "b", "c", "d"]


def test_values_of_a_heavy_key_stay_whole_in_bounded_pieces(spark):
    rows = spark.range(2500).select(F.lit("hot").alias("k"), "id", (F.col("id") * 2).alias("v"))
    pieces = values_per_key(rows, "k", "v", "id", size=1000).orderBy("piece").collect()
    assert [len(p["values"]) for p in pieces] == [1000, 1000, 500]
    assert [v for p in pieces for v in p["values"]] == [2 * i for i in range(2500)]


def test_pieces_are_numbered_inside_each_key(spark):
    rows = spark.createDataFrame([(k, i * 3000 + j, j) for j, k in enumerate(("a", None)) for i in range(5)], "k string, id long, v int")
    out = {(r.k, r.piece): (r.n_pieces, len(r["values"])) for r in values_per_key(rows, "k", "v", "id", size=2).collect()}
    assert out == {(k, p): (3, n) for k in ("a", None) for p, n in ((0, 2), (1, 2), (2, 1))}


def test_hash_sample_bounds(spark):
    rows = spark.range(10_000)
    assert [hash_sample(rows, "id", share).count() for share in (0, 1)] == [0, 10_000]
    assert 4700 < hash_sample(rows, "id", 0.5).count() < 5300
    with pytest.raises(ValueError):
        hash_sample(rows, "id", 1.5)


def test_large_amounts_are_kept_or_counted(spark):
    rows = spark.createDataFrame([("12345678901234567890.25",), ("1e60",), ("x",)], "a string")
    total, lost = rows.agg(F.sum(money(F.col("a"))), lost_amounts(F.col("a"))).first()
    assert str(total) == "12345678901234567890.25" and lost == 1


def test_null_keys_in_changing_tables(spark):
    held = spark.createDataFrame([(None, "keep"), (1, "a")], "id int, v string")
    assert {tuple(r) for r in changes.merge_upsert(held, spark.createDataFrame([(1, "b")], "id int, v string"), "id").collect()} == {(None, "keep"), (1, "b")}
    assert {tuple(r) for r in changes.merge_upsert(held, spark.createDataFrame([(None, "new")], "id int, v string"), "id").collect()} == {(None, "new"), (1, "a")}
    gone = changes.change_delta(held, held.where("id = 1"), "id").collect()
    assert [tuple(r) for r in gone] == [(None, "keep", "DELETE", False)]
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(Exception, match="several rows for one id"):
        changes.merge_upsert(held, twice, "id").collect()
    current = spark.createDataFrame([(None, "x", 1, None, True)], "id int, v string, valid_from int, valid_to int, is_current boolean")
    after = changes.snapshot_increment(current, spark.createDataFrame([(2, "y")], "id int, v string"), "id", ["v"], F.lit(9))
    assert {tuple(r) for r in after.collect()} == {(None, "x", 1, None, True), (2, "y", 9, None, True)}


def test_csv_columns_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,ID\ny,2\n")
    rows = sources.read_csv_by_name(spark, str(tmp_path), "id int, name string, extra int").collect()
    assert {tuple(r) for r in rows} == {(1, "x", None), (2, "y", None)}


def test_nothing_stays_cached(spark):
    load_all()
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    for name in ("agg_cached_by_date_plan", "cache_reuse"):
        PLANS[name](Tables(spark, "/root/testdata/sf0.001")).collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_funnel_plan_does_not_multiply(spark):
    events = spark.createDataFrame([(u, s, i) for u in range(3) for i, s in enumerate("abcdef"[: 2 + 2 * u])], "u int, k string, t int")
    out = funnel(events, list("abcdef"), "u", "k", "t")
    assert [(r.step, r.users) for r in out.orderBy("step_no").collect()] == list(zip("abcdef", (3, 3, 2, 2, 1, 1), strict=True))
    assert out._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Scan") <= 1


def test_subtract_keeps_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None)], "a int, b string")
    assert [tuple(r) for r in subtract_keep_copies(a, b).collect()] == [(2, "x"), (2, "x")]


def test_order_items(spark):
    body = '{"order_id":"ord_101","items":[{"sku":"sku_a","quantity":2},{"sku":"sku_b","quantity":1}]}'
    orders = spark.createDataFrame([(body,)], "body string").select(variants.parse_json(F.col("body")).alias("v"))
    keyed = orders.select(variants.path(F.col("v"), "$.order_id", "string").alias("order_id"), "v")
    out = variants.flatten(keyed, "v", "$.items", {"sku": ("$.sku", "string"), "quantity": ("$.quantity", "int")})
    assert {tuple(r) for r in out.collect()} == {("ord_101", "sku_a", 2), ("ord_101", "sku_b", 1)}


def test_message_columns_and_options(spark):
    rows = spark.createDataFrame([("user_1", "page_view", 1)], "user_id string, event_type string, round int")
    message = encode_events(rows, "user_id", "app.events").first()
    assert (message.key, json.loads(message.value), message.topic) == (
        "user_1", {"user_id": "user_1", "event_type": "page_view", "round": 1}, "app.events"
    )
    assert topic_options("h:1", "a.*", "latest", pattern=True)["subscribePattern"] == "a.*"
    with pytest.raises(ValueError):
        topic_options("h:1", "a", "middle")


def test_upsert_history_and_delta(spark):
    target = spark.createDataFrame([(1, "a@x", 10, "keep"), (2, "b@x", 10, "keep")], "id int, email string, at int, note string")
    updates = spark.createDataFrame([(2, "c@x", 11, "n"), (2, "d@x", 12, "n"), (3, "e@x", 11, "new")], target.schema)
    merged = changes.merge_upsert(target, updates, "id", order=["at"], update=["email", "at"])
    expected = {(1, "a@x", 10, "keep"), (2, "d@x", 12, "keep"), (3, "e@x", 11, "new")}
    assert {tuple(r) for r in merged.collect()} == expected
    again = changes.merge_upsert(merged, updates, "id", order=["at"], update=["email", "at"])
    assert {tuple(r) for r in again.collect()} == expected
    delta = changes.change_delta(target, merged, "id").collect()
    assert {(r.id, r.action, r.is_update) for r in delta} == {(2, "DELETE", True), (2, "INSERT", True), (3, "INSERT", False)}

    versions = spark.createDataFrame([("u", 1, "basic"), ("u", 2, "basic"), ("u", 5, "premium"), ("v", 3, "basic")], "u string, at int, plan string")
    rows = changes.history(versions, "u", ["at"], ["plan"], piece_rows=1)
    table = {("u", "basic", 1, 5, False), ("u", "premium", 5, None, True), ("v", "basic", 3, None, True)}
    assert {tuple(r) for r in rows.collect()} == table
    incoming = spark.createDataFrame([("u", "basic"), ("v", "basic"), ("w", "basic")], "u string, plan string")
    after = changes.snapshot_increment(rows, incoming, "u", ["plan"], F.lit(9))
    assert {tuple(r) for r in after.collect()} == (table - {("u", "premium", 5, None, True)}) | {
        ("u", "premium", 5, 9, False), ("u", "basic", 9, None, True), ("w", "basic", 9, None, True)
    }


def test_published_versions(spark):
    # The view may be read while its next version is made from it.
    changes.publish_version(spark.range(3), "published_ids", 1)
    changes.publish_version(spark.table("published_ids").where("id > 0"), "published_ids", 2)
    assert spark.table("published_ids").count() == 2
    for name in ("VIEW published_ids", "TABLE published_ids_v1", "TABLE published_ids_v2"):
        spark.sql(f"DROP {name}")


def test_bronze_to_gold(spark):
    body = '{"event_id":"e1","event_type":" Purchase","event_ts":"2026-06-30T14:00:00Z","source":"WEB","entity_id":"u","payload":{"amount":19.99}}'
    rows = spark.createDataFrame([(body, "f1"), (body, "f2"), ("{", "f2")], "value string, source_file string")
    loaded = load_bronze(rows, "topic", "run_1")
    built = silver.build_silver(loaded, order=["loaded_at", "source_file"])
    one = built.events.first()
    assert (built.events.count(), one.event_type, one.source, str(one.event_date)) == (1, "purchase", "web", "2026-06-30")
    assert [r.reject_reason for r in built.rejected.collect()] == ["missing event_id"]
    assert [r.raw_text for r in built.rejected.collect()] == ["{"]
    facts = gold.fact_events(built.events)
    assert facts.first().event_key == gold.fact_events(built.events).first().event_key
    assert float(gold.fact_domain(built.events, "purchase", {"amount": ("$.amount", "decimal(12,2)")}).first().amount) == 19.99


def test_personal_data(spark):
    rows = spark.createDataFrame([("mail ann@example.org",), ("call +1 (555) 010-9999",), ("123-45-6789",), ("host 10.0.0.1",), ("plain",)], "t string")
    found = {r.kind: r.matches for r in governance.pii_scan(rows, ["t"]).collect()}
    assert found == {"email": 1, "phone": 2, "government_id": 1, "ip_address": 1}
    assert governance.tag_column(rows, "t", "email").schema["t"].metadata == {"pii": "email"}
    assert governance.masked_view(rows, "t").first().t == "***@example.org"
    assert governance.masked_view(rows, "t", ("pii_reader",)).first().t == "mail ann@example.org"


@pytest.mark.parametrize("run", [1, 3, 1000])
def test_copies_are_repeated_whole(spark, run):
    counts = spark.createDataFrame([("a", 7), (None, 2), ("b", 1)], "k string, _n long")
    rows = [r.k for r in joins._repeated(counts, run).collect()]
    assert sorted(map(str, rows)) == ["None"] * 2 + ["a"] * 7 + ["b"]


def test_differences(spark):
    a = spark.createDataFrame([(1, "x")] * 3 + [(2, None)] * 2 + [(3, "z")], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "q")], "i int, s string")
    assert sorted(map(tuple, joins.except_all(a, b).collect())) == sorted(map(tuple, a.exceptAll(b).collect()))
    assert sorted(map(tuple, joins.intersect(a, b).collect()), key=str) == [(1, "x"), (2, None)]
    assert [tuple(r) for r in joins.subtract(a, b).collect()] == [(3, "z")]


@pytest.mark.parametrize("how", ["right", "full"])
def test_outer_join_equals_the_plain_join(spark, how):
    a = spark.createDataFrame([(1, "a")] * 4 + [(2, "b"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "m")], "c int, w string")
    split = joins.outer_join(a, b, "k", "c", how).select("k", "v", "c", "w")
    assert sorted(map(str, split.collect())) == sorted(map(str, a.join(b, a.k == b.c, how).collect()))
    with pytest.raises(ValueError):
        joins.outer_join(a, b, "k", "c", "inner")


def test_three_header_orders_are_placed_without_a_collect(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('id,name,"odd, one"\n1,"x, y",p\n\n2,,q\nid,name,r\n')
    (tmp_path / "b.csv").write_text("NAME,ID\ny,3\n")
    (tmp_path / "c.csv").write_text('"Odd, One",note,Id\nr,n,4\n')
    (tmp_path / "d.csv").write_text("")
    collected, kind = [], type(spark.range(0))
    plain = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(r := plain(self)) or r)
    frame = sources.read_csv_by_name(spark, str(tmp_path), "id string, name string, `odd, one` string, extra int")
    monkeypatch.undo()
    assert all(len(r) == 1 for r in collected)  # the widest header, and whether the headers may be broadcast
    expected = {("1", "x, y", "p", None), ("2", None, "q", None), ("id", "name", "r", None), ("3", "y", None, None), ("4", None, "r", None)}
    assert {tuple(r) for r in frame.collect()} == expected
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.read_csv_by_name(spark, str(tmp_path), "id int").collect()
    (tmp_path / "none").mkdir()
    assert sources.read_csv_by_name(spark, str(tmp_path / "none"), "id int").collect() == []


def test_only_files_beside_new_days_are_read(spark, tmp_path):
    source, mart, manifest = (str(tmp_path / n) for n in ("source", "mart", "days"))
    put = lambda n, *days: spark.createDataFrame([(d, n) for d in days], "d int, v int").coalesce(1).write.mode("append").parquet(source)
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("d"))
    build = lambda rows: rows.groupBy("event_date").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    run = lambda builder=build: changes.rebuild_from_files(spark, source, builder, mart, manifest, day)
    state = lambda: {(r.event_date.day - 1, r.v, r.n) for r in spark.read.parquet(mart).collect()}
    put(1, 0, 1)
    put(2, 5, 6)
    put(3, 10, 11)
    assert len(run()) == 3 and state() == {(0, 1, 1), (1, 1, 1), (5, 2, 1), (6, 2, 1), (10, 3, 1), (11, 3, 1)}
    assert run() == []
    put(4, 6, 20, None)
    with pytest.raises(OSError):
        run(lambda rows: (_ for _ in ()).throw(OSError("lost")))
    files = run()
    assert len(files) == 2 and state() == {(0, 1, 1), (1, 1, 1), (5, 2, 1), (6, 6, 2), (10, 3, 1), (11, 3, 1), (20, 4, 1)}
    assert run() == []


def test_no_table_is_left_behind(spark):
    load_all()
    for name in ("ctas", "insert_select", "sink_bucketed"):
        assert PLANS[name](Tables(spark, "/root/testdata/sf0.001")).count()
    with pytest.raises(ValueError), TableScope(spark) as scope:
        name, path = scope.table("kept")
        spark.range(3).write.option("path", path).saveAsTable(name)
        raise ValueError
    left = [r.tableName for r in spark.sql("SHOW TABLES").collect() if not r.isTemporary]
    assert not [n for n in left if n.startswith(("counts_", "runs_", "orders_", "lines_", "kept_"))]


def test_buckets_follow_the_bytes(spark):
    frame = spark.createDataFrame([(i, "x" * 100) for i in range(50)] + [(None, None)], "a long, b string")
    assert measured_bytes(frame) == 50 * 108 + 8 and measured_bytes(frame.limit(0)) == 0
    assert bucket_count(frame, spark.range(1)) == 1 and bucket_count(frame, bucket_bytes=1000) == 8 and bucket_count(frame.limit(0)) == 1


def test_a_bucket_is_small_and_one_file(spark, tmp_path):
    assert bucket_count(spark.range(9_000_000)) == 8  # 72 MB of keys take about a GB when a task sorts them
    with TableScope(spark) as scope:
        name, path = scope.table("kept")
        rows = spark.range(1000).unionByName(spark.createDataFrame([(None,)], "id long")).repartition(4)
        sinks.write_bucketed(rows, name, "id", 8, path=path)
        assert len(spark.table(name).inputFiles()) == 8 and spark.table(name).count() == 1001
