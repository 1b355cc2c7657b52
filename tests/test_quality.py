import json

import pytest
from pyspark.sql import functions as F

from eventloom.contract import EVENT_SCHEMA, MINIMAL_FIELDS
from eventloom.functions.times import is_zoned_timestamp
from eventloom.operators import checks, quality
from eventloom.operators.measures import summarize
from eventloom.sources.files import read_json_lines
from samples import BATCH, CHECKED, COLLECTED, T, event


def lines(spark, *rows):
    text = [(n, r if isinstance(r, str) else json.dumps(r)) for n, r in enumerate(rows, start=1)]
    return spark.createDataFrame(text, "line_number long, value string")


def errors_of(spark, *rows):
    return {r.line_number: r.errors for r in quality.validate_lines(lines(spark, *rows)).collect()}


def test_collected_errors_split_and_reasons(spark, write_lines):
    checked = quality.collect_errors(read_json_lines(spark, write_lines(COLLECTED)))
    valid, invalid = quality.split_errors(checked)
    assert (valid.count(), invalid.count()) == (5, 2)
    reasons = {r.event_id: set(r.validation_errors) for r in invalid.collect()}
    assert reasons == {"": {"event_id is required"}, "evt_007": {"user_id is required", "event_ts is invalid"}}
    counts = {(r.event_type, r.source): (r.event_count, r.unique_users) for r in summarize(valid, ["event_type", "source"]).collect()}
    assert counts == {
        ("add_to_cart", "mobile"): (1, 1), ("page_view", "web"): (2, 1), ("purchase", "web"): (1, 1), ("video_play", "mobile"): (1, 1)
    }
    assert quality.run_summary(checked).first().asDict() == {"valid": 5, "invalid": 2, "passed": False}


def test_first_reason_profile(spark, write_lines):
    good, bad = quality.split_reason(quality.first_reason(read_json_lines(spark, write_lines(BATCH))))
    assert good.count() == 4
    assert {r.event_id: r.reject_reason for r in bad.collect()} == {
        "evt_bad_001": "missing user_id", "evt_bad_002": "invalid event_ts"
    }
    assert {tuple(r) for r in summarize(good, ["event_type", "source"]).collect()} == {
        ("page_view", "web", 1, 1), ("purchase", "mobile", 1, 1), ("purchase", "web", 1, 1), ("video_play", "mobile", 1, 1)
    }


def test_quality_profile_rejects_every_copy(spark, write_lines):
    summary = quality.dq_summary(quality.quality_check(read_json_lines(spark, write_lines(CHECKED))))
    assert {(r.dq_status, r.reject_reason): r.record_count for r in summary.collect()} == {
        ("pass", None): 1, ("fail", "duplicate event_id"): 2, ("fail", "missing event_id"): 1, ("fail", "missing user_id"): 1,
        ("fail", "invalid event_ts"): 1, ("fail", "invalid purchase amount"): 1,
    }


def test_valid_and_invalid_lines(spark):
    good = [
        event("evt_001", "page_view", "u", T(0)),
        event("evt_002", "video_play", "u", T(1), "mobile", {"video_id": "v", "position_seconds": 0}),
        event("evt_003", "purchase", "u", T(2), payload={"plan": "pro", "amount": 19.99}),
    ]
    assert list(errors_of(spark, *good).values()) == [[], [], []]
    bad = errors_of(
        spark,
        event("", "page_view", "u", T(0)),
        event("b2", "logout", "u", T(1), payload={}),
        event("b3", "purchase", "", "not-a-timestamp", "browser", {"amount": -10}),
    )
    assert bad[1] == ["event_id must be a non-empty string"]
    assert bad[2] == ["event_type is not allowed"]
    assert bad[3] == [
        "user_id must be a non-empty string", "event_ts must be an ISO 8601 timestamp with a timezone", "source is not allowed",
        "purchase payload.amount must be a positive number",
    ]


@pytest.mark.parametrize(
    "change, message",
    [
        ({"payload": [1]}, "payload must be an object"),
        ({"payload": {"page": "\t "}}, "page_view payload.page must be a non-empty string"),
        ({"user_id": 7}, "user_id must be a non-empty string"),
        ({"event_type": None}, "event_type is not allowed"),
        ({"event_type": "video_pause", "payload": {"video_id": "v", "position_seconds": True}},
         "video_pause payload.position_seconds must be a non-negative number"),
        ({"event_type": "add_to_cart", "payload": {"sku": "s", "quantity": 2.0}},
         "add_to_cart payload.quantity must be a positive integer"),
        ({"event_type": "purchase", "payload": {"amount": 1, "plan": None}}, "purchase payload.plan must be a non-empty string"),
    ],
)
def test_single_defects(spark, change, message):
    assert errors_of(spark, {**event("e", "page_view", "u", T(0)), **change})[1] == [message]


def test_structure_of_lines(spark):
    whole = event("e1", "page_view", "u", T(0))
    short = {k: v for k, v in whole.items() if k not in ("source", "payload")}
    found = errors_of(spark, whole, "", "   ", "{oops", "[1]", '"text"', short, whole, {**short, "payload": None, "source": None})
    assert found == {
        1: [], 4: ["invalid JSON at column 2: Expecting property name enclosed in double quotes"], 5: ["event must be a JSON object"], 6: ["event must be a JSON object"],
        7: ["missing fields: ['payload', 'source']", "duplicate event_id: e1"], 8: ["duplicate event_id: e1"],
        9: ["source is not allowed", "payload must be an object", "duplicate event_id: e1"],
    }


def test_place_and_cause_of_malformed_lines(spark):
    texts = {'{"a": }': "invalid JSON at column 7: Expecting value", "nul": "invalid JSON at column 1: Expecting value", '{"a": "b': "invalid JSON at column 7: Unterminated string starting at",
             '{"a": NaN}': "invalid JSON: NaN, Infinity or a repeated key", '{"a":1,"a":2}': "invalid JSON: NaN, Infinity or a repeated key"}
    found = errors_of(spark, *texts)
    assert [found[i + 1] for i in range(len(texts))] == [[m] for m in texts.values()]


def test_zoned_timestamps(spark):
    texts = ["2026-06-30T14:00:00Z", "2026-06-30T10:00:00-04:00", "2026-06-30T14:00:00", "not-a-timestamp", "2026-06-30", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(is_zoned_timestamp(F.col("t")).alias("ok"))
    assert [r.ok for r in rows.collect()] == [True, True, False, False, False, False, False]


def test_required_fields_stop_the_job(spark):
    good = lines(spark, {"event_id": "e", "event_type": "purchase", "user_id": "u"})
    assert quality.require_fields(good, MINIMAL_FIELDS).count() == 1
    with pytest.raises(Exception, match="Line 1 is missing required field user_id"):
        quality.require_fields(lines(spark, {"event_id": "e", "event_type": "page_view"}), MINIMAL_FIELDS).collect()
    with pytest.raises(Exception, match="MALFORMED|PARSE|parse"):
        quality.require_fields(lines(spark, "{"), MINIMAL_FIELDS).collect()
    with pytest.raises(ValueError, match="no events"):
        quality.require_rows(good.where("false"), "no events")


def test_schema_contract(spark):
    actual = spark.createDataFrame([], "event_id long, event_type string")
    assert checks.schema_differences(actual.schema, EVENT_SCHEMA)[:2] == ["missing column user_id", "missing column event_ts"]
    assert "column event_id is bigint, expected string" in checks.schema_differences(actual.schema, EVENT_SCHEMA)
    assert checks.schema_differences(EVENT_SCHEMA, EVENT_SCHEMA) == []


def test_layers_reconcile(spark):
    n = lambda k: spark.range(k)
    row = checks.reconcile_layers(n(10), n(6), n(3), n(1)).first()
    assert (row.unexplained, row.passed) == (0, True)
    assert checks.reconcile_layers(n(10), n(6), n(3), n(0)).first().unexplained == 1
