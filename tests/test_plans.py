"""What the optimizer makes of the queries."""

import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from eventloom.plans.layout import bucketed_join
from eventloom.plans.registry import PLANS, Tables
from eventloom.sinks.tables import TableScope

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(spark):
    tables = Tables(spark, SMALL)
    return lambda name: PLANS[name](tables)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_filters_and_columns_reach_the_scan(plan_of):
    plan = plan_of("scan_parquet")
    assert re.search(r"PushedFilters: \[.*LessThan\(l_quantity,10.0\).*EqualTo\(l_returnflag,R\)", plan)
    assert "l_comment" not in plan and "l_extendedprice" not in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan_of("select_cols")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in plan_of("filter_between")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,", plan_of("retention_filter"))


def test_partition_filter_prunes_folders(plan_of):
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date.*2024-01-10", plan_of("partition_prune"))


def test_lookups_are_broadcast(plan_of):
    assert "BroadcastHashJoin" in plan_of("join_broadcast")
    assert "BroadcastHashJoin" in plan_of("map_side_lookup")


def test_bucketed_join_has_no_shuffle_of_its_inputs(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monkeypatch.setattr("eventloom.plans.layout.bucket_count", lambda *frames: 4)
    try:
        with TableScope(spark) as scope:
            plan = bucketed_join(Tables(spark, SMALL), scope)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and len(re.findall("Exchange hashpartitioning", plan)) == 1


def test_top_k_needs_no_global_sort(plan_of):
    for name in ("top_k", "take_first", "agg_review_queue"):
        plan = plan_of(name)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_counts_are_combined_before_the_shuffle(plan_of):
    assert "partial_count" in plan_of("agg_reduce_by_key")
    assert "partial_max_by" in plan_of("win_latest_row")


def test_parsed_json_is_not_repeated_in_filters(plan_of):
    plan = plan_of("silver_dedup")
    assert "Generate inline" in plan
    assert not re.search(r"Filter [^\n]*parseJson", plan)


def fact_shuffles(plan, column):
    """How often scanned rows with ``column`` are moved before an aggregate makes them fewer."""
    found, path = 0, []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, node) for d, node in path if d < depth] + [(depth, line.strip(" :+-"))]
        if re.search(rf"FileScan parquet \[[^\]]*\b{column}#", line):
            upward = [node.split("(")[0].split(" ")[0] for _, node in reversed(path)]
            until = next((i for i, node in enumerate(upward) if node.endswith("Aggregate")), len(upward))
            found += upward[:until].count("Exchange") or 1
    return found


@pytest.mark.parametrize("name", [
    "join_star", "agg_filtered", "agg_pct_of_total", "agg_filter_modifiers", "agg_yoy", "agg_summarize_cols", "agg_ratio_measure",
])
def test_the_fact_is_moved_once(spark, plan_of, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fact_shuffles(plan, "l_extendedprice") == 1 and "SortMergeJoin" in plan
    used = {"agg_filtered": "c_custkey|p_partkey", "agg_yoy": "c_custkey|p_partkey", "agg_pct_of_total": "c_custkey", "agg_summarize_cols": "c_custkey", "agg_ratio_measure": "p_partkey"}
    assert not re.search(used.get(name, "nothing"), plan)


def test_values_are_joined_once(plan_of):
    assert "o_totalprice" in PLANS["agg_stats"].__code__.co_consts and "o_orderkey" not in plan_of("agg_stats")


LAZY = sorted(set(PLANS) - {n for n in PLANS if n.startswith(("st_", "sink_", "scan_", "copy_"))})


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_row_at_a_time_python(plan_of, name):
    plan = plan_of(name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("texts", [["b a b", "", None, "c"], ["b a b", "A c", "A c", "é É", None]])
def test_words_travel_only_for_ids_of_several_texts(spark, tmp_path, texts):
    # The first list gives every id one text with words; in the second, ids repeat, one of them null.
    ids = [1, 1, 2, 3] if len(texts) == 4 else [1, 1, None, None, 2]
    spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = PLANS["flat_map_words"](Tables(spark, str(tmp_path)))
    bags = {}
    for i, text in zip(ids, texts):
        bags.setdefault(i, []).extend((text or "").lower().split())
    expected = {(i, len(b), len(set(b)), len("".join(b))) for i, b in bags.items() if b}
    assert sorted(out.dtypes) == [("doc_id", "bigint"), ("n_distinct", "bigint"), ("n_letters", "bigint"), ("n_words", "bigint")]
    got = out.select("doc_id", "n_words", "n_distinct", "n_letters").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    if len(texts) == 4:
        assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
