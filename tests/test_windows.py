import random
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.operators.measures import Step, sum_through, value_counts, weighted_moments, year_over_year
from eventloom.operators.skew import attach_groups, attach_per_key, broadcast_if_small, fits_broadcast
from eventloom.operators.windows import (
    count_per_key, exact_median, in_pieces, later_copies, latest_per_key, median_of_counts, running_balance, with_neighbour,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, another part under null, the rest spread out."""
    rng = random.Random(3)
    rows = [(None if i % 7 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(60)}", i, rng.randrange(1000)) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "k string, seq int, v int").repartition(6).cache()


@pytest.mark.parametrize("hot_keys", [1, 2, 1000])
def test_facts_reach_every_row_whatever_the_number_of_hot_keys(skewed, hot_keys):
    rows, df = skewed
    expected = pd.DataFrame(rows, columns=["k", "seq", "v"]).fillna({"k": "-"}).groupby("k")["v"].sum().to_dict()
    facts = df.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    out = attach_per_key(df, facts, ["k"], "n", ["total"], hot_keys=hot_keys).collect()
    assert len(out) == len(rows)
    assert all(r.total == expected[r.k or "-"] for r in out)


def test_hot_rows_are_spread_over_the_shuffle(skewed):
    _, df = skewed
    facts = df.groupBy("k").agg(F.count("*").alias("n"))
    plan = attach_per_key(df, facts, ["k"], "n", ["n"], hot_keys=1)._jdf.queryExecution().toString()
    assert "SPARK_PARTITION_ID" in plan and "CartesianProduct" not in plan


def test_attach_groups_falls_back_when_groups_are_many(skewed, monkeypatch):
    rows, df = skewed
    facts = df.groupBy("k").agg(F.count("*").alias("n"))
    small = {(r.seq, r.n) for r in attach_groups(df, facts, ["k"], "n", ["n"]).collect()}
    monkeypatch.setattr("eventloom.operators.skew.fits_broadcast", lambda *a, **k: False)
    assert {(r.seq, r.n) for r in attach_groups(df, facts, ["k"], "n", ["n"]).collect()} == small


def test_counts_copies_and_latest(skewed):
    rows, df = skewed
    frame = pd.DataFrame(rows, columns=["k", "seq", "v"]).fillna({"k": "-"})
    size, first, last = (frame.groupby("k")["seq"].agg(a).to_dict() for a in ("size", "min", "max"))
    assert all(r.n == size[r.k or "-"] for r in count_per_key(df, ["k"], "n").collect())
    copies = later_copies(df, ["k"], "seq").collect()
    assert len(copies) == len(rows) and all(r.is_later_copy == (r.seq > first[r.k or "-"]) for r in copies)
    assert {r.k or "-": r.seq for r in latest_per_key(df, ["k"], ["seq"]).collect()} == last


@pytest.mark.parametrize("piece_rows", [7, 100, 400, 10_000])
@pytest.mark.parametrize("step", [-1, 1])
def test_neighbours_do_not_depend_on_the_pieces(skewed, piece_rows, step):
    rows, df = skewed
    frame = pd.DataFrame(rows, columns=["k", "seq", "v"]).fillna({"k": "-"}).sort_values("seq")
    frame["near"] = frame.groupby("k")["v"].shift(-step)
    expected = {r.seq: None if pd.isna(r.near) else int(r.near) for r in frame.itertuples()}
    out = with_neighbour(df, ["k"], ["seq"], ["v"], "near", step, piece_rows).collect()
    assert {r.seq: r.near.v if r.near else None for r in out} == expected


def replay(moves, opening):
    balance, out = Decimal(opening), []
    for seq, amount in moves:
        accepted = balance + amount >= 0
        balance = balance + amount if accepted else balance
        out.append((seq, accepted, balance))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-60, 40)), min_size=1, max_size=60), st.sampled_from([1, 5, 1000]))
def test_balance_equals_sequential_replay(spark, moves, piece_rows):
    rows = [(f"a{account}", seq, Decimal(amount)) for seq, (account, amount) in enumerate(moves)]
    df = spark.createDataFrame(rows, "account string, seq int, amount decimal(18,2)")
    out = running_balance(df, "account", ["seq"], "amount", "20", piece_rows=piece_rows).collect()
    expected = {
        (account, *line)
        for account in {r[0] for r in rows}
        for line in replay([(s, a) for k, s, a in rows if k == account], 20)
    }
    assert {(r.account, r.seq, r.accepted, r.balance) for r in out} == expected
    assert len(out) == len(rows)


def test_balance_of_the_worked_example(spark):
    df = spark.createDataFrame([("Ava", 1, 50.0), ("Ava", 2, -30.0), ("Ava", 3, -200.0)], "account string, seq int, amount double")
    out = running_balance(df, "account", ["seq"], "amount", opening="100").orderBy("seq").collect()
    assert [(r.accepted, int(r.balance)) for r in out] == [(True, 150), (True, 120), (False, 120)]


@pytest.mark.parametrize("pieces", [2, 16, 256])
def test_exact_median(spark, skewed, pieces):
    rows, df = skewed
    frame = pd.DataFrame(rows, columns=["k", "seq", "v"]).fillna({"k": "-"})
    out = exact_median(df, "v", ["k"], pieces=pieces).collect()
    assert {r.k or "-": r.median for r in out} == frame.groupby("k")["v"].median().to_dict()


def test_broadcast_only_when_measured_small(spark):
    small, large = spark.range(10), spark.range(1000)
    assert fits_broadcast(small, max_rows=10) and not fits_broadcast(large, max_rows=10)
    assert not fits_broadcast(small, max_rows=10, max_bytes=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hinted = large.join(broadcast_if_small(small, max_rows=10), "id")
        plain = small.join(broadcast_if_small(large, max_rows=10), "id")
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plain._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("piece_rows", [2, 100])
def test_null_account_on_both_sides_of_the_limit(spark, piece_rows):
    rows = spark.createDataFrame([(a, i, Decimal(v)) for a in (None, "x") for i, v in enumerate((5, -9, 4, -7, -2, 3))], "a string, i int, v decimal(18,2)")
    out = running_balance(rows, "a", ["i"], "v", piece_rows=piece_rows).collect()
    assert sorted((r.a or "", r.i, int(r.balance)) for r in out) == [(a, i, b) for a in ("", "x") for i, b in enumerate((5, 5, 9, 2, 0, 3))]


def test_moments_and_median_of_counted_values(spark, skewed):
    rows, df = skewed
    shifted = df.select("k", (F.col("v") + 1e9).alias("v")).unionByName(spark.createDataFrame([("k1", None), ("one", 5.0)], "k string, v double"))
    frame = pd.DataFrame(rows, columns=["k", "seq", "v"]).fillna({"k": "-"})
    groups = frame.assign(v=frame.v + 1e9).groupby("k")["v"]
    counts = value_counts(shifted, "v", ["k"])
    out = {r.k or "-": r for r in weighted_moments(counts, "v", ["k"]).collect()}
    for k, values in groups:
        assert out[k].mean == pytest.approx(values.mean()) and out[k].sd_pop == pytest.approx(values.std(ddof=0), rel=1e-6, abs=1e-6)
        assert len(values) == 1 or out[k].sd_samp == pytest.approx(values.std(), rel=1e-6)
    assert out["one"].sd_samp is None and out["one"].sd_pop == 0
    middle = {r.k or "-": r.median for r in median_of_counts(counts, "v", ["k"], "n", pieces=16).collect()}
    assert {k: v for k, v in middle.items() if k != "one"} == groups.median().to_dict()


def test_sums_behind_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 7, 2), (1, 8, 3), (2, 7, 5), (3, None, 11), (None, 8, 13)], "o int, p int, v int")
    orders = spark.createDataFrame([(1, "ann"), (2, "bob"), (4, "eve")], "o int, who string")
    parts = spark.createDataFrame([(7, "red"), (8, None)], "p int, colour string")
    people = spark.createDataFrame([("ann", "north")], "who string, region string")
    steps = [Step("o", orders, "o", ("who",)), Step("p", parts, "p", ("colour",)), Step("who", people, "who", ("region",))]
    got = sum_through(fact, {"s": F.col("v"), "n": F.lit(1)}, steps).collect()
    assert {(r.region, r.colour, r.s, r.n) for r in got} == {("north", "red", 2, 1), ("north", None, 3, 1), (None, "red", 5, 1), (None, None, 24, 2)}
    inner = sum_through(fact, {"s": F.col("v")}, [Step("o", orders, "o", ("who",), "inner")]).collect()
    assert {(r.who, r.s) for r in inner} == {("ann", 5), ("bob", 5)}


def test_last_year_is_the_year_before(spark):
    rows = spark.createDataFrame([(2020, "a", 10), (2021, "a", 15), (2023, "a", 30), (2021, None, 4), (2022, None, 2)], "y int, p string, v int")
    got = {(r.y, r.p, r.previous_year, r.yoy_change, r.yoy_pct) for r in year_over_year(rows, "v", "y", ["p"]).collect()}
    assert got == {(2020, "a", None, None, None), (2021, "a", 10, 5, 0.5), (2023, "a", None, None, None), (2021, None, None, None, None), (2022, None, 4, -2, -0.5)}


@pytest.mark.parametrize("piece_rows", [10, 1000])
def test_pieces_follow_the_order_without_a_range_sample(spark, monkeypatch, piece_rows):
    draw = random.Random(4)
    # One value fills most of the first column, texts differ only behind a long common beginning, and there are nulls.
    rows = [("hot", draw.choice([1.5, 1.5, 1.5, 2.5, None]), f"{'long common beginning ' * (i % 2)}{draw.randrange(400)}", i) for i in range(3000)]
    rows += [("same", 7.0, "x", i) for i in range(40)] + [(None, float(i), None, i) for i in range(30)] + [("few", 1.0, "y", 1)]
    frame = spark.createDataFrame(rows, "k string, a double, b string, i int").repartition(5)
    monkeypatch.setattr(type(frame), "repartitionByRange", lambda *a: (_ for _ in ()).throw(AssertionError("sampled")))
    collected = []
    plain = type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: collected.append(r := plain(self)) or r)
    out = in_pieces(frame, ["k"], ["a", "b"], piece_rows)
    monkeypatch.undo()
    assert all(len(r) == 1 for r in collected) and len(collected) < 60  # some numbers a step
    got = {}
    for r in out.collect():
        got.setdefault((r.k, r._piece), []).append((r.a is not None, r.a or 0, r.b is not None, (r.b or "").encode(), r.i))
    assert sum(map(len, got.values())) == len(rows) and ("few", None) in got
    for key in ("hot", "same", None):
        pieces = sorted((p, v) for (k, p), v in got.items() if k == key and p is not None)
        assert all(max(x)[:4] < min(y)[:4] for (_, x), (_, y) in zip(pieces, pieces[1:]))
        assert all(len(v) <= piece_rows or len({x[:4] for x in v}) == 1 for _, v in pieces)


@pytest.mark.parametrize("piece_rows", [2, 100])
def test_balances_of_very_large_amounts(spark, piece_rows):
    big = Decimal(10) ** 20 + Decimal("0.01")
    moves = [(1, big), (2, -big - 1), (3, big), (4, -2 * big), (5, Decimal("-0.01"))]
    rows = spark.createDataFrame([("a", s, m) for s, m in moves], "a string, i int, v decimal(38,2)")
    out = running_balance(rows, "a", ["i"], "v", piece_rows=piece_rows).orderBy("i").collect()
    assert [(r.i, r.accepted, r.balance) for r in out] == replay(moves, 0)


def test_replay_hands_python_single_movements(spark):
    moves = [(s, Decimal(a)) for s, a in enumerate((5, -9, 4, -7, -2, 3, -1))]
    rows = spark.createDataFrame([(a, s, m, f"n{s}") for a in "xyz" for s, m in moves], "a string, i int, v decimal(18,2), note string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)  # batches end inside accounts
    try:
        out = running_balance(rows, "a", ["i"], "v", "3")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.a, r.i, r.note, r.accepted, r.balance) for r in out.collect())
        late = out.where("i = 6").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(a, s, f"n{s}", ok, b) for a in "xyz" for s, ok, b in replay(moves, 3)]
    assert {r.balance for r in late} == {replay(moves, 3)[-1][2]} and len(late) == 3
    assert plan.index("ArrowEvalPython") < plan.index("Generate")
