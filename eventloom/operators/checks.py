"""Data tests. A test is a frame of failing rows or a one-row measurement; empty or ``passed`` means good."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values with their number of rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def accepted_values(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Values outside the list with their number of rows."""
    outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return outside.groupBy(column).agg(F.count("*").alias("n_rows"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child keys without a parent. Child keys are counted first, so a heavy key is one row in the join."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(field).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def outcome(name: str, failures: DataFrame, severity: str = "error") -> DataFrame:
    """One row: test, severity, failing rows, passed."""
    return failures.agg(F.count("*").alias("failures")).select(
        F.lit(name).alias("test"), F.lit(severity).alias("severity"), "failures", (F.col("failures") == 0).alias("passed")
    )


def report(outcomes: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, outcomes)


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Readable differences between a frame's schema and the contract; empty when it conforms."""
    types = {f.name: f.dataType.simpleString() for f in actual}
    found = [f"missing column {f.name}" for f in expected if f.name not in types]
    return found + [
        f"column {f.name} is {types[f.name]}, expected {f.dataType.simpleString()}"
        for f in expected
        if f.name in types and types[f.name] != f.dataType.simpleString()
    ]


def freshness(df: DataFrame, loaded_at: str, as_of: Column, limit: str) -> DataFrame:
    """One row: latest load, and whether it lies within ``limit`` (an interval) of ``as_of``."""
    return df.agg(F.max(loaded_at).alias("latest")).select(
        "latest", (F.col("latest") >= as_of - F.expr(f"INTERVAL {limit}")).alias("passed")
    )


def volume(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("passed", F.col("n_rows").between(low, high))


def missing_dates(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Expected dates for which no row arrived."""
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day")
    expected = df.sparkSession.range(1).select(days)
    arrived = df.select(F.to_date(column).alias("_arrived")).distinct()
    return expected.join(arrived, F.col("day") == F.col("_arrived"), "left_anti")


def error_rate(df: DataFrame, is_bad: Column, tolerance: float) -> DataFrame:
    rate = F.try_divide(F.count_if(is_bad), F.count("*"))
    return df.agg(F.count_if(is_bad).alias("bad"), F.count("*").alias("total"), F.round(rate, 6).alias("rate")).withColumn(
        "passed", F.col("rate") <= tolerance
    )


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: share of non-null values, in one pass over the data."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot(["_all"], columns, "column", "filled").select(
        "column", "filled", F.round(100 * F.try_divide("filled", "_all"), 4).alias("pct_filled")
    )


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def overlapping(intervals: DataFrame, with_next: str, valid_to: str, valid_from: str) -> DataFrame:
    """Validity windows that reach into the next one of their key."""
    following = F.col(with_next)[valid_from]
    return intervals.where(following.isNotNull() & (F.col(valid_to).isNull() | (following < F.col(valid_to))))


def one_row(**totals: tuple[DataFrame, Column]) -> DataFrame:
    """Several whole-frame totals side by side, without a join: each frame is reduced to one row first."""
    sides = [df.agg(total.alias("v")).select(F.lit(name).alias("k"), F.col("v")) for name, (df, total) in totals.items()]
    both = reduce(DataFrame.union, sides)
    return both.agg(*[F.max(F.when(F.col("k") == name, F.col("v"))).alias(name) for name in totals])


def reconcile_layers(bronze: DataFrame, silver: DataFrame, rejected: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Bronze rows must equal silver plus rejected plus dropped duplicates."""
    n = F.count("*")
    counts = one_row(bronze=(bronze, n), silver=(silver, n), rejected=(rejected, n), duplicates=(duplicates, n))
    rest = F.col("bronze") - F.col("silver") - F.col("rejected") - F.col("duplicates")
    return counts.withColumn("unexplained", rest).withColumn("passed", rest == 0)


def reconcile_sums(
    raw: DataFrame, raw_amount: str, modelled: DataFrame, amount: str, tolerance: float = 0.01, exact: str = "decimal(38,2)"
) -> DataFrame:
    """Failing row when two totals differ by more than the tolerance; empty when they agree."""
    totals = one_row(
        raw_amount=(raw, F.sum(F.col(raw_amount).cast(exact))), modeled_amount=(modelled, F.sum(F.col(amount).cast(exact)))
    )
    return totals.where(F.abs(F.col("raw_amount") - F.col("modeled_amount")) > tolerance)
