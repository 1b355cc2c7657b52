"""Joins that keep or report unmatched rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.skew import broadcast_if_small
from eventloom.session import cut_lineage

UNKNOWN = "unknown"


def enrich(facts: DataFrame, lookup: DataFrame, on: Column | str | list[str], attributes: list[str]) -> DataFrame:
    """All facts with the lookup's attributes; a fact without a match gets ``unknown``.

    No broadcast hint: Spark decides by the measured size of the lookup and splits skewed fact partitions.
    """
    kept = [facts[c] for c in facts.columns]
    return facts.join(lookup, on, "left").select(
        *kept, *[F.coalesce(lookup[a], F.lit(UNKNOWN)).alias(a) for a in attributes]
    )


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Column | str | list[str], how: str = "left") -> DataFrame:
    """Map-side lookup: the lookup is broadcast when measured small, and joined by shuffle otherwise."""
    return facts.join(broadcast_if_small(lookup), on, how)


def star(fact: DataFrame, dimensions: list[tuple[DataFrame, Column]], columns: list[Column | str]) -> DataFrame:
    """Fact joined to each of its dimensions, keeping facts without a partner."""
    return reduce(lambda left, side: left.join(side[0], side[1], "left"), dimensions, fact).select(*columns)


def outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """Right or full outer join in which a heavy key may be split on either side.

    Spark splits a skewed partition only on sides whose unmatched rows it need not keep. So matches come from an
    inner join, and the unmatched rows of each side from an anti join against the stored distinct keys of the
    other.
    """
    def lonely(side: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
        keys = cut_lineage(other.select(F.col(other_key).alias("_other")).where("_other IS NOT NULL").distinct())
        return side.join(keys, F.col(key) == F.col("_other"), "left_anti")

    if how not in ("right", "full"):
        raise ValueError("how must be 'right' or 'full'")
    out = left.join(right, left[left_key] == right[right_key], "inner")
    out = out.unionByName(lonely(right, right_key, left, left_key), allowMissingColumns=True)
    if how == "full":
        out = out.unionByName(lonely(left, left_key, right, right_key), allowMissingColumns=True)
    return out


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def _repeated(counts: DataFrame, run: int = 1_000_000) -> DataFrame:
    """Each row ``_n`` times. A row with very many copies is first cut into runs that are spread over tasks."""
    columns = [c for c in counts.columns if c != "_n"]
    runs = counts.select("*", F.posexplode(F.expr(f"sequence(0L, (_n - 1) div {run}L)")).alias("_i", "_run"))
    size = F.least(F.lit(run).cast("long"), F.col("_n") - F.col("_run") * run)
    spread = runs.withColumn("_n", size).hint("rebalance", *columns[:1], "_run")
    return spread.select(*columns, F.explode(F.expr("array_repeat(1, CAST(_n AS INT))"))).select(*columns)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Duplicate-aware difference: a row that occurs m times left and n times right stays m - n times."""
    signed = left.withColumn("_s", F.lit(1)).unionAll(right.toDF(*left.columns).withColumn("_s", F.lit(-1)))
    return _repeated(signed.groupBy(*left.columns).agg(F.sum("_s").alias("_n")).where(F.col("_n") > 0))


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on both sides, once. Copies are removed before the join, so no group of copies is shuffled."""
    return left.distinct().intersect(right.distinct())


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``."""
    return left.distinct().subtract(right.distinct())


def subtract_keep_copies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that do not occur in ``right``; repeated rows of ``left`` stay repeated.

    Rows are counted before the join, so a group of copies is one row in the shuffle.
    """
    counts = _counted(left)
    right = right.toDF(*[f"_r_{c}" for c in left.columns]).distinct()
    same = reduce(lambda a, b: a & b, [counts[c].eqNullSafe(right[f"_r_{c}"]) for c in left.columns])
    return _repeated(counts.join(right, same, "left_anti"))
