"""Joining per-key facts back to rows when a few keys may hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.session import cut_lineage

HOT_KEYS = 1000
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` up to the row bound; reads no more rows than the bound plus one."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, octets = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    return rows <= max_rows and (octets or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side measured to be small; otherwise leave the join to Spark."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def stored_small(df: DataFrame) -> DataFrame:
    """Compute an aggregate once, store it, and hint a broadcast if it proved small."""
    return broadcast_if_small(cut_lineage(df))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Key equality that also pairs null with null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def attach_per_key(
    rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str, values: list[str], hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Add the columns ``values`` of ``per_key`` (one row per key, ``weight`` = rows of that key) to every row.

    The heaviest ``hot_keys`` keys, a fixed number, are broadcast, so their rows need no partner from the
    shuffle and are spread over it by input partition. All other keys are joined by an ordinary shuffle.
    The spread uses the input partition number because it does not change when a task is run again.
    """
    # Both uses keep the weight, so they read the same columns and share one shuffle of the counts.
    fact = F.struct(*dict.fromkeys([*values, weight]))
    hot = per_key.orderBy(F.desc(weight), *keys).limit(hot_keys).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], fact.alias("_hot")
    )
    on_hot = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(hot[f"_hot_{k}"]) for k in keys])
    marked = rows.join(F.broadcast(hot), on_hot, "left").select(
        *[rows[c] for c in rows.columns],
        "_hot",
        F.when(F.col("_hot").isNotNull(), 1 + F.spark_partition_id()).otherwise(F.lit(0)).alias("_spread"),
    )
    rest = per_key.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], fact.alias("_fact"), F.lit(0).alias("_zero")
    )
    on_rest = reduce(lambda a, b: a & b, [marked[k].eqNullSafe(rest[f"_key_{k}"]) for k in keys])
    joined = marked.join(rest, on_rest & (marked["_spread"] == rest["_zero"]), "left")
    picked = F.coalesce("_hot", "_fact")
    return joined.select(*[marked[c] for c in rows.columns], *[picked[v].alias(v) for v in values])


def attach_groups(rows: DataFrame, per_group: DataFrame, keys: list[str], weight: str, values: list[str]) -> DataFrame:
    """Like ``attach_per_key`` for keys expected to be few: stored once, and broadcast whole if measured small."""
    per_group = cut_lineage(per_group)
    if not fits_broadcast(per_group):
        return attach_per_key(rows, per_group, keys, weight, values)
    side = per_group.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *values)
    match = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(side[f"_g_{k}"]) for k in keys])
    return rows.join(F.broadcast(side), match, "left").select(*[rows[c] for c in rows.columns], *values)
