"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are costly to compute, such as parsed JSON fields.

    A filter on an ordinary computed column is moved below it, which repeats the computation for every mention
    in the filter. Columns that come out of a one-row table function stay where they are and are computed once.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _digest(seed: object, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_sample(df: DataFrame, key: str, share: float, seed: object = 0) -> DataFrame:
    """About ``share`` of the rows, chosen by a hash of the key: the same rows on every run and every cluster.

    The first 60 bits of the hash are compared as a number, so 0 keeps nothing and 1 keeps every row with a key.
    """
    if not 0 <= share <= 1:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    place = F.conv(F.left(_digest(seed, key), F.lit(15)), 16, 10).cast("bigint")
    return df.where(place < F.lit(int(share * 2**60)))


def seeded_pick(df: DataFrame, key: str, n: int, seed: object) -> DataFrame:
    """First ``n`` rows of a seeded shuffle; each task keeps only its own best ``n``."""
    return df.orderBy(_digest(seed, key), key).limit(n)
