"""Personal data, retention and access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.privacy import PII_PATTERNS, looks_like, mask_email
from eventloom.operators.skew import stored_small


def pii_scan(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values per column that look like each kind of personal data, in one pass over the whole texts."""
    checks = [(c, k, f"{c}__{k}") for c in columns for k in PII_PATTERNS]
    counts = df.agg(*[F.count_if(looks_like(F.col(c), k)).alias(n) for c, k, n in checks])
    found = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(n).alias("matches")) for c, k, n in checks])
    )
    return counts.select(found.alias("f")).select("f.*", (F.col("f.matches") > 0).alias("is_pii"))


def tag_column(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Same frame with the classification in the column's metadata."""
    return df.withMetadata(column, {"pii": kind})


def retained(df: DataFrame, time: str, as_of: Column, period: str) -> DataFrame:
    """Rows inside the retention period."""
    return df.where(F.col(time) >= as_of - F.expr(f"INTERVAL {period}"))


def expired(df: DataFrame, time: str, as_of: Column, period: str) -> DataFrame:
    """Rows due for deletion."""
    return df.where(F.col(time) < as_of - F.expr(f"INTERVAL {period}"))


def masked_view(df: DataFrame, column: str, roles: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumn(column, mask_email(F.col(column), roles))


def visible_rows(df: DataFrame, entitlements: DataFrame, role: str, column: str) -> DataFrame:
    """Rows whose ``column`` value the role is entitled to see."""
    allowed = stored_small(entitlements.where(F.col("role") == role).select(column).distinct())
    return df.join(allowed, column, "left_semi")


def tokenize(df: DataFrame, column: str, tokens: DataFrame) -> DataFrame:
    """Replace a value by its mapped token; ``tokens`` has ``value, token`` and allows the way back.

    Pass a stored token table, so that Spark can split the rows of a heavy value.
    """
    side = tokens.select(F.col("value").alias("_value"), "token")
    joined = df.join(side, F.col(column) == F.col("_value"), "left")
    return joined.select(*[F.col("token").alias(column) if c == column else df[c] for c in df.columns])
