"""Gold: dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.contract import EVENT_CATEGORIES
from eventloom.functions.times import date_parts


def dim_date(days: DataFrame, column: str, fiscal_start_month: int = 7) -> DataFrame:
    """One row per day from the first to the last day in ``column``."""
    span = days.agg(F.to_date(F.min(column)).alias("a"), F.to_date(F.max(column)).alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    return calendar.select("date", *[c.alias(n) for n, c in date_parts(F.col("date"), fiscal_start_month).items()])


def event_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_CATEGORIES, "event_type string, event_category string")


def dim_event_type(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each event type seen, with its category; a type outside the mapping is ``other``."""
    return events.select("event_type").distinct().join(mapping, "event_type", "left").select(
        "event_type", F.coalesce("event_category", F.lit("other")).alias("event_category")
    )


def dim_entity(events: DataFrame, entity: str, time: str) -> DataFrame:
    return events.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count("*").alias("event_count")
    )


def fact_events(silver: DataFrame) -> DataFrame:
    """One row per valid event; the key is a 128-bit hash of the event id, so reruns give the same key."""
    return silver.select(
        F.md5("event_id").alias("event_key"), "event_id", "entity_id", "event_type", "event_date", "event_ts",
        "source", "ingest_run_id",
    )


def fact_domain(silver: DataFrame, event_type: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Facts of one event type with typed payload measures given as name -> (path, type)."""
    typed = [F.try_variant_get("payload", p, t).alias(n) for n, (p, t) in measures.items()]
    return silver.where(F.col("event_type") == event_type).select("event_id", "entity_id", "event_date", *typed)


def daily_mart(events: DataFrame, time: str, user: str = "user_id") -> DataFrame:
    return events.groupBy(F.date_trunc("day", time).cast("date").alias("event_date"), "event_type", "source").agg(
        F.count("*").alias("event_count"), F.count_distinct(user).alias("unique_users")
    )


def fact_dim_orphans(fact: DataFrame, dimension: DataFrame, key: str, dim_key: str, name: str) -> DataFrame:
    """Fact rows that a join to the dimension would lose; fact keys are counted before the join."""
    keys = fact.groupBy(key).agg(F.count("*").alias("n"))
    lost = keys.join(dimension.select(F.col(dim_key).alias("_d")), F.col(key) == F.col("_d"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lost_rows")).select(F.lit(name).alias("dimension"), "lost_rows")
