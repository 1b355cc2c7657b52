"""Silver: typed, standardised, one row per event; rejects kept apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import is_blank, normalise_code
from eventloom.functions.times import parse_time
from eventloom.operators.quality import Rule, first_error
from eventloom.operators.rows import computed_once
from eventloom.operators.windows import latest_per_key

SILVER_COLUMNS = (
    "event_id", "event_type", "entity_id", "event_ts", "event_date", "source", "payload",
    "stream_topic", "ingest_run_id", "loaded_at",
)


def typed(bronze: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Typed columns of a bronze frame; bad values are null and judged later."""
    raw = F.col("raw_payload")

    def text(key: str) -> Column:
        return F.try_variant_get(raw, f"$.{key}", "string")

    parsed = computed_once(
        bronze,
        {
            "event_id": text("event_id"),
            "event_type": normalise_code(text("event_type")),
            "entity_id": text(entity),
            "event_ts": parse_time(text("event_ts")),
            "source": normalise_code(text("source")),
            "payload": F.try_variant_get(raw, "$.payload", "variant"),
        },
    )
    kept = [c for c in ("raw_text", "source_file") if c in bronze.columns]
    return parsed.withColumn("event_date", F.to_date("event_ts")).select(*SILVER_COLUMNS, *kept)


def silver_rules() -> list[Rule]:
    return [
        ("missing event_id", is_blank(F.col("event_id"))),
        ("missing event_type", is_blank(F.col("event_type"))),
        ("invalid event_ts", F.col("event_ts").isNull()),
        ("missing source", is_blank(F.col("source"))),
        ("missing payload", F.col("payload").isNull()),
    ]


@dataclass(frozen=True)
class Silver:
    events: DataFrame
    rejected: DataFrame
    valid: DataFrame


def build_silver(bronze: DataFrame, order: list[str] | None = None, entity: str = "entity_id") -> Silver:
    """Valid rows reduced to the newest per event id, and rejected rows with the reason."""
    judged = typed(bronze, entity).withColumn("reject_reason", first_error(silver_rules()))
    valid = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = judged.where(F.col("reject_reason").isNotNull())
    newest = latest_per_key(valid, ["event_id"], order or ["loaded_at", "event_ts"])
    return Silver(newest.select(*SILVER_COLUMNS), rejected, valid)


def reject_log(rejected: DataFrame, source: str, detected_at: Column) -> DataFrame:
    """Rejected rows per reason and source, with the time they were found."""
    return rejected.groupBy("reject_reason", source).agg(F.count("*").alias("rejected_count")).withColumn(
        "detected_at", detected_at
    )


def staging_events(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Staging model: standard codes, typed time, and the two payload fields reports use."""
    return raw.select(
        "event_id",
        normalise_code(F.col("event_type")).alias("event_type"),
        "user_id",
        F.col("event_ts").alias("event_at"),
        normalise_code(F.col("source")).alias("source"),
        F.try_variant_get(payload, "$.page", "string").alias("page_path"),
        F.try_variant_get(payload, "$.amount", "decimal(12,2)").alias("purchase_amount"),
        "ingested_at",
    )
