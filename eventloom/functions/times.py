"""Timestamp helpers on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.text import has_content

ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2}(:?\d{2}(\.\d+)?)?)$"


def parse_time(text: Column) -> Column:
    """Timestamp in ``text``; null when it is none."""
    return F.try_to_timestamp(text)


def is_zoned_timestamp(text: Column) -> Column:
    """True for an ISO 8601 timestamp that states its offset."""
    has_zone = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ].*" + ZONE_SUFFIX)
    return F.coalesce(has_content(text) & has_zone & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def date_parts(day: Column, fiscal_start_month: int = 7) -> dict[str, Column]:
    """Calendar attributes of a date, by column name."""
    shifted = F.add_months(day, (13 - fiscal_start_month) % 12)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "week": F.weekofyear(day),
        "day_of_week": F.weekday(day) + 1,
        "is_weekend": F.weekday(day) >= 5,
        "fiscal_year": F.year(shifted),
        "fiscal_quarter": F.quarter(shifted),
    }
