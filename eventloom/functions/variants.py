"""Semi-structured values: parse, navigate, type tests, flatten, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.text import has_content


def parse_json(text: Column, strict: bool = False) -> Column:
    """Variant in ``text``. Malformed text is null, or an error when ``strict``."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def path(value: Column, json_path: str, sql_type: str) -> Column:
    """Typed value at a path; null when absent or of another type."""
    return F.try_variant_get(value, json_path, sql_type)


def kind(value: Column) -> Column:
    """Type name of a variant: OBJECT<...>, ARRAY<...>, STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def is_number(value: Column) -> Column:
    """Integer or fraction, never a boolean."""
    return F.coalesce(kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def is_integer(value: Column) -> Column:
    """JSON integer; ``2.0`` is a fraction here, as it is in JSON libraries."""
    return F.coalesce(kind(value) == "BIGINT", F.lit(False))


def is_text(value: Column) -> Column:
    """String with at least one character that is not whitespace."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce((kind(value) == "STRING") & has_content(text), F.lit(False))


def get(value: Column, key: str) -> Column:
    """Sub-value under ``key`` as a variant; SQL null when the key is absent."""
    return F.try_variant_get(value, f"$.{key}", "variant")


def flatten(df: DataFrame, value: str, json_path: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per element of the array at ``json_path``; ``columns`` maps name -> (path, type)."""
    items = F.explode(F.try_variant_get(F.col(value), json_path, "array<variant>")).alias("_item")
    kept = [c for c in df.columns if c != value]
    return df.select(*kept, items).select(
        *kept, *[F.try_variant_get("_item", p, t).alias(name) for name, (p, t) in columns.items()]
    )


def decode(value: Column, schema: T.StructType) -> Column:
    """Struct in a message body of bytes."""
    return F.from_json(value.cast("string"), schema)


def encode(*columns: str) -> Column:
    """JSON text of the named columns."""
    return F.to_json(F.struct(*columns))
