"""SQL functions that can be called by name from Spark SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Other names under which a source is known.
SOURCE_NAMES = {"ios": "mobile", "android": "mobile", "website": "web", "browser": "web"}


def normalize_source(names: dict[str, str]) -> str:
    """Statement that defines ``normalize_source`` for these names; a name not among them is its own source."""
    quoted = ", ".join("'" + text.replace("'", "\\'") + "'" for pair in names.items() for text in pair)
    known = f"try_element_at(map({quoted}), lower(trim(name)))" if names else "CAST(NULL AS STRING)"
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION normalize_source(name STRING)
RETURNS STRING
RETURN coalesce({known}, lower(trim(name)))
"""


# Table function: one row per element of a JSON array, in array order.
FLATTEN_ITEMS = """
CREATE OR REPLACE TEMPORARY FUNCTION flatten_items(input STRING, items_path STRING)
RETURNS TABLE(index INT, value VARIANT)
RETURN SELECT pos, col
       FROM posexplode(try_variant_get(try_parse_json(input), items_path, 'array<variant>'))
"""


def register(spark: SparkSession, names: dict[str, str] = SOURCE_NAMES) -> None:
    """Make the functions available in the session; inlined by the optimizer, so no Python runs.

    ``names`` maps other names (lower case) to sources, so that each team can bring its own list.
    """
    for statement in (normalize_source(names), FLATTEN_ITEMS):
        spark.sql(statement)
