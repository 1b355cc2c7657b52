"""Text helpers on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode defines it, plus the four ASCII separators. Spark's trim
# removes spaces only.
WHITESPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


NOT_WHITESPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.regexp_replace(col, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def has_content(col: Column) -> Column:
    """At least one character that is not whitespace; null for null."""
    return col.rlike(NOT_WHITESPACE)


def is_blank(col: Column) -> Column:
    """Null, empty, or spaces only."""
    return col.isNull() | (F.length(F.trim(col)) == 0)


def is_empty(col: Column) -> Column:
    """Null or empty; spaces count as content."""
    return col.isNull() | (F.length(col) == 0)


def words(col: Column) -> Column:
    """Lower-cased whitespace-separated words as an array without empty entries."""
    return F.filter(F.split(F.lower(col), f"{WHITESPACE}+"), lambda w: w != "")


def normalise_code(col: Column) -> Column:
    return F.lower(F.trim(col))


def is_palindrome(col: Column) -> Column:
    """Same forwards and backwards, ignoring case and spaces."""
    plain = F.lower(F.replace(col, F.lit(" "), F.lit("")))
    return plain == F.reverse(plain)
