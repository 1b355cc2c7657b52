"""Masking, hashing and detection of personal data on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a value must look like to be reported as personal data.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9][0-9 ().-]{7,}[0-9]",
    "government_id": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}

PRIVILEGED_ROLE = "pii_reader"


def mask_email(value: Column, roles: tuple[str, ...] = ()) -> Column:
    """The value itself for a privileged role; otherwise everything before ``@`` is hidden."""
    if PRIVILEGED_ROLE in roles:
        return value
    return F.regexp_replace(value, ".+@", "***@")


def hash_token(value: Column, salt: str) -> Column:
    """One-way digest of a salted value."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


# A character every match must contain; looking for it first spares most texts the pattern.
_MARK = {"email": "@", "government_id": "-", "ip_address": "."}


def looks_like(value: Column, kind: str) -> Column:
    """Whether any part of the whole value matches."""
    found = value.rlike(PII_PATTERNS[kind])
    return value.contains(_MARK[kind]) & found if kind in _MARK else found
