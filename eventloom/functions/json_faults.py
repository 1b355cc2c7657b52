"""Where and why a text is no JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fault_of(text: str | None) -> str | None:
    """Place and cause; null for no text. Values that only some parsers take (NaN, repeated keys) are named as such."""
    if text is None:
        return None
    try:
        json.loads(text)
    except json.JSONDecodeError as error:
        return f"invalid JSON at column {error.colno}: {error.msg}"
    except RecursionError:
        return "invalid JSON: nested too deeply"
    return "invalid JSON: NaN, Infinity or a repeated key"


@F.pandas_udf(T.StringType())
def json_fault(texts: pd.Series) -> pd.Series:
    """``fault_of`` for a column; give it the malformed texts only and null for all others, so that little is moved."""
    return texts.map(fault_of, na_action="ignore").astype(object).where(texts.notna(), None)
