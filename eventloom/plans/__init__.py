"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = (
    "aggregates", "joins", "layers", "layout", "measures", "quality", "rows", "scalars", "sets", "streams", "transfers",
    "windows",
)


def load_all() -> None:
    """Import every plan module, which registers its queries."""
    for module in MODULES:
        importlib.import_module(f"eventloom.plans.{module}")
