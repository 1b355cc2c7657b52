"""Event analytics as composable Spark DataFrame operators."""

from eventloom.session import build_session, cut_lineage, scratch_path

__all__ = ["build_session", "cut_lineage", "scratch_path"]
