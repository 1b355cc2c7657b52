"""Registered queries: each takes the given tables and returns one frame; most carry equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.session import scratch_path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The given tables as frames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        # Day boundaries and zoned timestamps are defined in UTC throughout.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


Plan = Callable[[Tables], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name, with the SQL that gives the same rows."""

    def register(plan: Plan) -> Plan:
        PLANS[plan.__name__] = plan
        if sql:
            ORACLES[plan.__name__] = sql
        return plan

    return register
