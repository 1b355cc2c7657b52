"""Tables that live as long as the work that needs them, and the size of buckets."""

from __future__ import annotations

import math
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import cut_lineage, scratch_path

# A join sorts a bucket of each table in one task; rows of narrow columns take a dozen times their bytes there.
BUCKET_BYTES = 16 * 1024 * 1024


class TableScope:
    """Names for tables that are dropped when the scope ends, whether or not the work succeeded.

    Results that read the tables are taken out with ``keep``, which stores them first.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.names = spark, []

    def __enter__(self) -> TableScope:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def table(self, kind: str) -> tuple[str, str]:
        """A new table name and a folder for it."""
        name = f"{kind}_{uuid.uuid4().hex}"
        self.names.append(name)
        return name, scratch_path(self.spark, name)

    @staticmethod
    def keep(df: DataFrame) -> DataFrame:
        return cut_lineage(df)


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows hold: texts by their length, other columns by the size of their type."""
    widths = []
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0)))
        else:
            widths.append(F.lit(8 if isinstance(field.dataType, T.AtomicType) else 64))
    return df.agg(F.sum(sum(widths, F.lit(0)).cast("long"))).first()[0] or 0


def bucket_count(*frames: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined: a power of two, so that the larger one's hold about ``bucket_bytes``."""
    return 2 ** max(0, math.ceil(math.log2(max(1, max(measured_bytes(f) for f in frames) / bucket_bytes))))
