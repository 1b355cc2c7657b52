"""Writing datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.contract import REJECT_COLUMNS
from eventloom.operators.measures import json_summary


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with header. ``single_file`` is for small reports only: it sends every row through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_partitioned(
    df: DataFrame, path: str, by: str = "event_date", mode: str = "overwrite", rows_per_file: int = 5_000_000
) -> None:
    """Parquet in one folder per value of ``by``; overwriting replaces the whole dataset.

    The rebalance hint gathers a small date into one file and splits a date that holds most of the data over
    many tasks; the cap on rows per file bounds file size.
    """
    writer = df.hint("rebalance", by).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(by).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite", path: str | None = None
) -> None:
    """Table hashed and sorted by ``key``; two such tables join on it without a shuffle. See ``tables.bucket_count``.

    Rows are dealt to their buckets first, so a bucket is one file and files do not grow with tasks times buckets.
    """
    writer = df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_rejects(bad: DataFrame, path: str, columns: tuple[str, ...] = REJECT_COLUMNS) -> None:
    """Rejected rows with their reason, ordered by id; blanks in the values are kept, as they may be the defect.

    All columns and the input partition take part in the order, so that rows which share an id, such as a blank
    one, and even equal rows spread over tasks.
    """
    rest = [c for c in columns if c != "event_id"]
    placed = bad.select(*columns, F.spark_partition_id().alias("_part"))
    ordered = placed.orderBy("event_id", *rest, "_part").select(*columns)
    writer = ordered.write.mode("overwrite").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json_summary(events: DataFrame, path: str, by: str = "event_type") -> None:
    """One JSON line with total events and events per type."""
    json_summary(events, by).write.mode("overwrite").text(path)


def write_text(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    """Text lines, one part file per partition."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")).write.mode(
        "overwrite"
    ).text(path)
