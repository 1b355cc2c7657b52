"""Batch folders processed one at a time, in name order, each exactly once by effect."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.measures import count_by
from eventloom.sources.files import read_json_lines


def arrived_batches(spark: SparkSession, incoming: str, files: str = "*.jsonl") -> DataFrame:
    """Names of the ``batch_`` folders that hold JSON Lines files. Only the file listing is read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", files).load(incoming)
    )
    name = F.regexp_extract("path", r"/(batch_[^/]+)/[^/]+$", 1).alias("batch")
    return found.select(name).where(F.col("batch") != "").distinct()


def processed_batches(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger as a frame of batch names, empty before the first entry."""
    try:
        return spark.read.schema("done boolean, batch string").json(ledger).select("batch").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "batch string")


def mark_processed(spark: SparkSession, ledger: str, batch: str) -> None:
    """Record a batch once: its entry is a folder of its own, replaced when marked again."""
    entry = spark.range(1).select(F.lit(True).alias("done"))
    entry.coalesce(1).write.mode("overwrite").json(f"{ledger}/batch={batch}")


def next_batch(spark: SparkSession, incoming: str, ledger: str, files: str = "*.jsonl") -> str | None:
    """The smallest batch name without a ledger entry, or None."""
    waiting = arrived_batches(spark, incoming, files).join(processed_batches(spark, ledger), "batch", "left_anti")
    return waiting.agg(F.min("batch")).first()[0]


def summarize_folder(spark: SparkSession, folder: str, files: str = "*.jsonl") -> DataFrame:
    """Counts by type and source over all part files of a batch."""
    try:
        events = read_json_lines(spark, f"{folder}/{files}")
    except AnalysisException as error:
        raise ValueError(f"nothing to summarise: {folder} holds no file that matches {files}") from error
    return count_by(events, ["event_type", "source"])


def run_next_batch(
    spark: SparkSession, incoming: str, output: str, ledger: str, files: str = "*.jsonl"
) -> str | None:
    """Process one batch. The ledger moves only after the output is written, so a failed run is repeated whole."""
    batch = next_batch(spark, incoming, ledger, files)
    if batch is None:
        return None
    summary = summarize_folder(spark, f"{incoming}/{batch}", files)
    summary.write.mode("overwrite").option("header", True).csv(f"{output}/{batch}")
    mark_processed(spark, ledger, batch)
    return batch
