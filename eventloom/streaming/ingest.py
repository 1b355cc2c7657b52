"""Incremental ingestion: validate a stream, keep raw, good and bad rows, and report each batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.contract import DEFAULT_CONTRACT, EVENT_SCHEMA, Contract
from eventloom.operators.quality import collect_errors


@dataclass(frozen=True)
class Paths:
    """Where one ingestion keeps its data."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def file_stream(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream, each taken once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def append_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet; the checkpoint makes a restart continue where it stopped."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def for_each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True,
    skip_empty: bool = True,
) -> StreamingQuery:
    """Run ``handle`` on every batch (that has rows), which is kept on executor disks meanwhile and so read once."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not (skip_empty and batch.isEmpty()):
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def batch_folder(path: str, batch_id: int | str) -> str:
    """Folder of one batch, readable as partition ``batch_id``; writing it again replaces it."""
    return f"{path}/batch_id={batch_id}"


def ingest_batch(paths: Paths, contract: Contract = DEFAULT_CONTRACT) -> Callable[[DataFrame, int], None]:
    """Handler that writes good rows, rejects with reasons, and one row of metrics per batch.

    Every write replaces its batch folder, so a batch that is run again leaves the same data. The judged
    batch is kept on executor disks between the writes.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = collect_errors(batch, contract).persist(StorageLevel.MEMORY_AND_DISK)
        broken = F.size("validation_errors") > 0
        good = judged.where(~broken).drop("validation_errors")
        bad = judged.where(broken).withColumn("reject_reason", F.array_join("validation_errors", "; "))
        try:
            good.write.mode("overwrite").parquet(batch_folder(paths.valid, batch_id))
            bad.drop("validation_errors").write.mode("overwrite").parquet(batch_folder(paths.rejected, batch_id))
            judged.agg(
                F.count("*").alias("input_rows"), F.count_if(~broken).alias("valid"), F.count_if(broken).alias("rejected")
            ).write.mode("overwrite").parquet(batch_folder(paths.metrics, batch_id))
        finally:
            judged.unpersist()

    return handle


def batch_counts(path: str, by: list[str]) -> Callable[[DataFrame, int], None]:
    """Handler that writes each batch's counts to the folder of the batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*by).agg(F.count("*").alias("event_count"))
        counts.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return handle


def observed(df: DataFrame, name: str, is_bad: Column) -> DataFrame:
    """Same rows; input and bad counts are reported with the query progress, once per finished batch."""
    return df.observe(name, F.count("*").alias("input_rows"), F.count_if(is_bad).alias("bad_rows"))


def log_line(batch_id: int, input_rows: int, valid: int, rejected: int) -> str:
    return f"ingest.batch batch_id={batch_id} input_rows={input_rows} valid={valid} rejected={rejected}"


def first_in_task(rows: DataFrame, key: str, most_keys: int = 1_000_000) -> DataFrame:
    """The first row of each key that a task meets, so that a hot key leaves a task as one row.

    Works on streams, where Spark has no aggregate before the state. A task forgets its keys after ``most_keys`` of them;
    repeats that get through are found by whatever follows.
    """
    place = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set = set()
        for batch in batches:
            new = []
            for value in batch.column(place).to_pylist():
                new.append(value not in met)
                met.add(value)
            yield batch.filter(pa.array(new, pa.bool_()))
            if len(met) > most_keys:
                met.clear()

    return rows.mapInArrow(run, rows.schema)


def drop_repeats(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """First event per key among those within ``delay`` of each other; the state is bounded by the delay.

    Repeats inside a task go before the shuffle to the state.
    """
    return first_in_task(stream, key).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, width: str, by: list[str], delay: str | None = None) -> DataFrame:
    """Counts per tumbling window and group; on a stream, ``delay`` says how late an event may come."""
    timed = events.withWatermark(time, delay) if delay else events
    counts = timed.groupBy(F.window(time, width), *by).agg(F.count("*").alias("event_count"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "event_count")


def by_version(events: DataFrame, readers: dict[int, Callable[[Column], Column]], payload: str = "payload") -> DataFrame:
    """Add ``fields`` read by the reader of the event's ``version`` (1 when absent); unknown versions give null."""
    version = F.coalesce(F.try_variant_get(payload, "$.version", "int"), F.lit(1))
    fields = F.coalesce(*[F.when(version == v, read(F.col(payload))) for v, read in readers.items()])
    return events.withColumn("version", version).withColumn("fields", fields)
