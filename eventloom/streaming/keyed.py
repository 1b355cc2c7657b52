"""Keyed streams: idempotent upserts, per-key order, lag and load per partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.numbers import safe_ratio
from eventloom.operators.windows import latest_per_key
from eventloom.streaming.ingest import batch_folder
from eventloom.warehouse.changes import merge_upsert


def upsert_log(path: str, key: str, order: list[str], compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """Handler that stores the newest row per key of each batch in the folder of the batch.

    The work per batch grows with the batch, not with the table; running a batch again replaces its folder. With
    ``compact_every`` the log is compacted after each so many batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, [key], order).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_log(batch.sparkSession, path, key, order, batch_id)

    return handle


# Folders that begin with an underscore are no part of the log when its batches are listed.
def _snapshot(path: str, upto: int) -> str:
    return f"{path}/_snapshots/upto={upto}"


def published_snapshot(spark: SparkSession, path: str) -> int | None:
    """Last batch in the published snapshot. Only the small entries of the manifest are read."""
    try:
        return spark.read.schema("done boolean, upto bigint").json(f"{path}/_manifest").agg(F.max("upto")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _log_rows(spark: SparkSession, path: str) -> DataFrame:
    """The published snapshot and the batches after it, with the batch each row came in."""
    upto = published_snapshot(spark, path)
    log = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if upto is None:
        return log
    tail = log.where(F.col("batch_id") > upto)  # a folder name, so older batches are not opened
    return spark.read.schema(log.schema).parquet(_snapshot(path, upto)).unionByName(tail)


def compact_log(spark: SparkSession, path: str, key: str, order: list[str], upto: int) -> None:
    """Store the newest row per key of all batches up to ``upto`` and publish that as the snapshot.

    The snapshot goes to a folder of its own and its entry in the manifest is written last. A run that stops between
    the two leaves the older snapshot in force; the next compaction replaces the unpublished one. A batch that is
    replayed after its snapshot changes nothing, since the snapshot has its rows.
    """
    known = published_snapshot(spark, path)
    if known is not None and known >= upto:
        return
    newest = latest_per_key(_log_rows(spark, path).where(F.col("batch_id") <= upto), [key], [*order, "batch_id"])
    newest.write.mode("overwrite").parquet(_snapshot(path, upto))
    _publish(spark, path, upto)


def _publish(spark: SparkSession, path: str, upto: int) -> None:
    spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").json(f"{path}/_manifest/upto={upto}")


def current_rows(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """Table state of an upsert log: the newest row per key, later batches winning ties. Reads the snapshot and the tail."""
    return latest_per_key(_log_rows(spark, path), [key], [*order, "batch_id"]).drop("batch_id")


def merge_task(spark: SparkSession, table: str, delta: DataFrame, key: str, publish: Callable[[DataFrame], None]) -> bool:
    """Merge a delta into a table and publish the result, only if the delta has rows."""
    if delta.isEmpty():
        return False
    publish(merge_upsert(spark.table(table), delta, key))
    return True


def per_key_order(messages: DataFrame) -> DataFrame:
    """Messages in the order a consumer sees them: by partition and offset."""
    return messages.orderBy("topic", "partition", "offset")


def key_partitions(messages: DataFrame) -> DataFrame:
    """Partitions each key was written to; more than one means the order of that key is not kept."""
    pairs = messages.groupBy("key", "partition").agg(F.count("*").alias("n"))
    return pairs.groupBy("key").agg(
        F.count("*").alias("n_partitions"), F.min("partition").alias("partition"), F.sum("n").alias("n_messages")
    )


def key_load(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Heaviest key of each group and its share of the group's rows."""
    counts = rows.groupBy(group, key).agg(F.count("*").alias("n"))
    heaviest = F.max(F.struct("n", F.struct(F.col(key)).alias("k")))
    return counts.groupBy(group).agg(F.sum("n").alias("group_rows"), heaviest.alias("_h")).select(
        group, F.col(f"_h.k.{key}").alias("hot_key"), F.col("_h.n").alias("key_rows"), "group_rows",
        F.round(safe_ratio(F.col("_h.n"), F.col("group_rows")), 6).alias("share"),
    )


def lag_report(committed: DataFrame, ends: DataFrame, group: str) -> DataFrame:
    """Committed offset, end offset and lag per partition; a partition never read has its whole length as lag."""
    keys = ["topic", "partition"]
    mine = committed.where(F.col("group") == group).drop("group")
    position = F.coalesce("current_offset", F.lit(0))
    return ends.join(mine, keys, "left").select(
        F.lit(group).alias("group"), *keys, position.alias("current_offset"), "log_end_offset",
        (F.col("log_end_offset") - position).alias("lag"),
    )
