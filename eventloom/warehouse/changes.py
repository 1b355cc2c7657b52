"""Changing tables: upsert, change delta, row history, incremental rebuilds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.skew import broadcast_if_small, stored_small
from eventloom.operators.windows import latest_per_key, with_neighbour
from eventloom.session import cut_lineage


def _single(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with a key at most once; a repeated key stops the query."""
    one = F.when(F.count("*") == 1, F.any_value(F.struct(*rows.columns))).otherwise(
        F.raise_error(F.concat(F.lit(f"several rows for one {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    )
    return rows.groupBy(key).agg(one.alias("_row")).select("_row.*")


def merge_upsert(
    target: DataFrame, updates: DataFrame, key: str, order: list[str] | None = None, update: list[str] | None = None
) -> DataFrame:
    """Target with updates applied by key: matched rows take the ``update`` columns, others are inserted.

    Several updates of one key are first reduced to the newest by ``order``; without an order they stop the query.
    A null key is a key of its own. Which side a row comes from is told by a marker, never by its key.
    """
    update = update or [c for c in target.columns if c != key]
    newest = latest_per_key(updates, [key], order) if order else _single(updates, key)
    side = newest.select(F.col(key).alias("_key"), F.struct(*[c for c in target.columns]).alias("_new"), F.lit(True).alias("_arrived"))
    held = target.withColumn("_held", F.lit(True))
    joined = held.join(side, held[key].eqNullSafe(side["_key"]), "full")
    inserted, matched = F.col("_held").isNull(), F.col("_arrived").isNotNull()
    columns = []
    for name in target.columns:
        change = inserted | matched if name in update else inserted
        columns.append(F.when(change, F.col("_new")[name]).otherwise(held[name]).alias(name))
    return joined.select(*columns)


def change_delta(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that differ between two snapshots: after-image, ``action`` and ``is_update``.

    An update appears as a DELETE of the old image and an INSERT of the new one, both with ``is_update``. A null key
    is a key of its own.
    """
    columns = before.columns
    old = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"), F.lit(True).alias("_is"))
    same = reduce(lambda a, b: a & b, [F.col("_old")[c].eqNullSafe(F.col("_new")[c]) for c in columns])
    both = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full")
    was, now = F.col("_was").isNotNull(), F.col("_is").isNotNull()
    changed = both.where(~(was & now) | ~same)
    images = F.array_compact(
        F.array(
            F.when(was, F.struct(F.lit("DELETE").alias("action"), F.col("_old").alias("row"))),
            F.when(now, F.struct(F.lit("INSERT").alias("action"), F.col("_new").alias("row"))),
        )
    )
    return changed.select((was & now).alias("is_update"), F.explode(images).alias("_i")).select(
        "_i.row.*", F.col("_i.action").alias("action"), "is_update"
    )


def apply_delta(target: DataFrame, delta: DataFrame, key: str, update: list[str] | None = None) -> DataFrame:
    """Upsert the INSERT images of a delta; deleted keys are kept, as the merge statement has no delete branch."""
    inserts = delta.where(F.col("action") == "INSERT").drop("action", "is_update")
    return merge_upsert(target, inserts, key, update=update)


def history(
    versions: DataFrame, key: str, order: list[str], tracked: list[str], piece_rows: int = 1_000_000
) -> DataFrame:
    """Row history from dated versions: a row per change with ``valid_from, valid_to, is_current``.

    ``order`` starts with the version time. A key with a very long history is worked on in pieces.
    """
    seen = with_neighbour(versions, [key], order, tracked, "_before", -1, piece_rows)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_before")[c]) for c in tracked])
    changes = seen.where(F.col("_before").isNull() | ~same).drop("_before")
    ended = with_neighbour(changes, [key], order, [order[0]], "_after", 1, piece_rows)
    return ended.select(
        key, *tracked, F.col(order[0]).alias("valid_from"), F.col("_after")[order[0]].alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
    )


def snapshot_increment(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str], at: Column) -> DataFrame:
    """Next state of a history table: changed current rows are closed at ``at``, new versions are opened. A null key is a key of its own."""
    new = incoming.select(F.col(key).alias("_k"), F.struct(*tracked).alias("_new"), F.lit(True).alias("_arrived"))
    current = cut_lineage(current)  # read twice: open and closed rows
    open_rows = current.where("is_current").withColumn("_held", F.lit(True))
    joined = open_rows.join(new, open_rows[key].eqNullSafe(F.col("_k")), "full")
    same = reduce(lambda a, b: a & b, [open_rows[c].eqNullSafe(F.col("_new")[c]) for c in tracked])
    existed, arrived = F.col("_held").isNotNull(), F.col("_arrived").isNotNull()
    changed = arrived & (~existed | ~same)
    kept = F.struct(
        open_rows[key].alias(key), *[open_rows[c].alias(c) for c in tracked], open_rows["valid_from"].alias("valid_from"),
        F.when(existed & changed, at).alias("valid_to"), (~changed).alias("is_current"),
    )
    opened = F.struct(
        F.col("_k").alias(key), *[F.col("_new")[c].alias(c) for c in tracked], at.alias("valid_from"),
        F.when(F.lit(False), at).alias("valid_to"), F.lit(True).alias("is_current"),
    )
    images = F.array_compact(F.array(F.when(existed, kept), F.when(changed, opened)))
    closed = current.where("NOT is_current")
    return closed.unionByName(joined.select(F.explode(images).alias("_r")).select("_r.*"))


def publish_version(df: DataFrame, name: str, version: int) -> None:
    """Write a new version as its own table and point the view ``name`` at it.

    Readers see the old version until the view moves. The frame may read ``name``, which would be unsafe if the
    same files were overwritten.
    """
    table = f"{name}_v{version}"
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")


def incremental_rebuild(
    spark: SparkSession, source: DataFrame, build, path: str, changed: Column, partition: str = "event_date"
) -> None:
    """Rebuild only the partitions in which ``changed`` rows lie, from all source rows of those partitions.

    The affected partitions stay a frame (no list on the driver), broadcast when measured small, so the rows are
    not shuffled by partition. Only these partitions are overwritten, so a rerun gives the same table.
    """
    touched = stored_small(source.where(changed).select(partition).distinct())
    rows = source.join(touched, partition, "left_semi")
    build(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def rebuild_from_files(
    spark: SparkSession, source: str, build: Callable[[DataFrame], DataFrame], path: str, manifest: str, day: Column,
    partition: str = "event_date",
) -> list[str]:
    """Rebuild the partitions that new files of ``source`` touch; returns the files that were read for it.

    ``manifest`` keeps the first and last day of every file that was built. New files are those without an entry. Their
    days are the touched ones, and of the older files only those whose range holds a touched day are read again, so a
    run costs what arrived and what lies beside it. Entries are added after the partitions, so a run that stops is
    repeated whole. Rows without a day belong to no partition. File names come to the driver, as in any listing.
    """
    known = read_or_empty(spark, manifest, "file string, first date, last date")
    # Only the listing is read, not the files.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(source)
    listed = listed.select(F.col("_metadata.file_path").alias("file"))
    new = sorted(r.file for r in listed.join(known, "file", "left_anti").collect())
    if not new:
        return []
    # The new files' days, read once with the columns that the day needs.
    days = cut_lineage(spark.read.parquet(*new).select(F.col("_metadata.file_path").alias("file"), day.alias(partition)).distinct())
    touched = broadcast_if_small(days.select(partition).where(F.col(partition).isNotNull()).distinct())
    beside = known.join(touched, F.col(partition).between(F.col("first"), F.col("last")), "left_semi")
    files = sorted({*new, *[r.file for r in beside.select("file").collect()]})
    rows = spark.read.parquet(*files).withColumn(partition, day).join(touched, partition, "left_semi")
    build(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    ranges = days.groupBy("file").agg(F.min(partition).alias("first"), F.max(partition).alias("last"))
    ranges.write.mode("append").parquet(manifest)
    return files


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
