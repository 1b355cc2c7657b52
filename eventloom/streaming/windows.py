"""Closed windows of a stream, with the rows that came too late kept beside them.

Spark's own state counts the windows: a window is put out once, when the watermark (the latest event time of earlier
batches less the allowed delay) has passed its end, and rows of windows already closed are dropped. Those rows go to a
side output here, by the same rule over the same batches, so that every arrived row is counted or listed.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.streaming.ingest import Paths, append_parquet, batch_folder, for_each_batch, windowed_counts


def _seen_before(spark: SparkSession, path: str, batch_id: int) -> datetime.datetime | None:
    """The latest event time of all batches before this one; each batch stores it, so one row is read."""
    try:
        return spark.read.parquet(batch_folder(path, batch_id - 1)).first().seen
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def keep_late(paths: Paths, time: str, width: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Handler that stores each batch's rows without a time, and those whose window the watermark had closed.

    It needs every batch, empty ones too. Running a batch again replaces what it stored.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _seen_before(spark, paths.seen, batch_id)
        closed = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        timed = batch.where(F.col(time).isNotNull()).withColumn("_window", F.window(time, width))
        late = timed.where(F.col("_window.end") <= closed).drop("_window").withColumn("reason", F.lit("window closed"))
        untimed = batch.where(F.col(time).isNull()).withColumn("reason", F.lit("no event time"))
        late.unionByName(untimed).write.mode("overwrite").parquet(batch_folder(paths.late, batch_id))
        seen = F.greatest(F.max(F.col(time).cast("timestamp")), F.lit(before).cast("timestamp")).alias("seen")
        batch.agg(seen).write.mode("overwrite").parquet(batch_folder(paths.seen, batch_id))

    return handle


def run_windows(
    read: Callable[[], DataFrame], paths: Paths, time: str, width: str, by: list[str], delay: str
) -> list[StreamingQuery]:
    """Take what has arrived: closed windows are appended to ``paths.closed``, late rows to ``paths.late``.

    Both queries keep their own checkpoints and continue from them. ``read`` gives the stream; as long as each run is one
    batch for both (no limit of files a batch), they see the same batches and so the same watermarks.
    """
    counts = windowed_counts(read(), time, width, by, delay)
    closing = append_parquet(counts, paths.closed, paths.closed_marks)
    sorting = for_each_batch(read(), keep_late(paths, time, width, delay), paths.late_marks, skip_empty=False)
    for running in (closing, sorting):
        running.awaitTermination()
    return [closing, sorting]
