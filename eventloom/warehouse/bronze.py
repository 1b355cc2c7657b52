"""Bronze: raw payloads with load metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.streaming.ingest import Paths, batch_folder, for_each_batch


def load_bronze(
    lines: DataFrame, topic: str, run_id: str, text: str = "value", source_file: Column | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Bronze rows from JSON lines. The text is kept beside the variant, so malformed lines lose nothing."""
    return lines.select(
        F.try_parse_json(text).alias("raw_payload"),
        F.col(text).alias("raw_text"),
        (F.col("source_file") if source_file is None else source_file).alias("source_file"),
        F.lit(topic).alias("stream_topic"),
        F.lit(run_id).alias("ingest_run_id"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
    )


def append_bronze(
    spark: SparkSession, landing: str, paths: Paths, topic: str, run_id: str, loaded_at: Column | None = None
) -> None:
    """Append the lines of all files below ``landing`` that no earlier run has loaded, malformed lines included.

    The checkpoint below ``paths`` remembers the files, so a run that is repeated adds nothing and a later one adds the
    new files only. ``paths.rows`` has the bronze rows and ``paths.manifest`` a row for each file: lines, malformed
    lines, run and load time. Both are replaced when a run that broke off is continued, so neither gets ahead for good.
    """
    lines = spark.readStream.option("recursiveFileLookup", True).text(landing)
    lines = lines.select("value", F.col("_metadata.file_path").alias("source_file"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = load_bronze(batch, topic, run_id, loaded_at=loaded_at)
        rows.write.mode("overwrite").parquet(batch_folder(paths.rows, batch_id))
        stored = spark.read.schema(rows.schema).parquet(batch_folder(paths.rows, batch_id))
        stored.groupBy("source_file", "stream_topic", "ingest_run_id").agg(
            F.count("*").alias("lines"), F.count_if(F.col("raw_payload").isNull()).alias("malformed"), F.max("loaded_at").alias("loaded_at")
        ).write.mode("overwrite").parquet(batch_folder(paths.manifest, batch_id))

    for_each_batch(lines, handle, paths.marks).awaitTermination()
