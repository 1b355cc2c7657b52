"""Message topics. The connector is a plug-in: any frame with the same columns may stand in for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.variants import decode

# Columns every topic frame has, whatever delivered it.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def topic_options(servers: str, topic: str, start: str = "earliest", pattern: bool = False) -> dict[str, str]:
    """Reader options: one topic, or all topics that match a pattern."""
    if start not in ("earliest", "latest"):
        raise ValueError("start must be 'earliest' or 'latest'")
    chosen = "subscribePattern" if pattern else "subscribe"
    return {"kafka.bootstrap.servers": servers, chosen: topic, "startingOffsets": start}


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = "earliest", pattern: bool = False) -> DataFrame:
    """Streaming topic frame; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, start, pattern)).load()


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming topic frame from JSON files of topic records, for replays and tests."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def decode_events(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Event columns of each message beside its topic coordinates."""
    event = decode(F.col("value"), schema).alias("event")
    return messages.select("topic", "partition", "offset", event).select("topic", "partition", "offset", "event.*")


def encode_events(events: DataFrame, key: str, topic: Column | str) -> DataFrame:
    """Message columns of each event: the key decides the partition, so events of one key stay in order."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*events.columns)).alias("value"), name.alias("topic")
    )


def write_topic(messages: DataFrame, servers: str) -> None:
    """Publish message columns, waiting for every replica; needs the Kafka connector."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save()


def topic_for_type(event_type: Column, prefix: str) -> Column:
    """One topic per event type."""
    return F.concat(F.lit(prefix + "."), event_type)


def partition_of(key: Column, partitions: int) -> Column:
    """Partition a key always goes to."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
