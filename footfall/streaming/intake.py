"""Messages: key = user id as text, value = one JSON object with the five event fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schemas import MESSAGE, RAW

TOPIC = "user_behavior"


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of one topic; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.options(**(options or {})).load()


def file_messages(
    spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same messages from files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def encode_messages(raw: DataFrame) -> DataFrame:
    """Raw events as keyed messages (batch or stream)."""
    return raw.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*RAW.names), {"ignoreNullFields": "false"}).alias("value"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Message values (text or bytes) as event columns plus ``event_time``.

    A value that is not JSON gives a row of nulls, a field of the wrong type a null field.
    """
    event = F.from_json(F.col("value").cast("string"), RAW).alias("event")
    return messages.select(event).select("event.*").withColumn(
        "event_time", F.timestamp_seconds("timestamp")
    )


def write_messages(raw: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send a table of raw events as messages to a topic, or to files for a replay.

    For Kafka pass ``**{"kafka.bootstrap.servers": ..., "topic": ...}``; for files ``path``.
    """
    encode_messages(raw).write.format(fmt).options(**options).mode("append").save()
