"""The generic ``events`` table seen as a clickstream.

``events`` has (event_id, ts, user_id, event_type, value, props); the item is the number in
``props`` and ten items share a category. Event types without a counterpart keep their name, so
cleaning rejects them like any other unknown behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schemas import EVENTS, RAW

BEHAVIOR_OF = {"view": "pv", "click": "fav", "signup": "cart", "purchase": "buy"}


def _behavior(event_type: Column) -> Column:
    named = event_type
    for code, behavior in BEHAVIOR_OF.items():
        named = F.when(event_type == code, behavior).otherwise(named)
    return named


def event_key_columns(events: DataFrame) -> DataFrame:
    """The raw event columns together with ``event_id``.

    The item is taken out of ``props`` by a generator, which parses each text once; as a plain
    expression it would be repeated in every filter and column that uses it.
    """
    return (
        events.select(
            "event_id",
            "user_id",
            F.json_tuple("props", "k").alias("k"),
            _behavior(F.col("event_type")).alias("behavior"),
            F.unix_timestamp("ts").alias("timestamp"),
        )
        .withColumn("item_id", F.col("k").try_cast("bigint"))
        .withColumn("category_id", F.expr("item_id div 10"))
        .drop("k")
    )


def event_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the behaviour of each event, for reports that need nothing else."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.select(_behavior(F.col("event_type")).alias("behavior"))


def events_as_raw(
    spark: SparkSession,
    sf_dir: str,
    start: str | None = None,
    end: str | None = None,
    behaviors: Sequence[str] | None = None,
) -> DataFrame:
    """The ``events`` table of a data folder as raw clickstream rows.

    A closed range of UTC days and the behaviours of interest are compared with the stored
    columns, so that they reach the scan as pushed filters.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    if start:
        events = events.filter(F.col("ts") >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz"))
    if end:
        after = (F.date_add(F.lit(end).cast("date"), 1)).cast("timestamp_ntz")
        events = events.filter(F.col("ts") < after)
    if behaviors is not None:
        code_of = {b: code for code, b in BEHAVIOR_OF.items()}
        events = events.filter(F.col("event_type").isin([code_of.get(b, b) for b in behaviors]))
    return event_key_columns(events).select(*RAW.names)


def stream_events_as_raw(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same as a stream of files.

    The path is written as a pattern because a stream takes a folder or a pattern, and the table
    may be a folder of files or a single file.
    """
    reader = spark.readStream.schema(EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return event_key_columns(reader.parquet(f"{sf_dir}/events.parque[t]")).select(*RAW.names)
