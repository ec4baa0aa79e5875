"""Event counts and approximate users per behaviour in sliding event-time windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from footfall.schemas import LATE, RAW, WINDOWED, conform


def windowed(
    events: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    length: str,
    slide: str,
    lateness: str,
) -> DataFrame:
    """``measures`` per sliding window of ``event_time`` and ``keys``, with the window's bounds.

    Measures that merge on the map side bring a frequent key to its state partition as a few
    partial rows only.
    """
    named = [measure.alias(name) for name, measure in measures.items()]
    span = F.window("event_time", length, slide).alias("span")
    grouped = events.withWatermark("event_time", lateness).groupBy(span, *keys).agg(*named)
    return grouped.withColumns(
        {f"window_{edge}": F.col(f"span.{edge}") for edge in ("start", "end")}
    ).drop("span")


def windowed_pv_uv(
    events: DataFrame,
    window: str = "30 seconds",
    slide: str = "10 seconds",
    watermark: str = "30 seconds",
) -> DataFrame:
    """Per window and behaviour: events and approximate distinct users, of a stream or a batch."""
    measures = {"count": F.count("*"), "unique_users": F.approx_count_distinct("user_id")}
    return conform(windowed(events, ["behavior"], measures, window, slide, watermark), WINDOWED)


def start_windowed(
    windows: DataFrame,
    checkpoint: str,
    fmt: str = "console",
    mode: str = "update",
    every: str | None = "10 seconds",
    name: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the windowed query.

    In update mode every batch emits the windows it changed, the last row of a window being
    its answer; in append mode, which file sinks need, a window is emitted once, when the
    watermark has passed it. ``every=None`` works off what is there and stops.
    """
    writer = windows.writeStream.outputMode(mode).format(fmt).options(**options)
    return _start(writer, checkpoint, every, name)


def start_versions(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Start the windowed query in update mode and write each batch's versions of its windows.

    Every batch has a folder of its own that a repeated batch writes again, so a restart leaves
    no doubles. :func:`latest_windows` reads the answer.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(windows.writeStream.outputMode("update").foreachBatch(write), checkpoint, every, name)


def latest_windows(
    spark: SparkSession, path: str, keys: Sequence[str] = ("window_start", "window_end", "behavior")
) -> DataFrame:
    """The last version of each window that :func:`start_versions` has written."""
    versions = spark.read.schema(StructType([*WINDOWED, StructField("batch", LongType())])).parquet(path)
    rest = [c for c in versions.columns if c not in keys and c != "batch"]
    last = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*keys, "last.*")


def start_with_late(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "30 seconds",
    slide: str = "10 seconds",
    watermark: str = "30 seconds",
    every: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """The windowed counts of a stream, and beside them the events that came too late for a window.

    One query emits both: the windows that a micro-batch has changed, and the batch's events once
    per window they belong to. An event whose window was not changed by its own batch has been
    dropped by the watermark; it is kept, under that window. So nothing has to be known about the
    watermark, and what is counted and what is late always add up to what has come. Each batch
    has folders of its own that a repeated batch writes again. :func:`latest_windows` reads the
    counts from ``<path>/windows``, :func:`late_events` the others.
    """
    span = F.window("event_time", window, slide)
    came = events.withWatermark("event_time", watermark).select(*RAW.names, span.alias("span"))
    came = came.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *RAW.names,
    ).filter(F.col("window_start").isNotNull())
    both = windowed_pv_uv(events, window, slide, watermark).unionByName(came, allowMissingColumns=True)

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # both parts of one run of the stateful plan
        changed = batch.filter(F.col("count").isNotNull())
        changed.select(*WINDOWED.names).write.mode("overwrite").parquet(f"{path}/windows/batch={number}")
        keys = changed.select("window_start", F.col("behavior").alias("counted"))
        same = [batch["window_start"] == keys["window_start"], batch["behavior"].eqNullSafe(keys["counted"])]
        # merged where they lie: a batch may change so many windows that they burden the driver
        late = batch.filter(F.col("count").isNull()).join(keys.hint("merge"), same, "left_anti")
        late.select(*LATE.names).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        batch.unpersist()

    return _start(both.writeStream.outputMode("update").foreachBatch(write), checkpoint, every, name)


def late_events(spark: SparkSession, path: str) -> DataFrame:
    """The late events that :func:`start_with_late` has kept, once per window that lacks them."""
    return spark.read.schema(LATE).parquet(f"{path}/late")


def _start(writer, checkpoint: str, every: str | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
