"""Session settings shared by the batch and streaming jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(
    app_name: str = "footfall",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    adaptive: bool = True,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the settings every job relies on.

    The master is left to ``spark-submit`` unless given. With adaptive execution on,
    ``shuffle_partitions`` is only the starting point: Spark merges small shuffle partitions up
    to the advisory size and splits skewed ones, so on a cluster pass a generous number.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.sql.adaptive.enabled", str(adaptive).lower())
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(app_name: str = "footfall-stream", **kwargs) -> SparkSession:
    """A session for the windowed stream: few state partitions, fixed shuffle layout."""
    return session(app_name, **{"shuffle_partitions": 4, "adaptive": False, **kwargs})


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix=f"{label}-")
