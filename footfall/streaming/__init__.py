"""Structured Streaming: message intake, windowed counts, landing to files, monitoring."""

from footfall.streaming.intake import (
    decode_messages,
    encode_messages,
    file_messages,
    kafka_messages,
    write_messages,
)
from footfall.streaming.landing import (
    NumberedFiles,
    finish_landing,
    land_batches,
    land_numbered,
    read_numbered,
)
from footfall.streaming.monitor import (
    RunTotals,
    progress_totals,
    run_until_interrupted,
    stop_after_backlog,
)
from footfall.streaming.realtime import (
    late_events,
    latest_windows,
    start_versions,
    start_windowed,
    start_with_late,
    windowed_pv_uv,
)

__all__ = [
    "NumberedFiles",
    "RunTotals",
    "decode_messages",
    "encode_messages",
    "file_messages",
    "finish_landing",
    "kafka_messages",
    "land_batches",
    "land_numbered",
    "late_events",
    "latest_windows",
    "progress_totals",
    "read_numbered",
    "run_until_interrupted",
    "start_versions",
    "start_windowed",
    "start_with_late",
    "stop_after_backlog",
    "windowed_pv_uv",
    "write_messages",
]
