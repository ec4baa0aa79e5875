"""Readers: raw CSV, stored tables, result files, and the driver's event table."""

from footfall.sources.events import events_as_raw, event_key_columns
from footfall.sources.files import load_raw, read_layer, read_result_csv, split_rejects

__all__ = [
    "event_key_columns",
    "events_as_raw",
    "load_raw",
    "read_layer",
    "read_result_csv",
    "split_rejects",
]
