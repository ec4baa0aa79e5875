"""Epoch seconds to local calendar fields, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKEND = (1, 7)  # dayofweek: 1 = Sunday ... 7 = Saturday


def local_time(epoch_seconds: Column, tz: str = "UTC") -> Column:
    """Wall-clock TIMESTAMP_NTZ in ``tz``.

    The zone offset is added to the seconds with ``from_utc_timestamp``, which resolves a constant
    zone once per task; ``convert_timezone`` looks it up for every row.
    """
    if tz != "UTC":
        epoch_seconds = F.unix_seconds(
            F.from_utc_timestamp(F.timestamp_seconds(epoch_seconds), tz)
        )
    return F.timestamp_add(
        "SECOND", epoch_seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def day_start(day: str, tz: str = "UTC", plus_days: int = 0) -> Column:
    """Epoch second at which ``day`` begins in ``tz``; folds to a literal in the plan."""
    midnight = F.date_add(F.lit(day).cast("date"), plus_days).cast("timestamp_ntz")
    return F.unix_timestamp(F.convert_timezone(F.lit(tz), F.lit("UTC"), midnight))


def within_days(epoch_seconds: Column, start: str, end: str, tz: str = "UTC") -> Column:
    """True inside the closed range of local days ``[start, end]``.

    Compared on the stored integer rather than on a formatted date, so that the range reaches
    the file scan as a pushed filter.
    """
    return (epoch_seconds >= day_start(start, tz)) & (epoch_seconds < day_start(end, tz, 1))


def is_weekend(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND), 1).otherwise(0)


def day_number(event_date: Column) -> Column:
    """A ``yyyy-MM-dd`` string as days since the epoch.

    An integer keeps min/max in hash aggregation, where a string would force a sort.
    """
    return F.unix_date(event_date.cast("date"))


def day_text(day: Column) -> Column:
    """The inverse of :func:`day_number`."""
    return F.date_from_unix_date(day).cast("string")


def in_date_range(df, start: str | None = None, end: str | None = None):
    """Optional closed range on the ``event_date`` partition column; prunes partitions."""
    if start is not None:
        df = df.filter(F.col("event_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("event_date") <= F.lit(end))
    return df
