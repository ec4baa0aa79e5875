"""Daily and hourly behaviour summaries of the detail relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.measures import BEHAVIORS, amount, behavior_counts, count_name, is_summary
from footfall.schemas import conform

_TABLE_OF = {
    "user_id": "dws.user_daily_behavior",
    "item_id": "dws.item_daily_behavior",
    "category_id": "dws.category_daily_behavior",
}


def daily_summary(detail: DataFrame, key: str) -> DataFrame:
    """The four behaviour counts per ``key`` (user_id, item_id or category_id) and day."""
    return conform(behavior_counts(detail, key, "event_date"), _TABLE_OF[key])


def activity(detail: DataFrame, *keys: str, **measures: Column) -> DataFrame:
    """Summed ``measures`` per ``keys`` and hour, and per ``keys`` and user, in one pass.

    Rows of grain ``hour`` have no user. Rows of grain ``user`` have no hour of their own; the
    user's active hours are the bits of ``hours``, which merge by OR. Every event gives one row
    of each grain; those of an hour collapse on the map side, so the shuffle carries one row per
    user and key, not one per user, key and hour. Events without a user have no ``user`` rows.
    """
    nothing, no_hour, no_bits = F.lit(None).cast("bigint"), F.lit(None).cast("int"), F.lit(0)
    row = lambda grain, hour, user, bits: F.struct(
        F.lit(grain).alias("grain"),
        hour.alias("event_hour"),
        user.alias("user_id"),
        bits.cast("int").alias("bit"),
    )
    hour, user = F.col("event_hour").cast("int"), F.col("user_id").cast("bigint")
    grains = F.array(
        row("hour", hour, nothing, no_bits),
        row("user", no_hour, user, F.coalesce(F.expr("shiftleft(1, event_hour)"), no_bits)),
    )
    narrow = detail.select(
        *keys, *(column.cast("bigint").alias(name) for name, column in measures.items()), F.inline(grains)
    )
    return (
        narrow.filter((F.col("grain") == "hour") | F.col("user_id").isNotNull())
        .groupBy("grain", *keys, "event_hour", "user_id")
        .agg(*(F.sum(name).alias(name) for name in measures), F.bit_or("bit").alias("hours"))
    )


def _active_hours(hours: str) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.getbit(F.col(hours), h) == 1)


def merge_hours(
    sums: DataFrame, masks: DataFrame, *keys: str, users: str, measures: Sequence[str]
) -> DataFrame:
    """Hour rows ``sums`` and per-user masks of active hours as one row per ``keys`` and hour.

    Masks of one user and key are merged first, so that a user counts once in an hour; stored
    masks are one per user and day already and need no shuffle for that grain.
    """
    active = masks
    if "event_date" not in keys:
        active = masks.groupBy(*keys, "user_id").agg(F.bit_or("hours").alias("hours"))
    seen = active.select(*keys, F.explode(_active_hours("hours")).alias("event_hour"), F.lit(1).alias(users))
    return (
        sums.select(*keys, "event_hour", *measures)
        .unionByName(seen, allowMissingColumns=True)
        .groupBy(*keys, "event_hour")
        .agg(*(F.sum(name).alias(name) for name in (*measures, users)))
    )


def hourly_measures(
    detail: DataFrame, *keys: str, users: str, **measures: Column
) -> DataFrame:
    """Summed ``measures`` and distinct ``users`` per ``keys`` and hour of day, in one pass."""
    parts = activity(detail, *keys, **measures)
    of_hour = F.col("grain") == "hour"
    hours = F.when(of_hour, F.array("event_hour")).otherwise(_active_hours("hours"))
    spread = parts.select(
        *keys,
        *(F.when(of_hour, F.col(name)).alias(name) for name in measures),
        F.when(of_hour, 0).otherwise(1).alias(users),
        F.explode(hours).alias("event_hour"),
    )
    return spread.groupBy(*keys, "event_hour").agg(
        *(F.sum(name).alias(name) for name in (*measures, users))
    )


def day_activity(detail: DataFrame) -> DataFrame:
    """The four behaviour counts per day at both grains, with users' active hours: a stored table.

    The user rows are the user-day summary and the masks that hourly reports need; the hour rows
    are the sums of the hourly summary. One pass over the detail gives both.
    """
    counts = {count_name(b): amount(detail, b) for b in BEHAVIORS}
    return conform(activity(detail, "event_date", **counts), "dws.activity")


def user_days(stored: DataFrame) -> DataFrame:
    """The user-day summary out of the stored activity; no shuffle."""
    return conform(stored.filter(F.col("grain") == "user"), _TABLE_OF["user_id"])


def active_hours(stored: DataFrame) -> DataFrame:
    """(user_id, event_date, hours) out of the stored activity: the hours as bits; no shuffle."""
    return stored.filter(F.col("grain") == "user").select("user_id", "event_date", "hours")


def hourly_summary(rel: DataFrame) -> DataFrame:
    """The four behaviour counts and the distinct users per day and hour.

    ``rel`` is the detail, or the stored activity.
    """
    names = [count_name(b) for b in BEHAVIORS]
    if is_summary(rel):
        sums = rel.filter(F.col("grain") == "hour")
        hours = merge_hours(sums, active_hours(rel), "event_date", users="uv_count", measures=names)
    else:
        counts = {count_name(b): amount(rel, b) for b in BEHAVIORS}
        hours = hourly_measures(rel, "event_date", users="uv_count", **counts)
    return conform(hours, "dws.hourly_behavior")
