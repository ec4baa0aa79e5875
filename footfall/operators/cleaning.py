"""Raw events to the cleaned detail relation, with an audit of what was removed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.measures import percent
from footfall.schemas import DETAIL, RAW, conform

# The behaviours that count, the dataset's day range, the identity of an event.
VALID_BEHAVIORS = ("pv", "cart", "fav", "buy")
DATE_START = "2017-11-25"
DATE_END = "2017-12-03"
EVENT_KEY = ("user_id", "item_id", "behavior", "timestamp")


def _rules(start: str, end: str, valid: Sequence[str], tz: str) -> dict[str, Column]:
    """Rejection rules in order; each is only meaningful where the earlier ones passed."""
    return {
        "null_removed": reduce(or_, (F.col(c).isNull() for c in RAW.names)),
        "behavior_removed": ~F.col("behavior").isin(*valid),
        "date_removed": ~clock.within_days(F.col("timestamp"), start, end, tz),
    }


def keep_first(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, whole: the one with the smallest ``order_by``, nulls last.

    Equal order values are decided by the other columns from left to right, so the survivor
    doesn't depend on the order of arrival. An aggregation rather than a row number: copies of a
    key are merged on the map side, so a key with very many copies never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys and c != order_by]
    row = F.struct(F.col(order_by).isNull().alias("last"), order_by, *rest)
    first = df.groupBy(*keys).agg(F.min(row).alias("first"))
    return first.select(*(F.col(c) if c in keys else F.col("first")[c].alias(c) for c in df.columns))


def clean(
    raw: DataFrame,
    start: str = DATE_START,
    end: str = DATE_END,
    valid: Sequence[str] = VALID_BEHAVIORS,
    tz: str = "UTC",
) -> DataFrame:
    """Drop incomplete, unknown and out-of-range events, remove duplicates, add time fields.

    Of events that differ in category only, the smallest category stays. The calendar fields
    are derived after the duplicates are gone, so only five narrow columns are shuffled.
    """
    accepted = raw.filter(F.col("behavior").isin(*valid)).filter(
        clock.within_days(F.col("timestamp"), start, end, tz)
    )
    for column in RAW.names:
        accepted = accepted.filter(F.col(column).isNotNull())
    distinct_events = accepted.groupBy(*EVENT_KEY).agg(F.min("category_id").alias("category_id"))
    local = distinct_events.withColumn("local", clock.local_time(F.col("timestamp"), tz))
    return conform(
        local.withColumns(
            {
                "event_time": F.col("local").cast("string"),
                "event_date": F.col("local").cast("date"),
                "event_hour": F.hour("local"),
                "day_of_week": F.dayofweek("local"),
                "is_weekend": clock.is_weekend(F.dayofweek("local")),
            }
        ),
        DETAIL,
    )


def clean_audit(
    raw: DataFrame,
    start: str = DATE_START,
    end: str = DATE_END,
    valid: Sequence[str] = VALID_BEHAVIORS,
    tz: str = "UTC",
    detail: DataFrame | None = None,
) -> DataFrame:
    """One row: raw, rows removed by each rule in order, final rows and keep rate in percent.

    Each row is charged to the first rule it breaks, in a single pass. The number of distinct
    events comes from the same aggregation, or from a written ``detail`` when one is given,
    which spares the shuffle.
    """
    reason = F.lit(None).cast("string")
    for name, broken in reversed(_rules(start, end, valid, tz).items()):
        reason = F.when(broken, name).otherwise(reason)
    tagged = raw.withColumn("reason", reason)
    accepted = F.col("reason").isNull()
    removed = [
        F.count_if(F.col("reason") == name).alias(name)
        for name in ("null_removed", "behavior_removed", "date_removed")
    ]
    if detail is None:
        final = F.count_distinct(*(F.when(accepted, F.col(c)) for c in EVENT_KEY))
        counts = tagged.agg(
            F.count("*").alias("raw"),
            *removed,
            F.count_if(accepted).alias("accepted"),
            final.alias("final"),
        )
    else:
        counts = tagged.agg(
            F.count("*").alias("raw"), *removed, F.count_if(accepted).alias("accepted")
        ).withColumn("final", detail.agg(F.count("*")).scalar())
    return counts.select(
        "raw",
        "null_removed",
        "behavior_removed",
        "date_removed",
        (F.col("accepted") - F.col("final")).alias("dedup_removed"),
        "final",
        percent(F.col("final"), F.col("raw")).alias("keep_rate"),
    )
