"""Traffic over days, hours and weekdays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.measures import (
    BEHAVIORS,
    amount,
    behavior_counts,
    count_name,
    is_summary,
    ratio,
)
from footfall.operators.summaries import hourly_measures, merge_hours
from footfall.schemas import conform


def daily_pv_uv(
    rel: DataFrame,
    item_days: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Per day: page views, users of any behaviour, items viewed, page views per user.

    ``rel`` is the detail, or the stored user-day summary together with the item-day summary in
    ``item_days``. Users and items are first reduced to one row per day and then counted, each
    in its own branch; this ships the same pairs as two distinct counts would, without
    multiplying the input rows.
    """
    users = behavior_counts(
        clock.in_date_range(rel, start, end), "event_date", "user_id", behaviors=("pv",)
    )
    items = behavior_counts(
        clock.in_date_range(rel if item_days is None else item_days, start, end),
        "event_date",
        "item_id",
        behaviors=("pv",),
    )
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    viewed = F.when(F.col("pv_count") > 0, one).otherwise(zero)
    parts = users.select(
        "event_date", F.col("pv_count").alias("pv"), one.alias("uv"), zero.alias("item_count")
    ).unionAll(
        items.select("event_date", zero.alias("pv"), zero.alias("uv"), viewed.alias("item_count"))
    )
    days = parts.groupBy("event_date").agg(
        *(F.sum(c).alias(c) for c in ("pv", "uv", "item_count"))
    )
    return conform(
        days.withColumn("avg_pv_per_user", ratio(F.col("pv"), F.col("uv"), 2)),
        "ads.daily_pv_uv",
    ).orderBy("event_date")


def hourly_distribution(
    rel: DataFrame,
    user_hours: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Per hour of day: page views, users of any behaviour, carts, purchases.

    ``rel`` is the detail, or the stored hourly summary together with the users' active hours per
    day in ``user_hours``.
    """
    rel = clock.in_date_range(rel, start, end)
    sums = {"pv": "pv", "cart_count": "cart", "buy_count": "buy"}
    if is_summary(rel):
        named = rel.select("event_hour", *(F.col(count_name(b)).alias(m) for m, b in sums.items()))
        masks = clock.in_date_range(user_hours, start, end)
        hours = merge_hours(named, masks, users="uv", measures=list(sums))
    else:
        hours = hourly_measures(rel, users="uv", **{m: amount(rel, b) for m, b in sums.items()})
    return conform(hours, "ads.hourly_distribution").orderBy("event_hour")


def weekday_vs_weekend(
    rel: DataFrame,
    behaviors: Sequence[str] = BEHAVIORS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Per day type and behaviour: events, distinct users, events per user.

    Works on the detail, whose behaviours all appear, or on the user-day summary, which holds
    ``behaviors``. Reducing to one row per user, day type and behaviour first turns the distinct
    counts into plain counts.
    """
    rel = clock.in_date_range(rel, start, end)
    if "is_weekend" not in rel.columns:
        day = F.dayofweek(F.col("event_date").cast("date"))
        rel = rel.withColumn("is_weekend", clock.is_weekend(day))
    day_type = F.when(F.col("is_weekend") == 1, "weekend").otherwise("weekday").alias("day_type")
    if not is_summary(rel):
        users = rel.groupBy("is_weekend", "behavior", "user_id").agg(F.count("*").alias("n"))
        rows = users.groupBy(day_type, "behavior").agg(
            F.sum("n").alias("total_count"), F.count("*").alias("user_count")
        )
        return _per_user(rows)
    users = behavior_counts(rel, "is_weekend", "user_id", behaviors=behaviors)
    totals = users.groupBy("is_weekend").agg(
        *(F.sum(count_name(b)).alias(f"{b}_total") for b in behaviors),
        *(F.count_if(F.col(count_name(b)) > 0).alias(f"{b}_users") for b in behaviors),
    )
    rows = totals.select(
        day_type,
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(b).alias("behavior"),
                        F.col(f"{b}_total").alias("total_count"),
                        F.col(f"{b}_users").alias("user_count"),
                    )
                    for b in behaviors
                )
            )
        ),
    ).filter(F.col("total_count") > 0)
    return _per_user(rows)


def _per_user(rows: DataFrame) -> DataFrame:
    return conform(
        rows.withColumn("avg_per_user", ratio(F.col("total_count"), F.col("user_count"), 2)),
        "ads.weekday_vs_weekend",
    ).orderBy("day_type", "behavior")


def heatmap_hour_dow(
    rel: DataFrame,
    user_hours: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Per weekday and hour: events of any behaviour (``pv_count``), purchases, users.

    ``rel`` is the detail, or the stored hourly summary, whose behaviours are then all there are,
    together with the users' active hours per day in ``user_hours``.
    """
    rel = clock.in_date_range(rel, start, end)
    if is_summary(rel):
        dow = F.dayofweek(F.col("event_date").cast("date")).alias("day_of_week")
        every = reduce(add, (F.col(count_name(b)) for b in BEHAVIORS))
        sums = rel.select(dow, "event_hour", every.alias("pv_count"), "buy_count")
        masks = clock.in_date_range(user_hours, start, end).select(dow, "user_id", "hours")
        cells = merge_hours(
            sums, masks, "day_of_week", users="active_users", measures=["pv_count", "buy_count"]
        )
    else:
        cells = hourly_measures(
            rel,
            "day_of_week",
            users="active_users",
            pv_count=F.lit(1),
            buy_count=amount(rel, "buy"),
        )
    return conform(cells, "ads.heatmap_hour_dow").orderBy("day_of_week", "event_hour")
