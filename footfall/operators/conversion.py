"""Funnel coverage and behaviour transitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.labels import FUNNEL_LABELS
from footfall.functions.measures import BEHAVIORS, behavior_counts, count_name, percent
from footfall.schemas import conform


def _step_ratio(users: Column, before: Column) -> Column:
    share = F.round(F.try_divide(users.cast("double"), before.cast("double")) * 100, 2)
    return F.coalesce(share, F.lit(0.0))


def behavior_funnel(
    rel: DataFrame,
    stages: Sequence[str] = BEHAVIORS,
    labels: Mapping[str, str] = FUNNEL_LABELS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Users who ever showed each behaviour, relative to the previous and to the first stage.

    Coverage, not a sequence: a stage may exceed the one before it. Without users in the first
    stage there are no rows. One row per user is counted into one row of stage totals, which is
    then laid out as one row per stage, so no ordering or window over the stages is needed.
    """
    users = behavior_counts(
        clock.in_date_range(rel, start, end), "user_id", behaviors=stages
    )
    reached = users.agg(*(F.count_if(F.col(count_name(b)) > 0).alias(b) for b in stages))
    first = F.col(stages[0])
    rows = [
        F.struct(
            F.lit(labels.get(stage, stage)).alias("behavior"),
            F.col(stage).alias("user_count"),
            _step_ratio(F.col(stage), F.col(before)).alias("ratio"),
            _step_ratio(F.col(stage), first).alias("overall_rate"),
        )
        for stage, before in zip(stages, (stages[0], *stages[:-1]))
    ]
    return conform(reached.filter(first > 0).select(F.inline(F.array(*rows))), "ads.behavior_funnel")


def user_path(
    detail: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Counts of previous -> current behaviour per user, with the share within ``from``.

    Events of one user in the same second are taken in order of behaviour. Equal events of one
    second are merged before any window: a run of n of them is n - 1 transitions to itself.
    Windows are split by day, so a task orders at most one day of a user at a time; the first and
    last behaviour of each day then link the days of a user, whatever lies between them. All in
    one pass: steps within days collapse to their counts on the map side of the shuffle that
    carries the day ends.
    """
    at = F.col("event_time").cast("timestamp_ntz")
    runs = (
        clock.in_date_range(detail, start, end)
        .groupBy("user_id", at.alias("at"), "behavior")
        .agg(F.count("*").alias("events"))
        .withColumn("day", F.col("at").cast("date"))
    )
    in_day = Window.partitionBy("user_id", "day").orderBy("at", "behavior")
    runs = runs.withColumns(
        {"previous": F.lag("behavior").over(in_day), "next": F.lead("behavior").over(in_day)}
    )
    rows = runs.select(
        F.inline(
            F.array(
                _path_row(F.col("previous"), F.lit(1)),
                _path_row(F.col("behavior"), F.col("events") - 1),
                _path_row(F.lit(None), F.lit(0), user=F.col("user_id"), at=F.col("at")),
            )
        )
    )
    opens, closes, inside = F.col("opens"), F.col("closes"), F.col("inside")
    rows = rows.filter(F.when(inside, F.col("n") > 0).otherwise(opens | closes))
    kept = rows.groupBy(*(c for c in rows.columns if c != "n")).agg(F.sum("n").alias("n"))
    day_ends = Window.partitionBy("inside", "user_id").orderBy("at", "to_behavior")
    kept = kept.withColumn("before", F.lag("to_behavior").over(day_ends))
    # within a day a step has its own count; between days the first behaviour follows the last one
    source = F.when(inside, F.col("from_behavior")).when(opens, F.col("before"))
    edges = kept.select(
        source.alias("from_behavior"), "to_behavior", F.when(inside, F.col("n")).otherwise(1).alias("n")
    ).filter(F.col("from_behavior").isNotNull())
    counted = edges.groupBy("from_behavior", "to_behavior").agg(F.sum("n").alias("path_count"))
    leaving = F.sum("path_count").over(Window.partitionBy("from_behavior"))
    return conform(
        counted.withColumn("path_ratio", percent(F.col("path_count"), leaving)), "ads.user_path"
    ).orderBy("from_behavior", F.desc("path_count"), "to_behavior")


def _path_row(source: Column, n: Column, user: Column | None = None, at: Column | None = None) -> Column:
    """A step inside a day with its count, or, given the user and the time, the end of a day."""
    inside = user is None
    no, yes = F.lit(False), F.lit(True)
    return F.struct(
        F.lit(inside).alias("inside"),
        (F.lit(None).cast("bigint") if inside else user).alias("user_id"),
        (F.lit(None).cast("timestamp_ntz") if inside else at).alias("at"),
        (no if inside else F.col("previous").isNull()).alias("opens"),
        (no if inside else F.col("next").isNull()).alias("closes"),
        source.cast("string").alias("from_behavior"),
        F.col("behavior").alias("to_behavior"),
        F.when(source.isNotNull() if inside else yes, n).otherwise(0).cast("bigint").alias("n"),
    )
