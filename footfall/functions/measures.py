"""Behaviour counts and ratios.

Every analysis that only needs counts accepts either the detail relation (one row per event,
with a ``behavior`` column) or a stored daily summary (one row per key and day, with
``<behavior>_count`` columns). :func:`amount` is the single place where the two differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEHAVIORS = ("pv", "fav", "cart", "buy")


def is_summary(rel: DataFrame) -> bool:
    return "behavior" not in rel.columns


def count_name(behavior: str) -> str:
    return f"{behavior}_count"


def amount(rel: DataFrame, behavior: str) -> Column:
    """How many events of ``behavior`` a row of ``rel`` stands for."""
    if is_summary(rel):
        return F.col(count_name(behavior))
    return F.when(F.col("behavior") == behavior, F.lit(1).cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )


def having(rel: DataFrame, *behaviors: str) -> DataFrame:
    """Keep the rows that hold any of ``behaviors``; reaches the scan as a pushed filter."""
    if is_summary(rel):
        return rel.filter(reduce(or_, (F.col(count_name(b)) > 0 for b in behaviors)))
    return rel.filter(F.col("behavior").isin(*behaviors))


def behavior_counts(
    rel: DataFrame, *keys: str, behaviors: Sequence[str] = BEHAVIORS
) -> DataFrame:
    """Counts per behaviour for each key, in one partial + final aggregation.

    A summary that is already at this grain is passed through without a shuffle.
    """
    if is_summary(rel) and {c for c in rel.columns if not c.endswith("_count")} == set(keys):
        return rel.select(*keys, *(count_name(b) for b in behaviors))
    return rel.groupBy(*keys).agg(
        *(F.sum(amount(rel, b)).alias(count_name(b)) for b in behaviors)
    )


def ratio(num: Column, den: Column, places: int, scale: float = 1.0) -> Column:
    """``num * scale / den`` as DOUBLE rounded half up; null when ``den`` is zero or null."""
    return F.round(F.try_divide(num.cast("double") * F.lit(scale), den.cast("double")), places)


def percent(num: Column, den: Column, places: int = 2) -> Column:
    return ratio(num, den, places, 100.0)
