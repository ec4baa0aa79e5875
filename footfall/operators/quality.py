"""Checks on inputs and results: shares, profiles, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.measures import percent


def has_rows(df: DataFrame) -> bool:
    """True if there is a row; probes one row instead of counting."""
    return not df.isEmpty()


def rows_per(rel: DataFrame, *keys: str) -> DataFrame:
    """Row count per key."""
    return rel.groupBy(*keys).agg(F.count("*").alias("cnt"))


def behavior_share(raw: DataFrame) -> DataFrame:
    """Rows and percentage of all rows per behaviour, most frequent first.

    The total is a scalar subquery over the grouped counts: uncleaned input may hold any number
    of different behaviours, which a window over everything would bring into one task.
    """
    counts = rows_per(raw, "behavior")
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", percent(F.col("cnt"), total)).orderBy(
        F.desc("cnt"), "behavior"
    )


def table_profile(detail: DataFrame) -> DataFrame:
    """One row: rows, distinct users, items and categories, first and last date.

    One pass: every row gives one (column, value) pair per counted column, equal pairs merge on
    the map side, and what is left to count after the shuffle is one row per distinct value. The
    pairs carry the rows and the days they stand for, so nothing else has to be read.
    """
    ids = ("user_id", "item_id", "category_id")
    pair = [
        F.struct(F.lit(k).alias("which"), F.col(c).cast("bigint").alias("value"))
        for k, c in enumerate(ids)
    ]
    values = (
        detail.select(clock.day_number(F.col("event_date")).alias("day"), F.inline(F.array(*pair)))
        .groupBy("which", "value")
        .agg(F.count("*").alias("n"), F.min("day").alias("first"), F.max("day").alias("last"))
    )
    which, held = F.col("which"), F.col("value").isNotNull()
    return values.agg(
        F.coalesce(F.sum(F.when(which == 0, F.col("n"))), F.lit(0)).cast("bigint").alias("row_count"),
        *(
            F.count_if((which == k) & held).alias(c.replace("_id", "_count"))
            for k, c in enumerate(ids)
        ),
        clock.day_text(F.min("first")).alias("min_date"),
        clock.day_text(F.max("last")).alias("max_date"),
    )


def top_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in the given order; give a complete order to make it reproducible."""
    return df.orderBy(*order).limit(n)
