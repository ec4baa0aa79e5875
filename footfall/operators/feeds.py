"""Chart feeds: small relations shaped for drawing, derived from the analysis results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.labels import (
    BEHAVIOR_LABELS,
    BOUGHT_WORD,
    CATEGORY_PREFIX,
    DAY_TYPE_LABELS,
    ITEM_PREFIX,
    PATH_SOURCE_PREFIX,
    PATH_TARGET_PREFIX,
    SCORE_WORD,
    relabel,
)
from footfall.functions.measures import percent

# Behaviour order on the weekday chart.
PIVOT_ORDER = ("pv", "cart", "fav", "buy")


def _path_ends(labels: Mapping[str, str]) -> tuple[Column, Column]:
    return (
        F.concat(F.lit(PATH_SOURCE_PREFIX), relabel(F.col("from_behavior"), labels)),
        F.concat(F.lit(PATH_TARGET_PREFIX), relabel(F.col("to_behavior"), labels)),
    )


def sankey_nodes(path: DataFrame, labels: Mapping[str, str] = BEHAVIOR_LABELS) -> DataFrame:
    """The distinct ends of all transitions, prefixed by side."""
    source, target = _path_ends(labels)
    return path.select(source.alias("name")).union(path.select(target.alias("name"))).distinct()


def sankey_links(path: DataFrame, labels: Mapping[str, str] = BEHAVIOR_LABELS) -> DataFrame:
    """One link per transition: source, target, value."""
    source, target = _path_ends(labels)
    return path.select(
        source.alias("source"), target.alias("target"), F.col("path_count").alias("value")
    )


def transition_labels(
    path: DataFrame, n: int = 15, labels: Mapping[str, str] = BEHAVIOR_LABELS
) -> DataFrame:
    """The head of the transition table with ``from → to`` labels, bottom bar first."""
    order = (F.asc("from_behavior"), F.desc("path_count"), F.asc("to_behavior"))
    label = F.concat(
        relabel(F.col("from_behavior"), labels),
        F.lit(" → "),
        relabel(F.col("to_behavior"), labels),
    )
    head = path.orderBy(*order).limit(n)
    return head.select(
        F.row_number().over(Window.orderBy(*order)).alias("position"),
        label.alias("path"),
        "path_count",
        "path_ratio",
    ).orderBy(F.desc("position"))


def category_tree(items: DataFrame, k_item: int = 5) -> DataFrame:
    """One row per category with its ranked items nested below it (at most k_item)."""
    child = F.struct(
        F.col("rank_in_category").alias("rank"),
        F.concat(F.lit(ITEM_PREFIX), F.col("item_id")).alias("name"),
        F.col("item_pv").alias("value"),
    )
    return (
        items.filter(F.col("rank_in_category") <= k_item)
        .groupBy("category_id", "category_pv")
        .agg(F.sort_array(F.collect_list(child)).alias("ranked"))
        .orderBy(F.desc("category_pv"), "category_id")
        .select(
            F.concat(F.lit(CATEGORY_PREFIX), F.col("category_id")).alias("name"),
            F.col("category_pv").alias("value"),
            F.transform(
                "ranked", lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"))
            ).alias("children"),
        )
    )


def category_totals(items: DataFrame, n: int = 10) -> DataFrame:
    """The n largest categories of the category-item table, one row each."""
    return (
        items.groupBy("category_id")
        .agg(F.max("category_pv").alias("category_pv"))
        .orderBy(F.desc("category_pv"), "category_id")
        .limit(n)
    )


def heatmap_cells(heatmap: DataFrame, value: str = "buy_count") -> DataFrame:
    """Heat map as cells: hour on x, weekday from 0 on y, and the largest value for scaling."""
    largest = F.max(value).over(Window.partitionBy())  # at most 168 cells
    return heatmap.select(
        F.col("event_hour").alias("x"),
        (F.col("day_of_week") - 1).alias("y"),
        F.col(value).alias("value"),
        largest.alias("max_value"),
    ).orderBy("y", "x")


def heatmap_matrix(heatmap: DataFrame, value: str = "buy_count") -> DataFrame:
    """Heat map as a full 7 x 24 matrix, absent cells 0; one row per weekday."""
    axis = heatmap.sparkSession.range(1, 8).select(
        F.col("id").cast("int").alias("day_of_week"),
        F.lit(0).alias("event_hour"),
        F.lit(0).cast("bigint").alias("value"),
    )
    cells = heatmap.select("day_of_week", "event_hour", F.col(value).alias("value"))
    return (
        cells.unionByName(axis)
        .groupBy("day_of_week")
        .agg(
            *(
                F.sum(F.when(F.col("event_hour") == h, F.col("value")).otherwise(0)).alias(f"h{h}")
                for h in range(24)
            )
        )
        .orderBy("day_of_week")
    )


def weekday_pivot(
    comparison: DataFrame,
    value: str = "total_count",
    order: Sequence[str] = PIVOT_ORDER,
    labels: Mapping[str, str] = DAY_TYPE_LABELS,
) -> DataFrame:
    """One row per day type, one column per behaviour of ``order``; absent combinations 0.

    The columns are part of the plan, so behaviours beyond the usual ones are named in ``order``.
    """
    pivoted = comparison.groupBy("day_type").pivot("behavior", list(order)).agg(F.first(value))
    return pivoted.select(
        "day_type",
        relabel(F.col("day_type"), labels).alias("day_label"),
        *(F.coalesce(F.col(b), F.lit(0)).alias(b) for b in order),
    ).orderBy("day_type")


def share_of_total(df: DataFrame, label: str, value: str, places: int = 2) -> DataFrame:
    """A label/value relation with the total and each value's percentage of it.

    The total enters as a scalar subquery, so rows stay where they are.
    """
    total = df.agg(F.sum(value)).scalar()
    return df.select(
        F.col(label).alias("label"),
        F.col(value).alias("value"),
        total.alias("total"),
        percent(F.col(value), total, places).alias("share"),
    )


def rfm_sample(rfm: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """A repeatable random sample of buyers with a point size; all buyers if there are fewer.

    The order is that of a hash of user and seed, so any system with MD5 draws the same sample.
    """
    drawn = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":{seed}")))
    return (
        rfm.orderBy(drawn, "user_id")
        .limit(n)
        .select(
            "user_id",
            "recency",
            "frequency",
            "monetary",
            (F.col("monetary") * 3 + 10).alias("size"),
        )
    )


def category_conversion_feed(categories: DataFrame, n: int = 20) -> DataFrame:
    """Views against conversion for the n best categories, with the range of views."""
    whole = Window.partitionBy()  # at most n rows
    return (
        categories.orderBy("ranking")
        .limit(n)
        .select(
            "ranking",
            F.col("category_id").cast("string").alias("category"),
            "pv_count",
            "conversion_rate",
            F.min("pv_count").over(whole).alias("min_pv"),
            F.max("pv_count").over(whole).alias("max_pv"),
        )
        .orderBy("ranking")
    )


def top_items_feed(items: DataFrame, n: int = 20) -> DataFrame:
    """Ranked bars, lowest bar first, with axis and value labels."""
    return (
        items.filter(F.col("ranking") <= n)
        .select(
            "ranking",
            F.concat(
                F.lit("#"), F.col("ranking"), F.lit(f" {ITEM_PREFIX}"), F.col("item_id")
            ).alias("label"),
            F.concat(
                F.lit(SCORE_WORD),
                F.col("total_score").cast("bigint"),
                F.lit(BOUGHT_WORD),
                F.col("buy_count"),
            ).alias("value_label"),
            "total_score",
            "pv_count",
            "buy_count",
        )
        .orderBy(F.desc("ranking"))
    )


def retention_extremes(cohorts: DataFrame, column: str = "day_1") -> DataFrame:
    """One row: the cohorts with the highest and the lowest rate (the earlier one on a tie)."""
    rate, date = F.col(column), F.col("first_date")
    best = F.min_by(F.struct(date, rate), F.struct((-rate).alias("r"), date))
    worst = F.min_by(F.struct(date, rate), F.struct(rate.alias("r"), date))
    known = cohorts.filter(rate.isNotNull()).agg(best.alias("best"), worst.alias("worst"))
    return known.select(
        F.col("best.first_date").alias("best_date"),
        F.col(f"best.{column}").alias("best_rate"),
        F.col("worst.first_date").alias("worst_date"),
        F.col(f"worst.{column}").alias("worst_rate"),
    )


def repurchase_feed(distribution: DataFrame) -> DataFrame:
    """The two shares per repurchase bucket, in bucket order."""
    return distribution.select(
        "bucket_order", "buy_times_bucket", "user_ratio", "buy_contribution"
    ).orderBy("bucket_order")


def hourly_feed(hours: DataFrame) -> DataFrame:
    """Hourly series with an ``h:00`` axis label."""
    return hours.select(
        "event_hour",
        F.concat(F.col("event_hour"), F.lit(":00")).alias("hour_label"),
        "pv",
        "uv",
        "cart_count",
        "buy_count",
    ).orderBy("event_hour")
