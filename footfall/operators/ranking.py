"""Top items and categories. Equal scores are ordered by ascending id."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.measures import amount, behavior_counts, count_name, percent
from footfall.schemas import conform

# How much each behaviour adds to an item's score.
SCORE_WEIGHTS = {"pv": 1, "fav": 3, "cart": 5, "buy": 10}


def _best(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The k largest rows, numbered. Cut first, numbered after: only k rows meet in one task."""
    order = (F.desc(measure), F.asc(key))
    return df.orderBy(*order).limit(k).withColumn(
        "ranking", F.row_number().over(Window.orderBy(*order))
    )


def top_items(
    rel: DataFrame,
    k: int = 100,
    weights: Mapping[str, float] = SCORE_WEIGHTS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The k items with the highest weighted sum of behaviours."""
    items = behavior_counts(
        clock.in_date_range(rel, start, end), "item_id", behaviors=tuple(weights)
    )
    score = reduce(add, (F.col(count_name(b)) * F.lit(w) for b, w in weights.items()))
    return conform(
        _best(items.withColumn("total_score", score), "total_score", "item_id", k),
        "ads.top_items",
    ).orderBy("ranking")


def top_categories(
    rel: DataFrame, k: int = 20, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The k most viewed categories with purchases per 100 views (null without views)."""
    categories = behavior_counts(
        clock.in_date_range(rel, start, end), "category_id", behaviors=("pv", "buy")
    )
    best = _best(categories, "pv_count", "category_id", k)
    return conform(
        best.withColumn("conversion_rate", percent(F.col("buy_count"), F.col("pv_count"), 4)),
        "ads.top_categories",
    ).orderBy("ranking")


def category_top_items(
    detail: DataFrame,
    k_cat: int = 10,
    k_item: int = 5,
    category_days: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The k_item most viewed items in each of the k_cat most viewed categories.

    The category totals come from the category-day summary when one is given. The chosen
    categories filter the detail in one join that also carries their totals, so only their
    items are shuffled; the rank limit is applied before and after the shuffle.
    """
    detail = clock.in_date_range(detail, start, end)
    totals = (
        detail if category_days is None else clock.in_date_range(category_days, start, end)
    )
    chosen = (
        behavior_counts(totals, "category_id", behaviors=("pv",))
        .orderBy(F.desc("pv_count"), F.asc("category_id"))
        .limit(k_cat)
        .withColumnRenamed("pv_count", "category_pv")
    )
    items = (
        detail.join(chosen, "category_id")
        .groupBy("category_id", "category_pv", "item_id")
        .agg(
            F.sum(amount(detail, "pv")).alias("item_pv"),
            F.sum(amount(detail, "buy")).alias("item_buy"),
        )
    )
    within = Window.partitionBy("category_id").orderBy(F.desc("item_pv"), F.asc("item_id"))
    return conform(
        items.withColumn("rank_in_category", F.row_number().over(within)).filter(
            F.col("rank_in_category") <= k_item
        ),
        "ads.category_top_items",
    ).orderBy(F.desc("category_pv"), "category_id", "rank_in_category")
