"""Lazy DataFrame operators: cleaning, summaries, analyses and chart feeds."""

from footfall.operators.cleaning import clean, clean_audit, keep_first
from footfall.operators.conversion import behavior_funnel, user_path
from footfall.operators.customers import (
    repurchase_distribution,
    retention,
    rfm_summary,
    user_rfm,
)
from footfall.operators.quality import (
    behavior_share,
    has_rows,
    rows_per,
    table_profile,
    top_rows,
)
from footfall.operators.ranking import category_top_items, top_categories, top_items
from footfall.operators.summaries import (
    active_hours,
    daily_summary,
    day_activity,
    hourly_summary,
    user_days,
)
from footfall.operators.traffic import (
    daily_pv_uv,
    heatmap_hour_dow,
    hourly_distribution,
    weekday_vs_weekend,
)

__all__ = [
    "active_hours",
    "behavior_funnel",
    "behavior_share",
    "category_top_items",
    "clean",
    "clean_audit",
    "daily_pv_uv",
    "daily_summary",
    "day_activity",
    "has_rows",
    "heatmap_hour_dow",
    "hourly_distribution",
    "hourly_summary",
    "keep_first",
    "repurchase_distribution",
    "retention",
    "rfm_summary",
    "rows_per",
    "table_profile",
    "top_categories",
    "top_items",
    "top_rows",
    "user_days",
    "user_path",
    "user_rfm",
    "weekday_vs_weekend",
]
