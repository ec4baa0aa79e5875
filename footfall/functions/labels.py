"""Display labels and code lookups."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that appear in result rows.
BEHAVIOR_LABELS = {"pv": "浏览", "fav": "收藏", "cart": "加购", "buy": "购买"}
FUNNEL_LABELS = {"pv": "浏览(pv)", "fav": "收藏(fav)", "cart": "加购(cart)", "buy": "购买(buy)"}
DAY_TYPE_LABELS = {"weekday": "工作日", "weekend": "周末"}
SEGMENT_LABELS = (
    "重要价值客户",
    "重要发展客户",
    "重要保持客户",
    "重要挽留客户",
    "一般价值客户",
    "一般发展客户",
    "一般保持客户",
    "一般挽留客户",
)
# Repurchase buckets as (label, fewest purchases, most purchases or None).
REPURCHASE_BUCKETS = (
    ("1次（一次性买家）", 1, 1),
    ("2次（首次复购）", 2, 2),
    ("3-5次（活跃买家）", 3, 5),
    ("6-10次（高频买家）", 6, 10),
    ("11次以上（核心买家）", 11, None),
)
# Prefixes and words of the chart feeds.
PATH_SOURCE_PREFIX = "前序_"
PATH_TARGET_PREFIX = "后续_"
CATEGORY_PREFIX = "类目"
ITEM_PREFIX = "商品"
SCORE_WORD = "综合="
BOUGHT_WORD = " / 购买="


def relabel(code: Column, labels: Mapping[str, str]) -> Column:
    """Look a code up in a label map; codes without a label pass through."""
    lookup = F.create_map(*(F.lit(x) for x in chain.from_iterable(labels.items())))
    return F.coalesce(F.try_element_at(lookup, code), code)
