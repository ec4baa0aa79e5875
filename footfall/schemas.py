"""Table registry: the columns and types every job reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

LONG, INT, TEXT, REAL = LongType(), IntegerType(), StringType(), DoubleType()


def columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


_COUNTS = {"pv_count": LONG, "fav_count": LONG, "cart_count": LONG, "buy_count": LONG}

RAW = columns(user_id=LONG, item_id=LONG, category_id=LONG, behavior=TEXT, timestamp=LONG)
DETAIL = columns(
    user_id=LONG,
    item_id=LONG,
    category_id=LONG,
    behavior=TEXT,
    event_time=TEXT,
    event_hour=INT,
    day_of_week=INT,
    is_weekend=INT,
    event_date=TEXT,
)
MESSAGE = columns(key=TEXT, value=TEXT)
WINDOWED = columns(
    window_start=TimestampType(),
    window_end=TimestampType(),
    behavior=TEXT,
    count=LONG,
    unique_users=LONG,
)
LATE = columns(
    window_start=TimestampType(),
    window_end=TimestampType(),
    **{field.name: field.dataType for field in RAW},
)
EVENTS = columns(
    event_id=LONG, ts=TimestampNTZType(), user_id=LONG, event_type=TEXT, value=REAL, props=TEXT
)


def retention_columns(offsets: Sequence[int]) -> StructType:
    """The retention table with one rate per day offset."""
    return columns(first_date=TEXT, new_users=LONG, **{f"day_{n}": REAL for n in offsets})


TABLES: dict[str, StructType] = {
    "ods.user_behavior": RAW,
    "dwd.user_behavior_detail": DETAIL,
    "dws.user_daily_behavior": columns(user_id=LONG, event_date=TEXT, **_COUNTS),
    "dws.item_daily_behavior": columns(item_id=LONG, event_date=TEXT, **_COUNTS),
    "dws.category_daily_behavior": columns(category_id=LONG, event_date=TEXT, **_COUNTS),
    "dws.hourly_behavior": columns(event_date=TEXT, event_hour=INT, **_COUNTS, uv_count=LONG),
    # hours: the active hours of a user's day as bits
    "dws.activity": columns(
        event_date=TEXT, event_hour=INT, user_id=LONG, **_COUNTS, hours=INT, grain=TEXT
    ),
    "ads.daily_pv_uv": columns(
        event_date=TEXT, pv=LONG, uv=LONG, item_count=LONG, avg_pv_per_user=REAL
    ),
    "ads.hourly_distribution": columns(
        event_hour=INT, pv=LONG, uv=LONG, cart_count=LONG, buy_count=LONG
    ),
    "ads.behavior_funnel": columns(behavior=TEXT, user_count=LONG, ratio=REAL, overall_rate=REAL),
    "ads.top_items": columns(ranking=INT, item_id=LONG, **_COUNTS, total_score=REAL),
    "ads.top_categories": columns(
        ranking=INT, category_id=LONG, pv_count=LONG, buy_count=LONG, conversion_rate=REAL
    ),
    "ads.weekday_vs_weekend": columns(
        day_type=TEXT, behavior=TEXT, total_count=LONG, user_count=LONG, avg_per_user=REAL
    ),
    "ads.retention": retention_columns((1, 2, 3)),
    # frequency is a count and one user may exceed an INT
    "ads.user_rfm": columns(
        user_id=LONG,
        recency=INT,
        frequency=LONG,
        monetary=REAL,
        r_score=INT,
        f_score=INT,
        m_score=INT,
        segment=TEXT,
    ),
    "ads.rfm_summary": columns(
        segment=TEXT, user_count=LONG, avg_recency=REAL, avg_frequency=REAL, avg_monetary=REAL
    ),
    "ads.user_path": columns(
        from_behavior=TEXT, to_behavior=TEXT, path_count=LONG, path_ratio=REAL
    ),
    "ads.heatmap_hour_dow": columns(
        day_of_week=INT, event_hour=INT, pv_count=LONG, buy_count=LONG, active_users=LONG
    ),
    "ads.repurchase_distribution": columns(
        buy_times_bucket=TEXT,
        bucket_order=INT,
        user_count=LONG,
        user_ratio=REAL,
        total_buy=LONG,
        buy_contribution=REAL,
    ),
    "ads.category_top_items": columns(
        category_id=LONG,
        category_pv=LONG,
        item_id=LONG,
        item_pv=LONG,
        item_buy=LONG,
        rank_in_category=INT,
    ),
}

LAYERS = ("ods", "dwd", "dws", "ads")
PARTITIONED_BY = {"dwd.user_behavior_detail": ("event_date",), "dws.activity": ("grain",)}


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Select the schema's columns in order, cast to its types."""
    return df.to(TABLES[schema] if isinstance(schema, str) else schema)


def create_table_ddl(name: str, prefix: str = "") -> str:
    """``CREATE TABLE`` text for a registered table; ``prefix`` goes before its database."""
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name])
    parts = PARTITIONED_BY.get(name)
    clause = " OPTIONS (compression 'snappy', partitionOverwriteMode 'dynamic')"
    if parts:
        clause += f" PARTITIONED BY ({', '.join(parts)})"
    return f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({body}) USING parquet{clause}"
