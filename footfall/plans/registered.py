"""Named queries over a folder of driver tables.

Every query takes (spark, folder) and returns a DataFrame over the whole ``events`` table seen
as a clickstream (see :mod:`footfall.sources.events`), the ``orders_*`` queries over all order
lines (see :mod:`footfall.sources.orders`). The ``stored_*``, ``ods_*`` and ``stream_*`` queries
also write and read back tables or streams below a scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import operators as op
from footfall import sinks
from footfall.functions import clock
from footfall.operators import feeds
from footfall.operators.cleaning import VALID_BEHAVIORS
from footfall.schemas import EVENTS, RAW, TABLES
from footfall.session import scratch_dir
from footfall.sources import load_raw, read_layer, read_result_csv, split_rejects
from footfall.sources.events import (
    event_behaviors,
    event_key_columns,
    events_as_raw,
    stream_events_as_raw,
)
from footfall.sources.orders import orders_as_raw
from footfall.streaming import (
    decode_messages,
    encode_messages,
    file_messages,
    finish_landing,
    land_batches,
    land_numbered,
    late_events,
    latest_windows,
    read_numbered,
    start_versions,
    start_with_late,
    windowed_pv_uv,
)

Query = Callable[[SparkSession, str], DataFrame]

# The whole of the events table and of the order lines.
START, END = "2024-01-01", "2024-01-30"
ORDERS_START, ORDERS_END = "1995-01-01", "2001-08-01"
# Ranges that leave out the outer days, for the cleaning queries, whose feature the cut is.
CUT_START, CUT_END = "2024-01-02", "2024-01-29"
ORDERS_CUT_START, ORDERS_CUT_END = "1996-01-01", "2000-12-31"
# The events table has ten categories only.
K_CATEGORIES, K_ITEMS = 5, 3


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_raw(spark, folder)


def detail(
    spark: SparkSession, folder: str, start: str = START, end: str = END, valid=VALID_BEHAVIORS
) -> DataFrame:
    return op.clean(events_as_raw(spark, folder, start, end, valid), start, end, valid)


def over_raw(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: f(raw(spark, folder))


def over_detail(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: f(detail(spark, folder))


def over_orders(f: Callable[[DataFrame], DataFrame]) -> Query:
    """Run ``f`` over the cleaned order lines instead of the events."""
    whole = (ORDERS_START, ORDERS_END)
    return lambda spark, folder: f(op.clean(orders_as_raw(spark, folder, *whole), *whole))


def summaries_then(f: Callable[..., DataFrame], *keys: str) -> Query:
    """Run ``f`` over daily summaries instead of the detail."""
    return over_detail(lambda d: f(*(op.daily_summary(d, key) for key in keys)))


def dedup_survivor(spark: SparkSession, folder: str) -> DataFrame:
    """One event per user, item, behaviour and day: the one with the smallest event id."""
    events = event_key_columns(spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet"))
    day = clock.local_time(F.col("timestamp")).cast("date").cast("string")
    return op.keep_first(
        events.withColumn("event_date", day),
        ["user_id", "item_id", "behavior", "event_date"],
        "event_id",
    )


def category_items(d: DataFrame) -> DataFrame:
    return op.category_top_items(d, K_CATEGORIES, K_ITEMS)


def category_tree(d: DataFrame) -> DataFrame:
    """The nested feed with its children written as text, so that it can be compared."""
    child = lambda x: F.concat(x["name"], F.lit("="), x["value"])
    return feeds.category_tree(category_items(d), K_ITEMS).withColumn(
        "children", F.array_join(F.transform("children", child), ",")
    )


def stored_detail(spark: SparkSession, folder: str) -> str:
    root = scratch_dir(spark, "warehouse")
    sinks.save(detail(spark, folder), "dwd.user_behavior_detail", root)
    return root


def stored_hours(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Run ``f`` over the stored hourly summary and the users' active hours: one pass over the detail."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = scratch_dir(spark, "warehouse")
        sinks.save(op.day_activity(detail(spark, folder)), "dws.activity", root)
        activity = read_layer(spark, "dws.activity", root)
        return f(op.hourly_summary(activity), op.active_hours(activity))

    return query


def stored_partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the detail by day, read one week of it back, count rows per day."""
    root = stored_detail(spark, folder)
    week = read_layer(spark, "dwd.user_behavior_detail", root, "2024-01-08", "2024-01-14")
    return op.rows_per(week, "event_date")


def stored_day_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Write the detail, write one day of it again, and summarise the hours of the result."""
    root = stored_detail(spark, folder)
    day = op.clean(raw(spark, folder), "2024-01-10", "2024-01-10")
    sinks.save(day, "dwd.user_behavior_detail", root, replace_days_only=True)
    return op.hourly_summary(read_layer(spark, "dwd.user_behavior_detail", root))


def ods_csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """Write the raw events as headerless CSV, load them with the declared schema, share."""
    path = scratch_dir(spark, "raw-csv") + "/events"
    raw(spark, folder).write.csv(path)
    return op.behavior_share(load_raw(spark, path, drop_malformed=True))


def result_csv_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Export the daily result as CSV with a header and load it again."""
    path = scratch_dir(spark, "results") + "/daily_pv_uv"
    sinks.export_csv(op.daily_pv_uv(detail(spark, folder)), path, single_file=True)
    return read_result_csv(spark, path, "ads.daily_pv_uv")


def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Stream the events as messages through the windowed counts; the last version of each window."""
    out = scratch_dir(spark, "stream")
    events = decode_messages(encode_messages(stream_events_as_raw(spark, folder)))
    query = start_versions(
        windowed_pv_uv(events), f"{out}/windows", f"{out}/checkpoint", every=None
    )
    query.awaitTermination()
    return latest_windows(spark, f"{out}/windows")


def stream_pv_uv(spark: SparkSession, folder: str) -> DataFrame:
    """Events of every window and behaviour, also of windows still open at the end."""
    return stream_windows(spark, folder).select(
        F.unix_timestamp("window_start").alias("window_start_s"),
        F.unix_timestamp("window_end").alias("window_end_s"),
        "behavior",
        "count",
    )


def stream_uv_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a window's approximate users lie within 15 % of the exact number, for each window."""
    events = event_key_columns(spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet"))
    second = F.col("timestamp").cast("timestamp")
    exact = events.groupBy(F.window(second, "30 seconds", "10 seconds").alias("w"), "behavior").agg(
        F.count_distinct("user_id").alias("users")
    )
    exact = exact.select(F.col("w.start").alias("window_start"), "behavior", "users")
    near = F.abs(F.col("unique_users") - F.col("users")) <= 0.15 * F.col("users")
    return stream_windows(spark, folder).join(exact, ["window_start", "behavior"], "left").select(
        F.unix_timestamp("window_start").alias("window_start_s"),
        "behavior",
        F.when(near, 1).otherwise(0).alias("within"),
    )


def all_behaviors(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned events with a fifth behaviour accepted."""
    return detail(spark, folder, valid=(*VALID_BEHAVIORS, "error"))


def null_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of events whose items below 10 have lost their number."""
    events = raw(spark, folder)
    lost = F.when(F.col("item_id") >= 10, F.col("item_id"))
    return op.clean_audit(events.withColumn("item_id", lost), CUT_START, CUT_END)


def stream_batch_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stream the events as messages into CSV batch files and load those files."""
    out = scratch_dir(spark, "landing")
    events = decode_messages(encode_messages(stream_events_as_raw(spark, folder)))
    land_batches(events, f"{out}/files", f"{out}/checkpoint", every=None).awaitTermination()
    return load_raw(spark, f"{out}/files")


def message_files(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """The events as a stream of messages that come user group by user group, not in order of time."""
    events = encode_messages(raw(spark, folder))
    for group in range(3):
        of_group = F.pmod(F.col("key").cast("bigint"), F.lit(3)) == group
        events.filter(of_group).write.mode("append").json(f"{out}/messages")
    return decode_messages(file_messages(spark, f"{out}/messages", max_files_per_trigger=1))


def numbered_files(spark: SparkSession, folder: str, max_rows: int | None = None, runs: int = 1) -> str:
    """Land the messages as numbered files of at most 300 rows, in one or more runs."""
    out = scratch_dir(spark, "numbered")
    events = message_files(spark, folder, out)
    for _ in range(runs):
        query, files = land_numbered(events, f"{out}/files", f"{out}/checkpoint", 300, max_rows, every=None)
        finish_landing(query, files)
    return f"{out}/files"


def stream_numbered_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the numbered files."""
    return read_numbered(spark, numbered_files(spark, folder)).drop("batch")


def stream_file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of each numbered file: all but the last are full, though messages come in batches."""
    return op.rows_per(read_numbered(spark, numbered_files(spark, folder)), "batch")


def stream_row_limit(spark: SparkSession, folder: str) -> DataFrame:
    """Messages landed under a limit that two runs share."""
    landed = read_numbered(spark, numbered_files(spark, folder, max_rows=700, runs=2))
    return landed.agg(F.count("*").alias("taken"))


def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events counted in time and events kept as late, together, for each window and behaviour."""
    out = scratch_dir(spark, "late")
    query = start_with_late(
        message_files(spark, folder, out), f"{out}/result", f"{out}/checkpoint", every=None
    )
    query.awaitTermination()
    counted = latest_windows(spark, f"{out}/result/windows").select("window_start", "behavior", "count")
    late = late_events(spark, f"{out}/result").select("window_start", "behavior", F.lit(1).alias("count"))
    return (
        counted.union(late)
        .groupBy(F.unix_timestamp("window_start").alias("window_start_s"), "behavior")
        .agg(F.sum("count").alias("events"))
    )


def broken_lines(spark: SparkSession, folder: str) -> str:
    """The raw events as lines of text, four of ten of them broken in one of four ways."""
    path = scratch_dir(spark, "lines") + "/events"
    field = lambda c: F.col(c).cast("string")
    line = lambda *columns: F.concat_ws(",", *columns)
    user, item, category, behavior, time = map(field, RAW.names)
    kind = F.pmod(F.col("user_id") + F.col("timestamp"), F.lit(10))
    raw(spark, folder).select(
        F.when(kind == 0, line(user, item, category, behavior))
        .when(kind == 1, line(user, item, category, behavior, time, F.lit("x")))
        .when(kind == 2, line(user, F.lit("n/a"), category, behavior, time))
        .when(kind == 3, line(F.concat(F.lit("u"), user), item, category, behavior, F.lit("soon")))
        .otherwise(line(user, item, category, behavior, time))
    ).write.text(path)
    return path


def catalog_warehouse(spark: SparkSession, folder: str) -> str:
    """A warehouse in the session catalog; returns the prefix of its databases.

    The tables are created empty and typed; the detail is inserted by day, one day of it twice.
    """
    root = scratch_dir(spark, "catalog")
    prefix = f"w{root.rsplit('-', 1)[1][:12]}_"
    sinks.create_databases(spark, prefix, root)
    for name in TABLES:
        sinks.create_table(spark, name, prefix=prefix)
    name, cleaned = "dwd.user_behavior_detail", detail(spark, folder)
    sinks.save(cleaned, name, replace_days_only=True, prefix=prefix)
    one_day = op.clean(raw(spark, folder), "2024-01-10", "2024-01-10")
    sinks.save(one_day, name, replace_days_only=True, prefix=prefix)
    stored = read_layer(spark, name, prefix=prefix)
    sinks.save(op.daily_pv_uv(stored), "ads.daily_pv_uv", prefix=prefix)
    return prefix


def catalog_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Hours per day of the detail that was inserted into the catalog by day."""
    prefix = catalog_warehouse(spark, folder)
    return op.hourly_summary(read_layer(spark, "dwd.user_behavior_detail", prefix=prefix))


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog's tables with the rows they hold."""
    prefix = catalog_warehouse(spark, folder)
    counts = [
        spark.table(f"{prefix}{name}").select(F.lit(name).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
        for name in TABLES
    ]
    held = reduce(DataFrame.union, counts)
    listed = sinks.list_tables(spark, prefix).withColumn("name", F.concat_ws(".", "layer", "table"))
    return listed.join(held, "name", "left").select(
        "layer", "table", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count")
    )


def catalog_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The detail's columns in the catalog, with the number of values that each holds."""
    name = catalog_warehouse(spark, folder) + "dwd.user_behavior_detail"
    table = spark.table(name)
    filled = table.select(*(F.count(c).alias(c) for c in table.columns)).unpivot(
        [], table.columns, "col_name", "filled"
    )
    return sinks.describe(spark, name).join(filled, "col_name")


def result_csv_head(spark: SparkSession, folder: str) -> DataFrame:
    """Export the first rows of a long result as one CSV file and load it again."""
    path = scratch_dir(spark, "results") + "/user_rfm"
    result = rfm(detail(spark, folder))
    sinks.export_csv(result, path, head=20, order=("user_id",), single_file=True)
    return read_result_csv(spark, path, "ads.user_rfm")


def rfm(d: DataFrame) -> DataFrame:
    return op.user_rfm(d, END)


QUERIES: dict[str, Query] = {
    # load and clean
    "etl_behavior_share": lambda spark, folder: op.behavior_share(event_behaviors(spark, folder)),
    "etl_clean_audit": over_raw(lambda r: op.clean_audit(r, CUT_START, CUT_END)),
    "etl_null_audit": null_audit,
    "etl_detail": lambda spark, folder: detail(spark, folder, CUT_START, CUT_END),
    "etl_rows_per_day": lambda spark, folder: op.rows_per(
        detail(spark, folder, CUT_START, CUT_END), "event_date"
    ).orderBy("event_date"),
    "dedup_survivor": dedup_survivor,
    # summaries
    "dws_user_daily": over_detail(lambda d: op.daily_summary(d, "user_id")),
    "dws_item_daily": over_detail(lambda d: op.daily_summary(d, "item_id")),
    "dws_category_daily": over_detail(lambda d: op.daily_summary(d, "category_id")),
    "dws_hourly": over_detail(op.hourly_summary),
    # analyses
    "daily_pv_uv": over_detail(op.daily_pv_uv),
    "hourly_distribution": over_detail(op.hourly_distribution),
    "behavior_funnel": over_detail(op.behavior_funnel),
    "top_items": over_detail(op.top_items),
    "top_categories": over_detail(op.top_categories),
    "weekday_vs_weekend": over_detail(op.weekday_vs_weekend),
    "weekday_vs_weekend_all": lambda spark, folder: op.weekday_vs_weekend(all_behaviors(spark, folder)),
    "weekday_pivot_all": lambda spark, folder: feeds.weekday_pivot(
        op.weekday_vs_weekend(all_behaviors(spark, folder)), order=(*feeds.PIVOT_ORDER, "error")
    ),
    "retention": over_detail(op.retention),
    "retention_long": over_detail(lambda d: op.retention(d, (1, 2, 3, 7, 14))),
    "user_rfm": over_detail(rfm),
    "rfm_summary": over_detail(lambda d: op.rfm_summary(rfm(d))),
    "user_path": over_detail(op.user_path),
    "heatmap_hour_dow": over_detail(op.heatmap_hour_dow),
    "repurchase_distribution": over_detail(op.repurchase_distribution),
    "category_top_items": over_detail(category_items),
    # the same analyses over the daily summaries
    "summary_daily_pv_uv": summaries_then(op.daily_pv_uv, "user_id", "item_id"),
    "summary_behavior_funnel": summaries_then(op.behavior_funnel, "user_id"),
    "summary_top_items": summaries_then(op.top_items, "item_id"),
    "summary_top_categories": summaries_then(op.top_categories, "category_id"),
    "summary_weekday_vs_weekend": summaries_then(op.weekday_vs_weekend, "user_id"),
    "summary_retention": summaries_then(op.retention, "user_id"),
    "summary_user_rfm": summaries_then(rfm, "user_id"),
    "summary_repurchase": summaries_then(op.repurchase_distribution, "user_id"),
    "summary_hourly": stored_hours(lambda hours, users: hours),
    "summary_hourly_distribution": stored_hours(op.hourly_distribution),
    "summary_heatmap": stored_hours(op.heatmap_hour_dow),
    # the same analyses over order lines
    "orders_clean_audit": lambda spark, folder: op.clean_audit(
        orders_as_raw(spark, folder), ORDERS_CUT_START, ORDERS_CUT_END
    ),
    "orders_daily_pv_uv": over_orders(op.daily_pv_uv),
    "orders_behavior_funnel": over_orders(op.behavior_funnel),
    "orders_top_items": over_orders(op.top_items),
    "orders_top_categories": over_orders(op.top_categories),
    "orders_weekday_vs_weekend": over_orders(op.weekday_vs_weekend),
    "orders_retention": over_orders(lambda d: op.retention(d, (1, 7, 30))),
    "orders_user_rfm": over_orders(lambda d: op.user_rfm(d, ORDERS_END)),
    "orders_rfm_summary": over_orders(lambda d: op.rfm_summary(op.user_rfm(d, ORDERS_END))),
    "orders_user_path": over_orders(op.user_path),
    "orders_heatmap_hour_dow": over_orders(op.heatmap_hour_dow),
    "orders_repurchase_distribution": over_orders(op.repurchase_distribution),
    "orders_category_top_items": over_orders(category_items),
    "orders_verify_counts": over_orders(op.table_profile),
    # checks
    "verify_counts": over_detail(op.table_profile),
    "verify_behaviors": over_detail(
        lambda d: op.rows_per(d, "behavior").orderBy(F.desc("cnt"), "behavior")
    ),
    "readback_heatmap": over_detail(
        lambda d: op.top_rows(op.heatmap_hour_dow(d), 30, "day_of_week", "event_hour")
    ),
    "readback_path": over_detail(
        lambda d: op.top_rows(
            op.user_path(d), 20, F.desc("path_count"), "from_behavior", "to_behavior"
        )
    ),
    # chart feeds
    "sankey_nodes": over_detail(lambda d: feeds.sankey_nodes(op.user_path(d))),
    "sankey_links": over_detail(lambda d: feeds.sankey_links(op.user_path(d))),
    "transition_labels": over_detail(lambda d: feeds.transition_labels(op.user_path(d))),
    "category_tree": over_detail(category_tree),
    "category_totals": over_detail(lambda d: feeds.category_totals(category_items(d))),
    "heatmap_matrix": over_detail(lambda d: feeds.heatmap_matrix(op.heatmap_hour_dow(d))),
    "heatmap_cells": over_detail(lambda d: feeds.heatmap_cells(op.heatmap_hour_dow(d))),
    "weekday_pivot": over_detail(lambda d: feeds.weekday_pivot(op.weekday_vs_weekend(d))),
    "weekday_pivot_avg": over_detail(
        lambda d: feeds.weekday_pivot(op.weekday_vs_weekend(d), "avg_per_user")
    ),
    "funnel_share": over_detail(
        lambda d: feeds.share_of_total(op.behavior_funnel(d), "behavior", "user_count")
    ),
    "rfm_share": over_detail(
        lambda d: feeds.share_of_total(op.rfm_summary(rfm(d)), "segment", "user_count", 1)
    ),
    "category_share": over_detail(
        lambda d: feeds.share_of_total(op.top_categories(d, 15), "category_id", "pv_count")
    ),
    "rfm_sample": over_detail(lambda d: feeds.rfm_sample(rfm(d))),
    "rfm_sample_cut": over_detail(lambda d: feeds.rfm_sample(rfm(d), n=7)),
    "category_conversion_feed": over_detail(
        lambda d: feeds.category_conversion_feed(op.top_categories(d))
    ),
    "top_items_feed": over_detail(lambda d: feeds.top_items_feed(op.top_items(d))),
    "retention_extremes": over_detail(lambda d: feeds.retention_extremes(op.retention(d))),
    "repurchase_feed": over_detail(
        lambda d: feeds.repurchase_feed(op.repurchase_distribution(d))
    ),
    "hourly_feed": over_detail(lambda d: feeds.hourly_feed(op.hourly_distribution(d))),
    # files, messages and streams
    "stored_partition_scan": stored_partition_scan,
    "stored_day_rerun": stored_day_rerun,
    "ods_csv_load": ods_csv_load,
    "ods_rejects": lambda spark, folder: split_rejects(spark, broken_lines(spark, folder))[1],
    "ods_accepted": lambda spark, folder: split_rejects(spark, broken_lines(spark, folder))[0],
    "catalog_round_trip": catalog_round_trip,
    "catalog_tables": catalog_tables,
    "catalog_columns": catalog_columns,
    "result_csv_head": result_csv_head,
    "result_csv_reload": result_csv_reload,
    "keyed_json_messages": over_raw(encode_messages),
    "decoded_messages": over_raw(
        lambda r: decode_messages(encode_messages(r)).drop("event_time")
    ),
    "stream_pv_uv": stream_pv_uv,
    "stream_uv_tolerance": stream_uv_tolerance,
    "stream_batch_files": stream_batch_files,
    "stream_numbered_files": stream_numbered_files,
    "stream_file_sizes": stream_file_sizes,
    "stream_row_limit": stream_row_limit,
    "stream_late_events": stream_late_events,
}
