"""The physical plans that matter at scale."""

import re

import pytest

from footfall import operators as op
from footfall import sinks
from footfall.operators.cleaning import EVENT_KEY
from footfall.plans.registered import raw, stored_detail
from footfall.sources import read_layer

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    root = stored_detail(spark, SMALL)
    sinks.save(raw(spark, SMALL), "ods.user_behavior", root)
    return lambda name, *days: read_layer(spark, name, root, *days)


@pytest.fixture(scope="module")
def detail(stored):
    return stored("dwd.user_behavior_detail")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan(df))


def columns_read(df) -> set[str]:
    return {re.sub(r"#.*", "", c) for scan in scans(df) for c in scan.split(",")}


def test_day_range_prunes_partitions(stored):
    text = plan(op.daily_pv_uv(stored("dwd.user_behavior_detail", "2024-01-08", "2024-01-09")))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert filters and all("2024-01-08" in f and "2024-01-09" in f for f in filters)


def test_cleaning_pushes_its_rules_into_the_scan(stored):
    text = plan(op.clean(stored("ods.user_behavior"), "2024-01-02", "2024-01-29"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThanOrEqual(timestamp,1704153600)" in pushed
    assert "LessThan(timestamp,1706572800)" in pushed
    assert "In(behavior" in pushed and "IsNotNull(item_id)" in pushed


def test_duplicates_are_merged_before_the_shuffle(stored):
    text = plan(op.clean(stored("ods.user_behavior"), "2024-01-02", "2024-01-29"))
    assert text.count("Exchange") == 1
    below = text[text.index("Exchange") :]
    assert "partial_min(category_id" in below and all(k in below for k in EVENT_KEY)
    assert "SortAggregate" not in text


def test_each_analysis_reads_only_its_columns(detail):
    want = {
        op.retention: {"user_id", "event_date"},
        op.top_items: {"item_id", "behavior", "event_date"},
        op.top_categories: {"category_id", "behavior", "event_date"},
        op.behavior_funnel: {"user_id", "behavior", "event_date"},
        op.repurchase_distribution: {"user_id", "behavior", "event_date"},
        op.user_path: {"user_id", "behavior", "event_time", "event_date"},
        op.hourly_distribution: {"user_id", "behavior", "event_hour", "event_date"},
    }
    for analysis, columns in want.items():
        assert columns_read(analysis(detail)) <= columns, analysis.__name__


def test_purchases_are_filtered_in_the_scan(detail):
    assert "EqualTo(behavior,buy)" in plan(op.repurchase_distribution(detail)) or (
        "In(behavior, [buy])" in plan(op.repurchase_distribution(detail))
    )
    assert "In(behavior, [buy,cart])" in plan(op.user_rfm(detail))


def test_top_k_is_cut_before_it_is_numbered(detail):
    for df in (op.top_items(detail, 10), op.top_categories(detail, 10)):
        text = plan(df)
        assert "TakeOrderedAndProject" in text
        assert "SinglePartition" not in text


def test_rank_limit_is_applied_before_and_after_the_shuffle(detail):
    text = plan(op.category_top_items(detail, 5, 3))
    assert text.count("WindowGroupLimit") == 2
    assert "BroadcastHashJoin" in text


def test_no_join_and_no_row_multiplication_where_none_is_needed(detail):
    for analysis in (
        op.daily_pv_uv, op.hourly_distribution, op.behavior_funnel, op.weekday_vs_weekend,
        op.retention, op.user_rfm, op.user_path, op.heatmap_hour_dow, op.table_profile,
        op.repurchase_distribution,
    ):
        text = plan(analysis(detail))
        assert "Join" not in text and "CartesianProduct" not in text, analysis.__name__
        assert "Expand" not in text, analysis.__name__


def test_one_scan_where_several_results_share_it(stored, detail):
    for analysis in (
        op.hourly_distribution, op.hourly_summary, op.heatmap_hour_dow, op.table_profile, op.user_path,
        op.day_activity,
    ):
        assert len(scans(analysis(detail))) == 1, analysis.__name__
    # the rows that one scan is turned into are merged before they are shuffled
    for analysis in (op.hourly_distribution, op.table_profile):
        text = plan(analysis(detail))
        above_scan = text[: text.index("FileScan")]
        assert above_scan.rindex("Exchange") < above_scan.rindex("HashAggregate") < above_scan.rindex("Generate")


def test_a_window_row_group_holds_one_day_of_a_user(detail):
    text = plan(op.user_path(detail))
    windows = re.findall(r"Window \[(?:lag|lead)\(behavior#.*?windowspecdefinition\((.*?), at#", text)
    assert windows and all(re.match(r"user_id#\d+L, day#\d+$", keys) for keys in windows)
    # the window over days reads day ends only, which the aggregation below it has merged
    assert re.search(r"Window \[lag\(to_behavior#.*\n.*Sort.*\n.*Exchange.*\n.*HashAggregate", text)


def test_stored_hours_are_not_shuffled_again(spark, stored, detail, tmp_path):
    sinks.save(op.day_activity(detail), "dws.activity", str(tmp_path))
    activity = read_layer(spark, "dws.activity", str(tmp_path))
    assert "Exchange" not in plan(op.user_days(activity)) and "Exchange" not in plan(op.active_hours(activity))
    assert plan(op.hourly_summary(activity)).count("Exchange") == 1
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(op.user_days(activity)))
    assert filters and all("grain" in f for f in filters)


def test_aggregations_hash_and_run_in_generated_code(detail):
    for analysis in (
        op.daily_pv_uv, op.retention, op.user_path, op.heatmap_hour_dow, op.top_items,
        op.repurchase_distribution, op.user_rfm,
    ):
        df = analysis(detail)
        df.collect()
        text = plan(df)
        assert "SortAggregate" not in text, analysis.__name__
        assert re.search(r"\*\(\d+\) HashAggregate", text), analysis.__name__


def test_medians_reuse_the_shuffle_of_the_buyers(detail):
    df = op.user_rfm(detail)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_a_summary_at_the_right_grain_is_not_shuffled_again(spark, stored):
    days = spark.createDataFrame([], "user_id bigint, event_date string, pv_count bigint, "
                                     "fav_count bigint, cart_count bigint, buy_count bigint")  # fmt: skip
    text = plan(op.retention(days))
    assert text.count("hashpartitioning(user_id") == 1


def test_detail_is_rebalanced_by_day_when_written(spark, stored, tmp_path):
    """A day that holds most rows is written by many tasks."""
    big = (
        spark.range(400_000)
        .selectExpr(
            "id as user_id", "id as item_id", "id as category_id", "'pv' as behavior",
            "concat('2024-03-01 10:00:', id) as event_time", "10 as event_hour",
            "6 as day_of_week", "0 as is_weekend",
            "if(id % 100 = 0, '2024-03-02', '2024-03-01') as event_date",
        )
        .repartition(8)
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        sinks.save(big, "dwd.user_behavior_detail", str(tmp_path))
    finally:
        spark.conf.set(key, before)
    table = tmp_path / "dwd" / "user_behavior_detail"
    assert len(list((table / "event_date=2024-03-01").glob("*.parquet"))) > 1
    assert len(list((table / "event_date=2024-03-02").glob("*.parquet"))) == 1
    assert read_layer(spark, "dwd.user_behavior_detail", str(tmp_path)).count() == 400_000


def test_cleaning_rules_reach_the_scan(spark):
    from footfall.plans.registered import detail

    plan = detail(spark, "/root/testdata/sf0.001", "2024-01-10", "2024-01-10")
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed and "In(event_type" in pushed
