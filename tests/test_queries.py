"""Registered queries against independent SQL, and invariants between results."""

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from footfall import operators as op
from footfall.plans.registered import END, QUERIES, START, detail, raw, stored_detail
from footfall.sources import read_layer

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, con, name):
    assert name in ORACLE
    assert compare(spark, con, SMALL, name) is None


def total(df, column):
    return df.groupBy().sum(column).collect()[0][0]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_invariants(spark, folder):
    root = stored_detail(spark, folder)
    d = read_layer(spark, "dwd.user_behavior_detail", root)
    profile = op.table_profile(d).collect()[0]
    counts = {r[0]: r[1] for r in op.rows_per(d, "behavior").collect()}
    daily, heatmap, path = op.daily_pv_uv(d), op.heatmap_hour_dow(d), op.user_path(d)
    assert total(daily, "pv") == counts["pv"]
    assert total(heatmap, "pv_count") == profile.row_count == sum(counts.values())
    assert total(heatmap, "buy_count") == counts["buy"]
    assert total(path, "path_count") == profile.row_count - profile.user_count
    assert total(op.retention(d), "new_users") == profile.user_count
    buyers = op.behavior_funnel(d).collect()[3].user_count
    repurchase = op.repurchase_distribution(d)
    assert total(op.rfm_summary(op.user_rfm(d, END)), "user_count") == buyers
    assert total(repurchase, "user_count") == buyers
    assert total(repurchase, "total_buy") == counts["buy"]
    audit = op.clean_audit(raw(spark, folder), START, END).collect()[0]
    removed = audit.null_removed + audit.behavior_removed + audit.date_removed
    assert audit.raw - removed - audit.dedup_removed == audit.final == profile.row_count
    for share in (
        path.groupBy("from_behavior").sum("path_ratio").collect(),
        [("all", total(repurchase, "user_ratio"))],
        [("all", total(repurchase, "buy_contribution"))],
    ):
        assert all(abs(r[1] - 100) < 0.06 for r in share)
    best = op.top_categories(d).limit(5).select("category_id", "pv_count").collect()
    in_items = op.category_top_items(d, 5, 3).select("category_id", "category_pv").distinct()
    assert sorted(map(tuple, best)) == sorted(map(tuple, in_items.collect()))


def test_nothing_is_computed_before_it_is_asked_for(spark):
    """Analyses are lazy: building one starts no job."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building plans")
    try:
        d = detail(spark, SMALL)
        op.user_rfm(d), op.user_path(d), op.category_top_items(d), op.retention(d)
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
