import random
from collections import Counter

import pytest
from conftest import rows

from footfall import operators as op


def at(day, time="10:00:00"):
    return f"2024-03-{day:02d} {time}"


def test_daily_pv_uv_counts_all_users_but_only_viewed_items(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1)), (1, 1, 1, "pv", at(1, "11:00:00")), (2, 2, 1, "buy", at(1)),
        (3, 3, 1, "cart", at(2)),
    )
    assert rows(op.daily_pv_uv(d)) == [("2024-03-01", 2, 2, 1, 1.0), ("2024-03-02", 0, 1, 0, 0.0)]
    assert rows(op.daily_pv_uv(d, start="2024-03-02")) == [("2024-03-02", 0, 1, 0, 0.0)]


def test_hours_count_every_user_once(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1, "00:00:00")), (1, 1, 1, "fav", at(2, "00:59:59")),
        (2, 1, 1, "buy", at(1, "23:00:00")), (1, 1, 1, "cart", at(1, "23:10:00")),
    )
    assert rows(op.hourly_distribution(d)) == [(0, 1, 1, 0, 0), (23, 0, 2, 1, 1)]
    assert sorted(rows(op.hourly_summary(d))) == [
        ("2024-03-01", 0, 1, 0, 0, 0, 1),
        ("2024-03-01", 23, 0, 0, 1, 1, 2),
        ("2024-03-02", 0, 0, 1, 0, 0, 1),
    ]
    # 2024-03-01 is a Friday; pv_count counts every behaviour
    assert rows(op.heatmap_hour_dow(d)) == [(6, 0, 1, 0, 1), (6, 23, 2, 1, 2), (7, 0, 1, 0, 1)]


def test_funnel_is_coverage_and_may_exceed_the_stage_before(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1)), (2, 1, 1, "pv", at(1)), (3, 1, 1, "pv", at(1)),
        (1, 1, 1, "cart", at(1)), (2, 1, 1, "cart", at(1)), (9, 1, 1, "buy", at(1)),
    )
    assert rows(op.behavior_funnel(d)) == [
        ("浏览(pv)", 3, 100.0, 100.0),
        ("收藏(fav)", 0, 0.0, 0.0),
        ("加购(cart)", 2, 0.0, 66.67),
        ("购买(buy)", 1, 50.0, 33.33),
    ]
    short = op.behavior_funnel(d, stages=("cart", "buy"), labels={})
    assert rows(short) == [("cart", 2, 100.0, 100.0), ("buy", 1, 50.0, 50.0)]


def test_funnel_without_views_is_empty(detail_of):
    assert rows(op.behavior_funnel(detail_of((1, 1, 1, "buy", at(1))))) == []


def test_top_items_breaks_ties_by_id(detail_of):
    d = detail_of(
        (1, 30, 1, "fav", at(1)), (1, 20, 1, "fav", at(1)), (1, 10, 1, "pv", at(1)),
        (1, 40, 1, "buy", at(1)), (1, 40, 1, "cart", at(1)),
    )
    best = rows(op.top_items(d, k=2))
    assert best == [(1, 40, 0, 0, 1, 1, 15.0), (2, 20, 0, 1, 0, 0, 3.0)]
    assert [r[1] for r in rows(op.top_items(d))] == [40, 20, 30, 10]
    views_only = op.top_items(d, weights={"pv": 1, "fav": 0, "cart": 0, "buy": 0})
    assert rows(views_only)[0][:2] == (1, 10)


def test_category_without_views_has_no_conversion_rate(detail_of):
    d = detail_of(
        (1, 1, 5, "buy", at(1)), (1, 2, 6, "pv", at(1)), (2, 2, 6, "pv", at(1)),
        (3, 2, 6, "pv", at(1)), (3, 2, 6, "buy", at(1)),
    )
    assert rows(op.top_categories(d)) == [(1, 6, 3, 1, 33.3333), (2, 5, 0, 1, None)]


def test_weekday_and_weekend(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(2)), (1, 1, 1, "pv", at(3)), (2, 1, 1, "pv", at(3)),
        (1, 1, 1, "buy", at(4)),
    )
    want = [("weekday", "buy", 1, 1, 1.0), ("weekend", "pv", 3, 2, 1.5)]
    assert rows(op.weekday_vs_weekend(d)) == want
    assert rows(op.weekday_vs_weekend(op.daily_summary(d, "user_id"))) == want


def test_retention_tail_is_zero_not_null(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1)), (1, 1, 1, "pv", at(2)), (1, 1, 1, "buy", at(4)),
        (2, 1, 1, "fav", at(1)), (3, 1, 1, "pv", at(4)),
    )
    want = [("2024-03-01", 2, 50.0, 0.0, 50.0), ("2024-03-04", 1, 0.0, 0.0, 0.0)]
    assert rows(op.retention(d)) == want
    assert rows(op.retention(op.daily_summary(d, "user_id"))) == want
    assert op.retention(d, (7, 14)).columns == ["first_date", "new_users", "day_7", "day_14"]


def test_path_orders_ties_and_skips_single_events(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1, "10:00:00")), (1, 2, 1, "pv", at(1, "10:00:00")),
        (1, 3, 1, "cart", at(1, "10:00:00")), (1, 4, 1, "buy", at(1, "10:00:01")),
        (2, 1, 1, "pv", at(1)),
    )
    # user 1 in order: cart, pv, pv, buy
    assert rows(op.user_path(d)) == [
        ("cart", "pv", 1, 100.0), ("pv", "buy", 1, 50.0), ("pv", "pv", 1, 50.0),
    ]


def test_repurchase_buckets(detail_of):
    events = []
    for user, times in enumerate([1, 2, 3, 5, 6, 10, 11], start=1):
        events += [(user, i, 1, "buy", at(1, f"10:00:{i:02d}")) for i in range(times)]
    d = detail_of(*events, (99, 1, 1, "pv", at(1)))
    got = rows(op.repurchase_distribution(d))
    assert [(r[1], r[2], r[4]) for r in got] == [(1, 1, 1), (2, 1, 2), (3, 2, 8), (4, 2, 16), (5, 1, 11)]
    assert got[2][0] == "3-5次（活跃买家）"
    assert sum(r[3] for r in got) == pytest.approx(100, abs=0.05)
    two = op.repurchase_distribution(d, (("few", 1, 4), ("many", 5, None)))
    assert [(r[0], r[2]) for r in rows(two)] == [("few", 3), ("many", 4)]


def test_category_top_items_breaks_ties_by_id(detail_of):
    d = detail_of(
        (1, 12, 1, "pv", at(1)), (1, 11, 1, "pv", at(1)), (1, 13, 1, "buy", at(1)),
        (1, 22, 2, "pv", at(1)), (2, 22, 2, "pv", at(1)), (1, 31, 3, "pv", at(1)),
        (2, 31, 3, "pv", at(1)),
    )
    got = rows(op.category_top_items(d, k_cat=2, k_item=2))
    assert got == [(1, 2, 11, 1, 0, 1), (1, 2, 12, 1, 0, 2), (2, 2, 22, 2, 0, 1)]
    days = op.daily_summary(d, "category_id")
    assert rows(op.category_top_items(d, 2, 2, category_days=days)) == got
    beyond = op.category_top_items(d, k_cat=1_000_000, k_item=2)  # too many to broadcast
    assert rows(beyond)[:3] == got


def test_every_analysis_survives_empty_input(detail_of):
    d = detail_of()
    for analysis in (
        op.daily_pv_uv, op.hourly_distribution, op.behavior_funnel, op.top_items,
        op.top_categories, op.weekday_vs_weekend, op.retention, op.user_rfm, op.user_path,
        op.heatmap_hour_dow, op.repurchase_distribution, op.category_top_items,
    ):
        assert rows(analysis(d)) == [], analysis.__name__
    assert rows(op.rfm_summary(op.user_rfm(d))) == []
    assert rows(op.table_profile(d)) == [(0, 0, 0, 0, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_path_and_retention_against_plain_python(detail_of, seed):
    """Half of the events belong to one user and many fall into the same second."""
    rng = random.Random(seed)
    events = set()
    for _ in range(400):
        user = 1 if rng.random() < 0.5 else rng.randint(2, 12)
        time = f"{rng.randint(9, 10):02d}:00:{rng.randint(0, 3):02d}"
        behavior = rng.choice(["pv", "pv", "fav", "cart", "buy"])
        events.add((user, rng.randint(1, 9), 1, behavior, at(rng.randint(1, 9), time)))
    pairs, days = Counter(), {}
    for user in {e[0] for e in events}:
        own = sorted((e[4], e[3]) for e in events if e[0] == user)
        pairs.update((a[1], b[1]) for a, b in zip(own, own[1:]))
        days[user] = sorted({int(t[8:10]) for t, _ in own})
    d = detail_of(*events)
    assert {(r[0], r[1]): r[2] for r in rows(op.user_path(d))} == dict(pairs)
    cohorts = {}
    for active in days.values():
        counts = cohorts.setdefault(active[0], [0, 0, 0, 0])
        counts[0] += 1
        for n in (1, 2, 3):
            counts[n] += active[0] + n in active
    assert rows(op.retention(d)) == [
        (f"2024-03-{day:02d}", c[0], *(round(100 * x / c[0] + 1e-9, 2) for x in c[1:]))
        for day, c in sorted(cohorts.items())
    ]


def test_behavior_share_counts_missing_behaviours_too(raw_of):
    raw = raw_of(*((1, 1, 1, b, 5) for b in ("pv", "pv", None, "odd")))
    assert rows(op.behavior_share(raw)) == [("pv", 2, 50.0), (None, 1, 25.0), ("odd", 1, 25.0)]


def test_path_links_days_over_midnight_and_gaps(detail_of):
    d = detail_of(
        (1, 1, 1, "pv", at(1, "23:59:59")), (1, 1, 1, "cart", at(2, "00:00:00")),  # over midnight
        (1, 1, 1, "buy", at(9)),  # after days without events; the only one of its day
        (1, 1, 1, "fav", at(12, "08:00:00")), (1, 2, 1, "fav", at(12, "08:00:00")), (1, 1, 1, "pv", at(12, "09:00:00")),
        (2, 1, 1, "buy", at(3)), (3, 1, 1, "pv", at(1)), (3, 1, 1, "pv", at(2)), (3, 1, 1, "pv", at(3)),
    )
    want = {("pv", "cart"): 1, ("cart", "buy"): 1, ("buy", "fav"): 1, ("fav", "fav"): 1, ("fav", "pv"): 1, ("pv", "pv"): 2}
    assert {(r[0], r[1]): r[2] for r in rows(op.user_path(d))} == want
    # a range that starts in the middle of a user's days has no step into its first day
    late = {(r[0], r[1]): r[2] for r in rows(op.user_path(d, start="2024-03-02"))}
    del want["pv", "cart"]
    assert late == {**want, ("pv", "pv"): 1}


@pytest.mark.parametrize("seed", [3, 4])
def test_hourly_results_against_plain_python(spark, detail_of, seed, tmp_path):
    """Straight from the detail and from the stored activity; one user holds half of the events."""
    from footfall import sinks
    from footfall.sources import read_layer

    rng = random.Random(seed)
    events = []
    for k in range(500):
        user = 1 if rng.random() < 0.5 else rng.randint(2, 20)
        time = f"{rng.choice([0, 1, 7, 22, 23]):02d}:{rng.randint(0, 59):02d}:00"
        events.append((user, k, 1, rng.choice(["pv", "pv", "fav", "cart", "buy"]), at(rng.randint(1, 9), time)))
    d = detail_of(*events)
    sinks.save(op.day_activity(d), "dws.activity", str(tmp_path))
    activity = read_layer(spark, "dws.activity", str(tmp_path))
    hours, users = op.hourly_summary(activity), op.active_hours(activity)

    def plain(key, *behaviors):
        cells = {}
        for user, _, _, behavior, time in events:
            cell = cells.setdefault(key(time), [Counter(), set()])
            cell[0][behavior] += 1
            cell[1].add(user)
        total = lambda c, b: sum(c.values()) if b == "all" else c[b]
        return sorted((*k, *(total(c, b) for b in behaviors), len(u)) for k, (c, u) in cells.items())

    def dow(time):
        return (int(time[8:10]) - 1 + 5) % 7 + 1  # 2024-03-01 is a Friday

    by_hour = sorted((h, p, u, c, b) for h, p, c, b, u in plain(lambda t: (int(t[11:13]),), "pv", "cart", "buy"))
    by_day = plain(lambda t: (t[:10], int(t[11:13])), "pv", "fav", "cart", "buy")
    by_dow = plain(lambda t: (dow(t), int(t[11:13])), "all", "buy")
    for rel, masks in ((d, None), (hours, users)):
        assert rows(op.hourly_distribution(rel, masks)) == by_hour
        assert rows(op.heatmap_hour_dow(rel, masks)) == by_dow
        cut = rows(op.hourly_distribution(rel, masks, "2024-03-02", "2024-03-02"))
        assert [r[2] for r in cut] == [len(u) for _, u in sorted(
            {h: {e[0] for e in events if e[4][:10] == "2024-03-02" and int(e[4][11:13]) == h} for h in range(24)}.items()
        ) if u]
    assert sorted(rows(op.hourly_summary(d))) == sorted(rows(hours)) == by_day
    assert sorted(rows(op.user_days(activity))) == sorted(rows(op.daily_summary(d, "user_id")))


def test_profile_counts_nulls_as_rows_only(spark):
    d = spark.createDataFrame(
        [(1, None, 5, "2024-03-02"), (1, 7, 5, "2024-03-01"), (None, 7, 6, "2024-03-05")],
        "user_id long, item_id long, category_id long, event_date string",
    )
    assert rows(op.table_profile(d)) == [(3, 1, 1, 2, "2024-03-01", "2024-03-05")]
