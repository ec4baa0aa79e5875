from pyspark.sql import functions as F
from conftest import epoch, rows

from footfall import operators as op

DAY = ("2024-03-10", "2024-03-12")


def test_each_field_null_is_removed(raw_of):
    good = (1, 2, 3, "pv", "2024-03-10T10:00:00")
    broken = [tuple(None if i == j else v for j, v in enumerate(good)) for i in range(5)]
    raw = raw_of(good, *broken)
    assert op.clean(raw, *DAY).count() == 1
    assert rows(op.clean_audit(raw, *DAY)) == [(6, 5, 0, 0, 0, 1, 16.67)]


def test_unknown_behaviours_are_removed_and_case_matters(raw_of):
    at = "2024-03-10T10:00:00"
    raw = raw_of(*((1, i, 3, b, at) for i, b in enumerate(["pv", "share", "", "PV", "buy"])))
    assert {r[3] for r in rows(op.clean(raw, *DAY))} == {"pv", "buy"}
    assert rows(op.clean(raw, *DAY, valid=("share",)))[0][3] == "share"


def test_first_and_last_second_of_the_range(raw_of):
    times = (
        "2024-03-09T23:59:59",
        "2024-03-10T00:00:00",
        "2024-03-12T23:59:59",
        "2024-03-13T00:00:00",
    )
    raw = raw_of(*((1, i, 3, "pv", t) for i, t in enumerate(times)))
    kept = op.clean(raw, *DAY)
    assert sorted(r[4] for r in rows(kept)) == ["2024-03-10 00:00:00", "2024-03-12 23:59:59"]
    assert rows(op.clean_audit(raw, *DAY))[0][3] == 2


def test_time_zone_moves_the_day(raw_of):
    raw = raw_of((1, 77, 7, "pv", 1511548205))
    assert rows(op.clean(raw, "2017-11-24", "2017-11-24"))[0][4:] == (
        "2017-11-24 18:30:05", 18, 6, 0, "2017-11-24",
    )
    local = op.clean(raw, "2017-11-25", "2017-11-25", tz="Asia/Shanghai")
    assert rows(local)[0][4:] == ("2017-11-25 02:30:05", 2, 7, 1, "2017-11-25")
    assert op.clean(raw, "2017-11-24", "2017-11-24", tz="Asia/Shanghai").count() == 0


def test_result_does_not_depend_on_the_session_zone(spark, raw_of):
    raw = raw_of(
        (1, 1, 1, "pv", 1511548205),
        (1, 1, 1, "pv", epoch("2024-11-03T05:30:00")),
        (1, 1, 1, "pv", epoch("2024-11-03T06:30:00")),
    )
    want = sorted(rows(op.clean(raw, "2017-01-01", "2024-12-31", tz="Asia/Shanghai")))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = sorted(rows(op.clean(raw, "2017-01-01", "2024-12-31", tz="Asia/Shanghai")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_clock_changes(raw_of):
    times = {
        "2024-03-10T06:59:59": "2024-03-10 01:59:59",
        "2024-03-10T07:00:00": "2024-03-10 03:00:00",
        "2024-11-03T05:30:00": "2024-11-03 01:30:00",
        "2024-11-03T06:30:00": "2024-11-03 01:30:00",
    }
    raw = raw_of(*((1, i, 1, "pv", t) for i, t in enumerate(times)))
    got = {r[1]: r[4] for r in rows(op.clean(raw, "2024-03-10", "2024-11-03", tz="America/New_York"))}
    assert [got[i] for i in range(4)] == list(times.values())


def test_times_that_make_no_sense_are_only_out_of_range(raw_of):
    raw = raw_of(
        (1, 1, 1, "pv", 10**17), (1, 1, 1, "pv", -(10**17)), (1, 1, 1, "pv", "2024-03-10T01:00:00")
    )
    assert op.clean(raw, *DAY).count() == 1
    assert rows(op.clean_audit(raw, *DAY))[0][3] == 2


def test_duplicates_keep_the_smallest_category(raw_of):
    at, later = "2024-03-10T10:00:00", "2024-03-10T10:00:01"
    raw = raw_of(
        (1, 2, 9, "pv", at), (1, 2, 9, "pv", at), (1, 2, 4, "pv", at), (1, 2, 9, "pv", later)
    )
    kept = sorted((r[2], r[4]) for r in rows(op.clean(raw, *DAY)))
    assert kept == [(4, "2024-03-10 10:00:00"), (9, "2024-03-10 10:00:01")]
    assert rows(op.clean_audit(raw, *DAY)) == [(4, 0, 0, 0, 2, 2, 50.0)]


def test_a_row_is_charged_to_the_first_rule_it_breaks(raw_of):
    raw = raw_of(
        (None, 1, 1, "share", "2020-01-01T00:00:00"),
        (1, 1, 1, "share", "2020-01-01T00:00:00"),
        (1, 1, 1, "pv", "2020-01-01T00:00:00"),
    )
    assert rows(op.clean_audit(raw, *DAY)) == [(3, 1, 1, 1, 0, 0, 0.0)]


def test_audit_against_a_written_detail(raw_of):
    raw = raw_of(*((u % 3, 1, 1, "pv", "2024-03-10T10:00:00") for u in range(9)))
    lazily = rows(op.clean_audit(raw, *DAY))
    assert lazily == rows(op.clean_audit(raw, *DAY, detail=op.clean(raw, *DAY)))
    assert lazily == [(9, 0, 0, 0, 6, 3, 33.33)]


def test_weekday_numbers_and_weekend_flag(raw_of):
    raw = raw_of(*((1, d, 1, "pv", f"2024-03-{10 + d}T12:00:00") for d in range(7)))
    got = sorted((r[8], r[6], r[7]) for r in rows(op.clean(raw, "2024-03-10", "2024-03-16")))
    assert [g[1] for g in got] == [1, 2, 3, 4, 5, 6, 7]  # 2024-03-10 is a Sunday
    assert [g[2] for g in got] == [1, 0, 0, 0, 0, 0, 1]


def test_keep_first_takes_whole_rows(spark):
    df = spark.createDataFrame(
        [(1, 5, "e"), (1, 2, "b"), (1, 3, None), (2, 7, None)], "k int, id int, v string"
    )
    assert sorted(rows(op.keep_first(df, ["k"], "id"))) == [(1, 2, "b"), (2, 7, None)]


def test_empty_input(raw_of):
    raw = raw_of()
    assert not op.has_rows(raw)
    assert op.clean(raw, *DAY).count() == 0
    assert rows(op.clean_audit(raw, *DAY)) == [(0, 0, 0, 0, 0, 0, None)]


def test_keep_first_with_null_and_tied_order(spark):
    df = spark.createDataFrame(
        [(1, None, 7, 8), (2, 5, 3, 1), (2, 5, 2, 9), (2, None, 0, 0), (3, None, 2, 1), (3, None, 1, 4)],
        "k int, t int, x int, y int",
    )
    for data in (df, df.orderBy("x"), df.orderBy(F.desc("x"))):
        got = sorted(rows(op.keep_first(data, ["k"], "t")), key=lambda r: r[0])
        assert got == [(1, None, 7, 8), (2, 5, 2, 9), (3, None, 1, 4)]
