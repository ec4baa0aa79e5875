import json
import time
from collections import Counter
from importlib import import_module

import pytest
from conftest import epoch, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from footfall import streaming
from footfall.schemas import MESSAGE, RAW
from footfall.sources import load_raw

T0 = epoch("2024-03-01T10:00:00")


def event(user, behavior, second):
    return (user, 1, 1, behavior, T0 + second)


@pytest.fixture
def feed(spark, tmp_path):
    """Writes one message file per call, in order."""
    folder = tmp_path / "messages"
    folder.mkdir()
    written = []

    def write(*events, values=()):
        lines = [
            json.dumps({"key": str(e[0]), "value": json.dumps(dict(zip(RAW.names, e)))})
            for e in events
        ] + [json.dumps({"key": "0", "value": v}) for v in values]
        name = folder / f"{len(written):04d}.json"
        name.write_text("\n".join(lines) + "\n")
        written.append(name)
        # files are taken in order of modification time
        import os

        os.utime(name, (1_700_000_000 + len(written), 1_700_000_000 + len(written)))

    write.folder = str(folder)
    return write


def run(spark, feed, tmp_path, name, fmt="memory", mode="update", **options):
    events = streaming.decode_messages(
        streaming.file_messages(spark, feed.folder, max_files_per_trigger=1)
    )
    query = streaming.start_windowed(
        streaming.windowed_pv_uv(events),
        checkpoint=str(tmp_path / f"checkpoint-{name}"),
        fmt=fmt,
        mode=mode,
        every=None,
        name=name,
        **options,
    )
    query.awaitTermination()
    return query


def answers(spark, name):
    """The last version of each window; counts only grow."""
    latest = (
        spark.table(name)
        .groupBy("window_start", "behavior")
        .agg(F.max("count").alias("n"), F.max_by("unique_users", "count").alias("u"))
    )
    return {
        (int(r[0].timestamp()) - T0, r[1]): (r[2], r[3])
        for r in latest.select(F.col("window_start"), "behavior", "n", "u").collect()
    }


def batch_answers(spark, *events):
    windows = {}
    for user, _, _, behavior, second in events:
        start = second - second % 10
        for k in range(3):
            windows.setdefault((start - 10 * k - T0, behavior), []).append(user)
    return {key: (len(users), len(set(users))) for key, users in windows.items()}


def test_update_mode_in_order_equals_batch(spark, feed, tmp_path):
    batches = [
        [event(u, b, 20 * i + s) for u, b, s in [(1, "pv", 0), (2, "pv", 5), (1, "buy", 9)]]
        for i in range(6)
    ]
    for batch in batches:
        feed(*batch)
    query = run(spark, feed, tmp_path, "in_order")
    assert answers(spark, "in_order") == batch_answers(spark, *sum(batches, []))
    totals = streaming.progress_totals(query)
    assert totals["rows_read"] == 18 and totals["rows_dropped_late"] == 0
    assert totals["batches"] >= 6


def test_late_events_are_dropped_and_counted(spark, feed, tmp_path):
    feed(event(1, "pv", 0))
    feed(event(1, "pv", 200))
    feed(event(1, "fav", 201))
    # Spark drops by the watermark of the batch before the last, 170: 185 is late but inside
    feed(event(2, "pv", 185), event(2, "pv", 3))
    query = run(spark, feed, tmp_path, "late")
    got = answers(spark, "late")
    assert got[(180, "pv")] == (2, 2)
    assert got[(0, "pv")] == (1, 1)
    assert streaming.progress_totals(query)["rows_dropped_late"] == 3  # once per window


def test_bad_messages_give_null_fields(spark):
    values = [
        json.dumps(dict(zip(RAW.names, event(1, "pv", 0)))),
        "not json",
        '{"user_id": "x", "item_id": 2, "category_id": 3, "behavior": "pv", "timestamp": 4}',
        '{"user_id": 1}',
    ]
    messages = spark.createDataFrame([("k", v) for v in values], MESSAGE)
    got = rows(streaming.decode_messages(messages.select(F.col("value").cast("binary"))))
    assert got[0][:5] == event(1, "pv", 0) and got[0][5].timestamp() == T0
    assert got[1] == (None,) * 6
    assert got[2][0] is None and got[2][3] == "pv"
    assert got[3][0] == 1 and got[3][1:] == (None,) * 5


def test_bad_messages_do_not_stop_the_stream(spark, feed, tmp_path):
    feed(event(1, "pv", 0), values=["not json", '{"timestamp": "soon"}'])
    run(spark, feed, tmp_path, "bad")
    assert answers(spark, "bad")[(0, "pv")] == (1, 1)


def test_restart_from_the_checkpoint_changes_nothing(spark, feed, tmp_path):
    batches = [[event(u, "pv", 15 * i + u) for u in range(5)] for i in range(6)]
    out = str(tmp_path / "windows")
    for batch in batches[:3]:
        feed(*batch)
    run(spark, feed, tmp_path, "restarted", fmt="parquet", mode="append", path=out)
    for batch in batches[3:]:
        feed(*batch)
    run(spark, feed, tmp_path, "restarted", fmt="parquet", mode="append", path=out)
    last = max(e[4] for batch in batches for e in batch) - T0
    want = {
        key: value
        for key, value in batch_answers(spark, *sum(batches, [])).items()
        if key[0] + 30 <= last - 30
    }
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want)
    assert {
        (int(r.window_start.timestamp()) - T0, r.behavior): (r["count"], r.unique_users)
        for r in got
    } == want


def test_approximate_users_stay_close(spark, feed):
    events = spark.range(20000).select(
        F.col("id").alias("user_id"),
        F.lit("pv").alias("behavior"),
        F.timestamp_seconds(F.lit(T0)).alias("event_time"),
    )
    for row in streaming.windowed_pv_uv(events).collect():
        assert row["count"] == 20000
        assert abs(row.unique_users - 20000) < 0.15 * 20000


def test_messages_round_trip(spark, raw_of):
    raw = raw_of(event(1, "pv", 0), event(2, "buy", 5))
    messages = streaming.encode_messages(raw)
    assert messages.columns == MESSAGE.names
    assert json.loads(rows(messages)[0][1]) == dict(zip(RAW.names, event(1, "pv", 0)))
    back = streaming.decode_messages(messages).drop("event_time")
    assert sorted(rows(back)) == sorted(rows(raw))


def test_landing_writes_every_event_once(spark, feed, tmp_path, raw_of):
    out, checkpoint = str(tmp_path / "landed"), str(tmp_path / "landing-checkpoint")

    def land():
        source = streaming.file_messages(spark, feed.folder, max_files_per_trigger=1)
        streaming.land_batches(
            streaming.decode_messages(source), out, checkpoint, every=None
        ).awaitTermination()

    first = [event(u, "pv", u) for u in range(4)]
    second = [event(u, "buy", u) for u in range(4, 9)]
    feed(*first)
    land()
    feed(*second)
    land()
    land()
    assert sorted(rows(load_raw(spark, out))) == sorted(first + second)


def test_sent_messages_can_be_replayed(spark, tmp_path, raw_of, feed):
    raw = raw_of(event(1, "pv", 0), event(2, "buy", 5))
    streaming.write_messages(raw, fmt="json", path=str(tmp_path / "sent"))
    source = streaming.file_messages(spark, str(tmp_path / "sent"))
    query = (
        streaming.decode_messages(source)
        .writeStream.format("memory")
        .queryName("replayed")
        .option("checkpointLocation", str(tmp_path / "replay"))
        .start()
    )
    streaming.stop_after_backlog(query)
    assert not query.isActive
    assert spark.table("replayed").count() == 2


def test_kafka_source_is_configured_or_reports_the_missing_connector(spark):
    try:
        stream = streaming.kafka_messages(spark, "localhost:9092", max_per_trigger=5000)
    except PySparkException as error:
        assert "kafka" in str(error).lower()
    else:
        assert "value" in stream.columns


def test_totals_cover_more_batches_than_spark_remembers(spark, feed, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    totals = streaming.RunTotals()
    spark.streams.addListener(totals)
    try:
        for k in range(5):
            feed((1, 2, 3, "pv", T0 + k))
        query = run(spark, feed, tmp_path, "totals")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert len(query.recentProgress) < totals.of(query)["batches"]
        assert totals.of(query)["rows_read"] == 5 and totals.of(query)["batches"] >= 5
    finally:
        spark.streams.removeListener(totals)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def numbered(spark, feed, tmp_path, file_rows, max_rows=None, every=None):
    source = streaming.file_messages(spark, feed.folder, max_files_per_trigger=1)
    return streaming.land_numbered(
        streaming.decode_messages(source),
        str(tmp_path / "numbered"),
        str(tmp_path / "numbered-checkpoint"),
        file_rows,
        max_rows,
        every,
    )


def landed(spark, tmp_path):
    df = streaming.read_numbered(spark, str(tmp_path / "numbered"))
    files = sorted(tuple(r) for r in df.groupBy("batch").count().collect())
    return files, sorted(rows(df.drop("batch")))


def test_numbered_files_carry_an_open_rest_between_batches(spark, feed, tmp_path):
    events = [event(u, "pv", u) for u in range(23)]
    for lo, hi in ((0, 3), (3, 4), (4, 15), (15, 23)):
        feed(*events[lo:hi])
    streaming.finish_landing(*numbered(spark, feed, tmp_path, 5))
    assert landed(spark, tmp_path) == ([(1, 5), (2, 5), (3, 5), (4, 5), (5, 3)], sorted(events))
    for n in range(1, 6):
        parts = list((tmp_path / "numbered" / f"batch={n}").glob("part-*.csv"))
        assert len(parts) == 1 and len(parts[0].read_text().splitlines()) <= 5
    # a flushed file stays as it is; later rows go to new files
    more = [event(u, "buy", u) for u in range(7)]
    feed(*more)
    streaming.finish_landing(*numbered(spark, feed, tmp_path, 5))
    files, got = landed(spark, tmp_path)
    assert files[4:] == [(5, 3), (6, 5), (7, 2)] and got == sorted(events + more)
    streaming.finish_landing(*numbered(spark, feed, tmp_path, 5))
    assert landed(spark, tmp_path) == (files, got)


def test_a_repeated_batch_writes_the_same_files(spark, raw_of, tmp_path):
    from footfall.streaming import NumberedFiles

    writer = NumberedFiles(str(tmp_path / "numbered"), str(tmp_path / "numbered-checkpoint"), 4)
    batches = [raw_of(*(event(u, b, u) for u in range(n))) for b, n in (("pv", 6), ("fav", 1), ("buy", 9))]
    for number, batch in enumerate(batches):
        writer.write(batch, number)
        writer.write(batch, number)
    writer.write(batches[1], 1)  # as if the query came back to an older batch after a failure
    writer.write(batches[2], 2)
    writer.flush(spark)
    writer.flush(spark)
    files, got = landed(spark, tmp_path)
    assert [n for _, n in files] == [4, 4, 4, 4]
    assert got == sorted(sum((rows(b) for b in batches), []))


def test_many_small_files_are_written_by_many_tasks(spark, raw_of, tmp_path):
    writer = streaming.NumberedFiles(str(tmp_path / "numbered"), str(tmp_path / "numbered-checkpoint"), 1)
    events = [event(u, "pv", u) for u in range(100)]
    writer.write(raw_of(*events), 0)
    names = [f.name for f in (tmp_path / "numbered").glob("batch=*/part-*.csv")]
    assert len(names) == 100 and len({n.split("-")[1] for n in names}) > 1
    assert landed(spark, tmp_path) == ([(n, 1) for n in range(1, 101)], sorted(events))


@pytest.mark.parametrize("every", [None, "200 milliseconds"])
def test_row_limit_holds_over_restarts(spark, feed, tmp_path, every):
    for k in range(4):
        feed(*(event(u, "pv", 10 * k + u) for u in range(10)))
    for _ in range(3):
        query, files = numbered(spark, feed, tmp_path, 8, 25, every)
        streaming.finish_landing(query, files)
        assert not query.isActive and files.full
        sizes, got = landed(spark, tmp_path)
        assert [n for _, n in sizes] == [8, 8, 8, 1] and len(set(got)) == 25
    # a higher limit goes on where the first one ended: the batch that was left unread
    streaming.finish_landing(*numbered(spark, feed, tmp_path, 8, 1000))
    assert len(landed(spark, tmp_path)[1]) == 35


def test_writer_errors_are_not_taken_for_the_limit(spark, feed, tmp_path):
    feed(event(1, "pv", 0))
    (tmp_path / "elsewhere").write_text("a file where a folder is needed")
    broken, files = streaming.land_numbered(
        streaming.decode_messages(streaming.file_messages(spark, feed.folder)),
        str(tmp_path / "elsewhere" / "below"),
        str(tmp_path / "another-checkpoint"),
        1,
        every=None,
    )
    with pytest.raises(PySparkException):
        streaming.finish_landing(broken, files)


def test_late_events_are_kept_and_add_up(spark, feed, tmp_path):
    out = str(tmp_path / "result")
    batches = [
        [event(1, "pv", 0), event(2, "buy", 4)],
        [event(1, "pv", 200)],
        [event(1, "fav", 201), event(3, "pv", 199)],
        [event(2, "pv", 185), event(2, "pv", 3), event(4, "buy", 166), event(4, "buy", 166)],
    ]
    for batch in batches[:3]:
        feed(*batch)

    def run_once():
        events = streaming.decode_messages(streaming.file_messages(spark, feed.folder, max_files_per_trigger=1))
        query = streaming.start_with_late(events, out, str(tmp_path / "late-checkpoint"), every=None)
        query.awaitTermination()
        return query

    run_once()
    feed(*batches[3], values=["not json"])
    query = run_once()  # restarted
    late = streaming.late_events(spark, out)
    assert late.count() == streaming.progress_totals(query)["rows_dropped_late"] + 1  # equal rows merge first
    found = Counter((int(r.window_start.timestamp()) - T0, r.behavior) for r in late.collect())
    assert found[(0, "pv")] == found[(-10, "pv")] == found[(-20, "pv")] == 1 and found[(140, "buy")] == 2
    assert (180, "pv") not in found
    for r in streaming.latest_windows(spark, f"{out}/windows").collect():
        found[int(r.window_start.timestamp()) - T0, r.behavior] += r["count"]
    assert found == {k: n for k, (n, _) in batch_answers(spark, *sum(batches, [])).items()}


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end
        time.sleep(0.2)


def test_live_run_is_fed_stopped_and_restarted(spark, feed, tmp_path):
    """A running query under a processing-time trigger; files arrive while it runs."""
    batches = [[event(u, "pv", 15 * i + u) for u in range(5)] for i in range(6)]
    out, checkpoint = str(tmp_path / "versions"), str(tmp_path / "live-checkpoint")

    def start():
        events = streaming.decode_messages(streaming.file_messages(spark, feed.folder, max_files_per_trigger=1))
        return streaming.start_versions(
            streaming.windowed_pv_uv(events), out, checkpoint, every="300 milliseconds"
        )

    read = lambda query: streaming.progress_totals(query)["rows_read"]
    feed(*batches[0])
    query = start()
    for k, batch in enumerate(batches[1:3], start=2):
        feed(*batch)
        wait_for(lambda: read(query) == 5 * k)
    streaming.stop_after_backlog(query)
    assert not query.isActive and query.exception() is None
    feed(*batches[3])  # arrives while nothing runs
    query = start()
    wait_for(lambda: read(query) == 5)
    for batch in batches[4:]:
        feed(*batch)
    streaming.stop_after_backlog(query)
    got = {
        (int(r.window_start.timestamp()) - T0, r.behavior): (r["count"], r.unique_users)
        for r in streaming.latest_windows(spark, out).collect()
    }
    assert got == batch_answers(spark, *sum(batches, []))


def test_console_sink_runs_in_update_mode(spark, feed, tmp_path):
    """The JVM prints past the tests' capture, so the sink's progress has to do."""
    feed(event(1, "pv", 0))
    events = streaming.decode_messages(streaming.file_messages(spark, feed.folder))
    query = streaming.start_windowed(
        streaming.windowed_pv_uv(events), str(tmp_path / "console"), every="200 milliseconds", truncate="false"
    )
    streaming.stop_after_backlog(query)
    first = query.recentProgress[0]
    assert "ConsoleTable" in first.sink.description and first.numInputRows == 1
    assert first.stateOperators[0].numRowsUpdated == 3  # an event falls into three windows


def test_late_events_send_no_windows_through_the_driver(spark, feed, tmp_path, monkeypatch):
    feed(event(1, "pv", 0), event(2, "buy", 4))
    frame = type(spark.range(1))
    plans, join = [], frame.join

    def joined(*args):
        plans.append(join(*args))
        return plans[-1]

    monkeypatch.setattr(frame, "join", joined)
    events = streaming.decode_messages(streaming.file_messages(spark, feed.folder))
    out = str(tmp_path / "result")
    streaming.start_with_late(events, out, str(tmp_path / "late-checkpoint"), every=None).awaitTermination()
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_interrupt_stops_the_query(spark, feed, tmp_path, monkeypatch):
    feed(event(1, "pv", 0))
    query, files = numbered(spark, feed, tmp_path, 8, every="200 milliseconds")
    query.processAllAvailable()

    class Interrupted:
        status, stop = query.status, query.stop

        def awaitTermination(self, seconds=None):
            raise KeyboardInterrupt

    streaming.finish_landing(Interrupted(), files)
    assert not query.isActive
    assert landed(spark, tmp_path) == ([(1, 1)], [event(1, "pv", 0)])


def test_streaming_session_settings(monkeypatch):
    module = import_module("footfall.session")
    got = {}

    class Builder:
        def appName(self, name):
            got["name"] = name
            return self

        def config(self, key, value):
            got[key] = value
            return self

        def master(self, master):
            got["master"] = master
            return self

        def getOrCreate(self):
            return got

    monkeypatch.setattr(module, "SparkSession", type("S", (), {"builder": Builder()}))
    module.streaming_session()
    assert got["spark.sql.adaptive.enabled"] == "false" and got["spark.sql.shuffle.partitions"] == "4"
    assert "master" not in got
    module.session("batch", "local[2]", 16, settings={"spark.ui.enabled": "false"})
    assert got["spark.sql.adaptive.enabled"] == "true" and got["spark.sql.shuffle.partitions"] == "16"
    assert got["spark.sql.parquet.compression.codec"] == "snappy" and got["master"] == "local[2]"
    assert got["spark.sql.sources.partitionOverwriteMode"] == "dynamic" and got["spark.ui.enabled"] == "false"
