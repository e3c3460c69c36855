import os
import time

import pytest
from conftest import message
from pyspark.errors import StreamingQueryException

from tidegauge.operators.windows import aggregate_rows, stats_from_counts
from tidegauge.plans.sensor_stats import sensor_stats
from tidegauge.sources.dictionary import Dictionary
from tidegauge.sources.messages import read_files, stream_files
from tidegauge.sources.sinks import files_writer, read_aggregates
from tidegauge.streaming import sensor_stream
from tidegauge.streaming.progress import DeliveryListener, DeliveryTotals, delivery_report


class Feed:
    """A folder that files arrive in one by one, and a job that reads it."""

    def __init__(self, spark, dictionary, folder):
        self.spark, self.dictionary, self.folder = spark, dictionary, folder
        self.messages = folder / "messages"
        self.messages.mkdir()
        self.query = None
        self.arrived = 0

    def start(self, **trigger):
        self.query = sensor_stream.start(
            stream_files(self.spark, str(self.messages)),
            self.dictionary,
            files_writer(str(self.folder / "rows")),
            str(self.folder / "checkpoint"),
            **trigger,
        )
        return self

    def arrive(self, *texts):
        self.arrived += 1
        path = self.messages / f"{self.arrived:04}.json"
        path.write_text("\n".join(texts) + "\n")
        os.utime(path, (1_700_000_000 + 10 * self.arrived,) * 2)
        if self.query:
            self.query.processAllAvailable()
        return self.rows()

    def rows(self):
        if not (self.folder / "rows").exists():
            return []
        return sorted(map(tuple, read_aggregates(self.spark, str(self.folder / "rows")).collect()))

    def dropped(self):
        return sum(r["late_groups_dropped"] for r in delivery_report(self.query))

    def stop(self):
        self.query.stop()
        self.query = None


@pytest.fixture
def feed(spark, device_types, tmp_path):
    made = Feed(spark, device_types, tmp_path)
    yield made
    if made.query:
        made.stop()


def at(text, **changes):
    return message(event_time=f'"{text}"', **changes)


CLOSED = ("23:59", "00:00", "weather_station", 25.31, 2.0)


def test_windows_close_late_rows_drop_and_the_last_window_waits(feed):
    feed.start()
    assert feed.arrive(at("2026-06-01T23:59:10Z", humidity="1"), at("2026-06-01T23:59:20Z", humidity="2")) == []
    assert feed.arrive(at("2026-06-01T23:59:59.999Z", humidity="3")) == []
    assert feed.arrive(at("2026-06-02T00:00:04.999Z")) == []
    assert feed.arrive(at("2026-06-02T00:00:05Z")) == [CLOSED]
    assert feed.dropped() == 0
    assert feed.arrive(at("2026-06-01T23:59:58Z", humidity="99")) == [CLOSED]
    assert feed.dropped() == 1


def test_out_of_order_events_within_the_bound_count(feed):
    feed.start()
    feed.arrive(at("2026-06-01T23:59:50Z", humidity="1"))
    feed.arrive(at("2026-06-02T00:00:03Z"))
    feed.arrive(at("2026-06-01T23:59:59Z", humidity="3"))
    assert feed.arrive(at("2026-06-02T00:00:05Z")) == [CLOSED]
    assert feed.dropped() == 0


def test_dictionary_too_large_to_broadcast(spark, device_types, feed):
    feed.dictionary = Dictionary(device_types.frame, device_types.rows, broadcast_rows=0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed.start()
        feed.arrive(*[at("2026-06-01T23:59:10Z", humidity=h, device_type_id=i) for h in "123" for i in "39"])
        unknown = ("23:59", "00:00", "unknown_device_type", 25.31, 2.0)
        assert feed.arrive(at("2026-06-02T00:00:05Z")) == [unknown, CLOSED]
        assert "SortMergeJoin" in feed.query._jsq.explainInternal(False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_restart_resumes_without_repeating(feed):
    feed.start()
    feed.arrive(at("2026-06-01T23:59:10Z", humidity="1"))
    feed.stop()
    assert feed.arrive(at("2026-06-01T23:59:20Z", humidity="3"), at("2026-06-02T00:00:05Z")) == []
    feed.start(availableNow=True).query.awaitTermination()
    assert feed.rows() == [CLOSED]
    feed.start(availableNow=True).query.awaitTermination()
    assert feed.rows() == [CLOSED]


def test_repeated_batch_leaves_one_copy(spark, device_types, tmp_path):
    counts = spark.sql(
        "SELECT timestamp'2026-06-01 23:59:00' AS window_start, timestamp'2026-06-02 00:00:00' AS window_end, "
        "'weather_station' AS device_type, 2D AS humidity, 0 AS range, 1L AS n, CAST(0 AS DECIMAL(38,0)) AS exact_sum, "
        "25.31D AS float_sum"
    )
    finish = sensor_stream.finish_batch(files_writer(str(tmp_path)))
    finish(counts, 7)
    finish(counts, 7)
    finish(counts.limit(0), 8)
    assert [tuple(r) for r in read_aggregates(spark, str(tmp_path)).collect()] == [CLOSED]
    assert aggregate_rows(stats_from_counts(counts.persist(), large_group=0, range_rows=1)).first() == CLOSED


def test_written_rows_are_reported_and_a_failed_write_stops_the_job(spark, device_types, tmp_path, feed):
    feed.arrive(at("2026-06-01T23:58:10Z"), at("2026-06-01T23:59:10Z"), at("2026-06-01T23:59:10Z", device_type_id="1"),
                at("2026-06-02T00:00:05Z"))
    written = []

    def run(write, checkpoint):
        sensor_stream.start(
            stream_files(spark, str(feed.messages)), device_types, write, str(tmp_path / checkpoint),
            on_written=lambda batch_id, rows: written.append(rows), availableNow=True,
        ).awaitTermination()

    run(files_writer(str(tmp_path / "rows")), "first")
    assert written == [3]

    def refuse(rows, batch_id):
        raise OSError("sink is away")

    with pytest.raises(StreamingQueryException, match="sink is away"):
        run(refuse, "second")
    assert written == [3]


def test_stream_equals_batch_up_to_the_open_windows(spark, device_types, feed):
    feed.start()
    for minute in range(10):
        texts = [
            at(f"2026-06-01T10:{minute:02}:{second:02}Z", device_type_id=str(second % 7), humidity=str(second / 8),
               temperature=str(minute + second / 16))
            for second in range(0, 60, 3)
        ]
        feed.arrive(*texts, "broken")
    streamed = feed.rows()
    batch = sorted(map(tuple, sensor_stats(read_files(spark, str(feed.messages)), device_types).collect()))
    assert len(batch) == 60
    assert streamed == [row for row in batch if row[0] != "10:09"]
    report = delivery_report(feed.query)
    assert sum(r["rejected"] for r in report) == 10
    assert sum(r["input_rows"] for r in report) == 210


def test_streaming_plan_has_one_shuffle_and_no_python(feed):
    feed.start()
    feed.arrive(message())
    plan = feed.query._jsq.explainInternal(False)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")  # folded before it
    assert plan.count("BroadcastHashJoin") == 1
    assert "Python" not in plan


def test_state_holds_distinct_values_not_events(feed):
    feed.start()
    feed.arrive(*[at("2026-06-01T10:00:00Z", humidity=str(i % 3)) for i in range(300)])
    assert max(r["state_rows"] for r in delivery_report(feed.query)) == 3


def test_bad_messages_are_kept_by_the_quarantine_stream(spark, tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "1.json").write_text("\n".join([message(), "broken", message(humidity=None)]) + "\n")
    query = sensor_stream.start_quarantine(
        stream_files(spark, str(folder)), str(tmp_path / "bad"), str(tmp_path / "checkpoint"), availableNow=True
    )
    query.awaitTermination()
    found = spark.read.schema("value STRING, reason STRING").json(str(tmp_path / "bad")).collect()
    assert {tuple(r) for r in found} == {("broken", "malformed_json"), (message(humidity=None), "missing_humidity")}


def test_listener_reports_batches(spark, feed):
    seen = []
    listener = DeliveryListener(seen.append)
    spark.streams.addListener(listener)
    try:
        feed.start()
        feed.arrive(message(), "broken")
        feed.stop()
        for _ in range(100):
            if sum(s["input_rows"] for s in seen) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(s["input_rows"] for s in seen) == 2
    assert sum(s["rejected"] for s in seen) == 1


def test_rocksdb_state_store(spark, feed):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        feed.start()
        feed.arrive(at("2026-06-01T23:59:10Z", humidity="1"), at("2026-06-01T23:59:20Z", humidity="3"))
        assert feed.arrive(at("2026-06-02T00:00:05Z")) == [CLOSED]
    finally:
        feed.stop()
        spark.conf.set(key, before)


def test_totals_hold_every_batch_however_short_the_history(spark, device_types, tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.json").write_text("\n".join([message(), "broken"]) + "\n")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        with DeliveryTotals(spark) as deliveries:
            query = sensor_stream.start(
                stream_files(spark, str(folder), max_files=1), device_types, files_writer(str(tmp_path / "rows")),
                str(tmp_path / "checkpoint"), availableNow=True,
            )
            totals = deliveries.wait(query)
        assert totals == {"input_rows": 10, "rejected": 5, "late_groups_dropped": 0}
        assert sum(r["input_rows"] for r in delivery_report(query)) < 10
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_one_parse_serves_both_outcomes(spark, device_types, tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    texts = [at("2026-06-01T23:59:10Z", humidity="1"), "broken", at("2026-06-01T23:59:20Z", humidity="3"), at("2026-06-02T00:00:05Z")]
    (folder / "1.json").write_text("\n".join(texts) + "\n")
    split = str(tmp_path / "split")
    query = sensor_stream.start_split(stream_files(spark, str(folder)), split, str(tmp_path / "c1"), availableNow=True)
    query.awaitTermination()
    assert [tuple(r) for r in sensor_stream.read_rejected(spark, split).collect()] == [("broken", "malformed_json")]
    sensor_stream.start(
        sensor_stream.stream_accepted(spark, split), device_types, files_writer(str(tmp_path / "rows")), str(tmp_path / "c2"),
        availableNow=True,
    ).awaitTermination()
    assert [tuple(r) for r in read_aggregates(spark, str(tmp_path / "rows")).collect()] == [CLOSED]
