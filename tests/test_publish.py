import json

import pytest
from conftest import message, messages_frame
from pyspark.errors import AnalysisException

from tidegauge.operators.parse import accepted, parse_events
from tidegauge.operators.publish import aggregate_messages, event_messages, read_aggregate_messages, read_with_reasons, round_robin
from tidegauge.schemas import AGGREGATE_SCHEMA
from tidegauge.session import written
from tidegauge.sources import messages, sinks


def rows_frame(spark, n):
    rows = [("16:54", "16:55", f"type {i}", i / 4, i / 2) for i in range(n)]
    return spark.createDataFrame(rows, AGGREGATE_SCHEMA)


def test_event_message_is_keyed_and_parses_back(spark):
    events = accepted(parse_events(messages_frame(spark, [message(), message(humidity="NaN", device_id='"d \\" é"')])))
    published = event_messages(events)
    first, second = published.collect()
    assert first["key"] == "device_001"
    assert json.loads(first["value"]) == {
        "device_id": "device_001", "device_type_id": 3, "event_time": "2026-06-02T16:54:10.123000+00:00",
        "temperature": 25.31, "humidity": 60.57,
    }
    assert second["key"] == 'd " é'
    again = accepted(parse_events(published.select("value")))
    assert str(again.collect()) == str(events.collect())


def test_aggregate_message_fields_are_in_declared_order(spark):
    [row] = aggregate_messages(rows_frame(spark, 1)).collect()
    assert row["value"] == (
        '{"window_start":"16:54","window_end":"16:55","device_type":"type 0",'
        '"avg_temperature":0.0,"median_humidity":0.0}'
    )


def test_aggregate_messages_read_back_from_bytes(spark):
    rows = rows_frame(spark, 5)
    as_bytes = aggregate_messages(rows).selectExpr("encode(value, 'UTF-8') AS value")
    assert sorted(read_aggregate_messages(as_bytes).collect()) == sorted(rows.collect())


def test_value_is_decoded_and_the_rest_of_the_record_dropped(spark):
    records = spark.sql("SELECT encode('k', 'UTF-8') AS key, encode('é', 'UTF-8') AS value, 3 AS partition, 9 AS offset")
    decoded = messages.decode_value(records)
    assert decoded.columns == ["value"]
    assert decoded.first()["value"] == "é"


def test_every_message_is_read_or_told(spark):
    messages = messages_frame_of(spark)
    told = {r["reason"]: r["rejected"] for r in read_with_reasons(messages).where("reason IS NOT NULL").collect()}
    assert told == {"malformed_json": "{", "missing_avg_temperature": '{"window_start":"1","window_end":"2","device_type":"x","median_humidity":1}'}
    rows = read_with_reasons(messages).where("reason IS NULL")
    assert rows.drop("rejected", "reason").collect() == read_aggregate_messages(messages).collect()
    assert rows.count() == 5 and rows.where("rejected IS NOT NULL").count() == 0


def messages_frame_of(spark):
    bad = [("{",), ('{"window_start":"1","window_end":"2","device_type":"x","median_humidity":1}',)]
    return aggregate_messages(rows_frame(spark, 5)).select("value").unionByName(spark.createDataFrame(bad, "value STRING"))


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_partitions_differ_by_one_whatever_the_tasks(spark, tasks):
    messages = written(aggregate_messages(rows_frame(spark, 1003)).repartition(tasks, "value"))
    dealt = round_robin(messages, 7).groupBy("partition").count().collect()
    assert len(dealt) == 7 and max(r["count"] for r in dealt) - min(r["count"] for r in dealt) <= 1
    assert round_robin(messages.limit(0), 7).count() == 0


def test_round_robin_is_even(spark):
    dealt = round_robin(aggregate_messages(rows_frame(spark, 1000).repartition(3)), 4)
    sizes = {r["partition"]: r["count"] for r in dealt.groupBy("partition").count().collect()}
    assert set(sizes) == {0, 1, 2, 3}
    assert max(sizes.values()) - min(sizes.values()) <= 3  # at most one per writing task


def test_files_are_dealt_out_and_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "out")
    write = sinks.files_writer(path, files=3)
    write(rows_frame(spark, 9), 0)
    write(rows_frame(spark, 2), 1)
    write(rows_frame(spark, 9), 0)
    assert sinks.read_aggregates(spark, path).count() == 11
    assert sinks.read_aggregates(spark, path).columns == AGGREGATE_SCHEMA.names
    assert len(list((tmp_path / "out" / "batch_id=0").glob("part-*"))) == 3


def test_topic_options():
    assert messages.kafka_options("host:1", "t") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "earliest"}
    options = messages.kafka_options("host:1", "t", group_id="g", starting="latest", maxOffsetsPerTrigger="10")
    assert options["kafka.group.id"] == "g"
    assert options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "10"


def test_topics_need_only_the_connector(spark, tmp_path):
    """No connector is installed here: every topic reader and writer gets as far as looking for it."""
    events = accepted(parse_events(messages_frame(spark, [message()])))
    attempts = [
        lambda: messages.read_kafka(spark, "host:1"),
        lambda: messages.stream_kafka(spark, "host:1", maxOffsetsPerTrigger="5"),
        lambda: sinks.read_aggregates_kafka(spark, "host:1"),
        lambda: sinks.publish_kafka(events, "host:1"),
        lambda: sinks.kafka_writer("host:1")(rows_frame(spark, 1), 0),
        lambda: sinks.kafka_writer("host:1", partitions=3)(rows_frame(spark, 1), 0),
    ]
    for attempt in attempts:
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            attempt()


def test_bad_aggregate_messages_are_kept_apart(spark):
    from tidegauge.operators.publish import read_aggregate_messages, rejected_aggregate_messages

    good = (
        '{"window_start":"10:00","window_end":"10:01","device_type":"a","avg_temperature":1.5,"median_humidity":null}'
    )
    partial = '{"window_start":"10:00","window_end":"10:01","device_type":"a"}'
    wrong = good.replace("1.5", '"warm"')
    df = spark.createDataFrame([(t,) for t in (good, "garbage", "", None, partial, wrong, "[1]")], "value STRING")
    assert [tuple(r) for r in read_aggregate_messages(df).collect()] == [("10:00", "10:01", "a", 1.5, None)]
    rejected = {r.value: r.reason for r in rejected_aggregate_messages(df).collect()}
    assert rejected == {
        "garbage": "malformed_json", "": "malformed_json", None: "malformed_json", "[1]": "malformed_json",
        wrong: "malformed_json", partial: "missing_avg_temperature",
    }


def test_no_batch_written_means_no_rows(spark, tmp_path):
    from tidegauge.sources.sinks import read_aggregates

    assert read_aggregates(spark, str(tmp_path / "none")).collect() == []
