import pytest
from conftest import message

from tidegauge import __main__ as command
from tidegauge.schemas import OUTPUT_TOPIC
from tidegauge.sources import dictionary, sinks
from tidegauge.sources.messages import kafka_options
from tidegauge.streaming import sensor_stream

BASE = ["stream", "--dictionary", "types", "--checkpoint", "check"]


def parsed(*arguments):
    return command.parser().parse_args([*BASE, *arguments])


def test_source_options_reach_the_reader():
    args = parsed(
        "--servers", "s:1", "--group", "g", "--starting", "latest", "--records-per-batch", "500",
        "--option", "kafka.security.protocol=SSL", "--option", "kafka.ssl.key=a=b",
    )
    assert kafka_options(args.servers, args.input_topic, **command.source_options(args)) == {
        "kafka.bootstrap.servers": "s:1", "subscribe": args.input_topic, "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "500", "kafka.security.protocol": "SSL", "kafka.ssl.key": "a=b",
    }
    assert command.source_options(parsed("--servers", "s:1")) == {"starting": "earliest"}


def test_output_options_reach_the_writer(monkeypatch):
    seen = []
    monkeypatch.setattr(sinks, "kafka_writer", lambda *a, **k: seen.append((a, k)))
    command._writer(parsed("--servers", "s:1", "--output-partitions", "6", "--option", "kafka.a=b"))
    assert seen == [(("s:1", OUTPUT_TOPIC, 6), {"kafka.a": "b"})]


def test_needed_arguments():
    for arguments in (["stream"], ["load-dictionary"], ["read", "--dictionary", "d"]):
        with pytest.raises(SystemExit):
            command.parser().parse_args(arguments)


def test_from_folder_to_folder_with_rejected_messages_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [
        message(event_time='"2026-06-01T23:59:10Z"', humidity="1"), "broken",
        message(event_time='"2026-06-01T23:59:20Z"', humidity="3"), message(event_time='"2026-06-02T00:00:05Z"'),
    ]
    (tmp_path / "in" / "1.json").write_text("\n".join(texts) + "\n")
    dictionary.replace_table(dictionary.default_device_types(spark), str(tmp_path / "types"))
    command.stream(spark, command.parser().parse_args([
        "stream", "--dictionary", str(tmp_path / "types"), "--checkpoint", str(tmp_path / "check"),
        "--input-folder", str(tmp_path / "in"), "--output-folder", str(tmp_path / "out"),
        "--split", str(tmp_path / "split"), "--output-partitions", "2", "--once",
    ]))
    rows = sinks.read_aggregates(spark, str(tmp_path / "out")).collect()
    assert [tuple(r) for r in rows] == [("23:59", "00:00", "weather_station", 25.31, 2.0)]
    rejected = sensor_stream.read_rejected(spark, str(tmp_path / "split")).collect()
    assert [tuple(r) for r in rejected] == [("broken", "malformed_json")]
