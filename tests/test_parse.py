import math

import pytest
from conftest import message, messages_frame

from tidegauge.operators.parse import accepted, parse_events, quarantined


def parse(spark, texts):
    """Parsed rows in the order of the texts."""
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, value STRING")
    return parse_events(frame).orderBy("i").collect()


KEPT = [
    ("device_type_id", "3", 3),
    ("device_type_id", '"3"', 3),
    ("device_type_id", '" 3 "', 3),
    ("device_type_id", '"+3"', 3),
    ("device_type_id", "3.9", 3),
    ("device_type_id", "-3.9", -3),
    ("device_type_id", "true", 1),
    ("device_type_id", "false", 0),
    ("device_type_id", "1e1", 10),
    ("device_type_id", '"1_0"', 10),
    ("device_type_id", "2147483647", 2147483647),
    ("temperature", '"25.31"', 25.31),
    ("temperature", "true", 1.0),
    ("temperature", "7", 7.0),
    ("temperature", '".5"', 0.5),
    ("temperature", '"5."', 5.0),
    ("temperature", '"-1_0.5e1"', -105.0),
    ("temperature", '"inf"', math.inf),
    ("temperature", '"-Infinity"', -math.inf),
    ("temperature", "Infinity", math.inf),
    ("temperature", "-Infinity", -math.inf),
    ("temperature", "1e400", math.inf),
    ("temperature", "12345678901234567890123456789012345678901234567890", 1.2345678901234567e49),
    ("device_id", '"x"', "x"),
    ("device_id", "null", "None"),
    ("device_id", "true", "True"),
    ("device_id", "7", "7"),
    ("device_id", '{"x":1}', '{"x":1}'),
]

REJECTED = [
    ({"device_type_id": '"3.0"'}, "bad_device_type_id"),
    ({"device_type_id": "null"}, "bad_device_type_id"),
    ({"device_type_id": None}, "missing_device_type_id"),
    ({"device_type_id": "3000000000"}, "bad_device_type_id"),
    ({"device_type_id": '"true"'}, "bad_device_type_id"),
    ({"device_type_id": "NaN"}, "bad_device_type_id"),
    ({"device_type_id": '"1__0"'}, "bad_device_type_id"),
    ({"device_type_id": '"_1"'}, "bad_device_type_id"),
    ({"device_type_id": '""'}, "bad_device_type_id"),
    ({"temperature": "null"}, "bad_temperature"),
    ({"temperature": "[1]"}, "bad_temperature"),
    ({"temperature": '"1d"'}, "bad_temperature"),
    ({"temperature": '"1f"'}, "bad_temperature"),
    ({"temperature": '"0x1p3"'}, "bad_temperature"),
    ({"temperature": '"true"'}, "bad_temperature"),
    ({"temperature": '"1_"'}, "bad_temperature"),
    ({"temperature": None}, "missing_temperature"),
    ({"humidity": "{}"}, "bad_humidity"),
    ({"humidity": None}, "missing_humidity"),
    ({"device_id": None}, "missing_device_id"),
    ({"event_time": "1780419250"}, "bad_event_time"),
    ({"event_time": "null"}, "bad_event_time"),
    ({"event_time": None}, "missing_event_time"),
    ({"event_time": None, "humidity": None}, "missing_event_time"),
]

MALFORMED = [
    ("not json", "malformed_json"),
    ("", "malformed_json"),
    (None, "malformed_json"),
    (message() + " x", "malformed_json"),
    (message() + "{}", "malformed_json"),
    (message() + "}", "malformed_json"),
    (message() + "," + message(), "malformed_json"),
    (message()[:-1], "malformed_json"),
    (message(extra="NaN1"), "malformed_json"),
    (message().replace('"humidity"', "NaN"), "malformed_json"),
    ("'" + message() + "'", "malformed_json"),
    ("[1,2]", "not_an_object"),
    ("[" + message() + "]", "not_an_object"),
    ("null", "not_an_object"),
    ('"text"', "not_an_object"),
    ("{}", "missing_event_time"),
]


def test_kept_values(spark):
    rows = parse(spark, [message(**{field: text}) for field, text, _ in KEPT])
    for (field, text, value), row in zip(KEPT, rows):
        assert row["reject_reason"] is None, (field, text, row)
        assert row[field] == value, (field, text, row)


@pytest.mark.parametrize("text", ["NaN", '"nan"', '"NaN"', '"-nan"', '" +NAN "'])
def test_not_a_number_is_kept(spark, text):
    [row] = parse(spark, [message(temperature=text)])
    assert row["reject_reason"] is None
    assert math.isnan(row["temperature"])


def test_rejected_fields(spark):
    rows = parse(spark, [message(**changes) for changes, _ in REJECTED])
    assert [r["reject_reason"] for r in rows] == [reason for _, reason in REJECTED]


def test_rejected_documents(spark):
    rows = parse(spark, [text for text, _ in MALFORMED])
    assert [r["reject_reason"] for r in rows] == [reason for _, reason in MALFORMED]


def test_bare_literals_inside_strings_stay_text(spark):
    text = message(device_id=r'"a \" , NaN, [NaN] \\"', temperature="NaN", extra="[NaN , -Infinity]")
    [row] = parse(spark, [text])
    assert row["reject_reason"] is None
    assert row["device_id"] == 'a " , NaN, [NaN] \\'
    assert math.isnan(row["temperature"])


def test_long_message_with_bare_literal(spark):
    extra = "[" + ",".join(['"s \\" NaN ,"'] * 50_000) + ",NaN]"
    [row] = parse(spark, [message(extra=extra, humidity="-Infinity")])
    assert row["reject_reason"] is None
    assert row["humidity"] == -math.inf


def test_long_rejected_message(spark):
    [row] = parse(spark, ["[" + '"NaN, ' * 200_000 + ",NaN]"])
    assert row["reject_reason"] == "malformed_json"


def test_repeated_key_last_wins_and_extra_key_is_ignored(spark):
    text = message(extra='{"temperature":1}')[:-1] + ',"temperature":9.5}'
    [row] = parse(spark, [text])
    assert (row["reject_reason"], row["temperature"]) == (None, 9.5)


def test_surrounding_whitespace_is_allowed(spark):
    [row] = parse(spark, [" \n" + message() + " \t\n"])
    assert row["reject_reason"] is None


def test_every_message_is_either_accepted_or_quarantined_whole(spark):
    texts = [message(), message(humidity=None), "x" * 100_000, None, message(), ""]
    parsed = parse_events(messages_frame(spark, texts))
    assert accepted(parsed).count() == 2
    assert accepted(parsed).columns == ["device_id", "device_type_id", "event_time", "temperature", "humidity"]
    rejected = {tuple(r) for r in quarantined(parsed).collect()}
    assert rejected == {
        (message(humidity=None), "missing_humidity"),
        ("x" * 100_000, "malformed_json"),
        (None, "malformed_json"),
        ("", "malformed_json"),
    }


def test_long_numerals_in_strings(spark):
    long = "1" + "_1" * 100_000
    rows = parse(spark, [message(temperature=f'"{long}"'), message(temperature=f'"0.{long}"'),
                         message(device_type_id=f'"{long}"'), message(temperature=f'"{long}_"')])
    assert [r["reject_reason"] for r in rows] == [None, None, "bad_device_type_id", "bad_temperature"]
    assert rows[0]["temperature"] == math.inf
    assert rows[1]["temperature"] == 1 / 9


def test_hostile_messages_never_fail_the_job(spark):
    texts = [
        "[" * 200_000,
        message(extra="[" * 5_000 + "]" * 5_000),
        message(extra='{"a":' * 5_000 + "1" + "}" * 5_000),
        message(temperature="1" * 100_000),
        message(temperature='"' + "1" * 100_000 + '"'),
        message(device_type_id="-" * 1000),
        message(device_id='"' + "x" * 30_000_000 + '"'),
        "{" + ",".join(f'"k{i}":NaN' for i in range(100_000)) + "}",
        message(device_id=r'"\ud800"'),
        message(event_time='"' + "Z" * 100_000 + '"'),
        message(event_time='"2026-06-02T16:54:10' + "0" * 100_000 + '"'),
        message(temperature='"' + " " * 100_000 + '1"'),
        "NaN" * 50_000,
        "\x00",
    ]
    reasons = [r["reject_reason"] for r in parse(spark, texts)]
    assert len(reasons) == len(texts)
    assert reasons[0] == "malformed_json"
    assert reasons[4] is None  # a finite text of many digits is an infinite reading
    assert reasons[5] == "malformed_json"
    assert reasons[7] == "missing_event_time"
    assert reasons[9] == reasons[10] == "bad_event_time"
    assert reasons[11] is None
    assert reasons[12] == reasons[13] == "malformed_json"
