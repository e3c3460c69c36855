"""Random messages against the standard library's JSON reader and numeric constructors."""

import json
import math
import random

from test_event_time import expected_millis
from test_parse import parse

VALUES = [
    "3", "-0", "0", "3.9", "-3.9", "1e1", "1E-2", "12345678901", "1e400", "true", "false", "null", "NaN", "Infinity",
    "-Infinity", '""', '" "', '"3"', '" 3\\t"', '"\\u0033"', '"+3"', '"-3.5"', '"1_000"', '"1__0"', '"_1"', '"1_"',
    '"1e5"', '"1e"', '".5"', '"5."', '"."', '"nan"', '"-NAN"', '"inf"', '"+Infinity"', '"infin"', '"1d"', '"0x10"',
    '"true"', '"None"', '"3 4"', "[]", "[3]", "{}", '{"a":1}', '"x"', '"é"', '"\\"NaN\\""', '"a,NaN,b"',
    "1.7976931348623157e308", "5e-324", "0.1", "25.31", "9007199254740993", "123456789012345678901234567890.5",
]
TIMES = ['"2026-06-02T16:54:10Z"', '"2026-06-02T16:54:10.123456+03:00"', '"2026-06-02"']
NAMES = ["device_id", "device_type_id", "event_time", "temperature", "humidity"]


def expected(text):
    """(type id, milliseconds, temperature, humidity), or None for a message that is to be rejected."""
    try:
        data = json.loads(text)
        data["device_id"]
        kind = int(data["device_type_id"])
        if not -(2**31) <= kind < 2**31:
            return None
        return kind, expected_millis(data["event_time"]), float(data["temperature"]), float(data["humidity"])
    except (ValueError, TypeError, KeyError, AttributeError, OverflowError):
        return None


def random_message(draw):
    fields = []
    for name in NAMES:
        if draw.random() < 0.03:
            continue
        if name == "event_time":
            value = draw.choice(TIMES if draw.random() < 0.95 else VALUES)
        elif name == "device_type_id":
            value = draw.choice(VALUES if draw.random() < 0.5 else ["1", "2", "3"])
        else:
            value = draw.choice(VALUES)
        fields.append((name, value))
    if draw.random() < 0.2:
        fields.append(("extra", draw.choice(VALUES)))
    if fields and draw.random() < 0.1:
        fields.append((draw.choice(fields)[0], draw.choice(VALUES)))
    draw.shuffle(fields)
    space = draw.choice(["", " ", "\n"])
    text = "{" + ("," + space).join(f'"{n}"{space}:{space}{v}' for n, v in fields) + space + "}"
    if draw.random() < 0.15:
        at = draw.randrange(len(text))
        text = text[:at] + draw.choice(["", "x", '"', "{", "}", ",", ":", "N", "\\", "]"]) + text[at + draw.randrange(2):]
    return text


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_random_messages_agree_with_the_standard_library(spark):
    draw = random.Random(20260602)
    texts = [random_message(draw) for _ in range(20_000)]
    wrong = []
    for text, row in zip(texts, parse(spark, texts)):
        wanted = expected(text)
        got = None
        if row["reject_reason"] is None:
            millis = round(row["event_time"].timestamp() * 1000)
            got = (row["device_type_id"], millis, row["temperature"], row["humidity"])
        if (got is None) != (wanted is None) or (got and not all(map(same, got, wanted))):
            wrong.append((text, wanted, row))
    assert sum(expected(t) is not None for t in texts) > 1000
    assert not wrong, (len(wrong), wrong[:10])
