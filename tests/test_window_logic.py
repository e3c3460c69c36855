import math
import random
import statistics
import sys

import pytest
from conftest import message

from pyspark import cloudpickle
from pyspark.sql.types import StructType

from tidegauge.operators.enrich import enrich
from tidegauge.operators.parse import accepted, parse_events
from tidegauge.sources.messages import stream_files
from tidegauge.sources.sinks import files_writer, read_aggregates
from tidegauge.streaming import window_logic

# The logic below travels to workers that do not know this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_mean_and_median_of_merged_parts():
    draw = random.Random(6)
    logic = window_logic.MeanAndMedian()
    for _ in range(300):
        n = draw.randint(1, 30)
        temperatures = [draw.choice([-1, 1]) * math.ldexp(1 + draw.random(), draw.randint(-60, 60)) for _ in range(n)]
        humidities = [float(draw.randint(0, 5)) for _ in range(n)]
        states = [logic.create() for _ in range(3)]
        for t, h in zip(temperatures, humidities):
            k = draw.randrange(3)
            states[k] = logic.add(states[k], t, h)
        state = logic.merge(states[0], logic.merge(states[2], states[1]))
        at = window_logic._utc(0)
        [row] = logic.finish("x", at, at, state)
        assert row[3:] == (round(math.fsum(temperatures) / n, 2), round(statistics.median(humidities), 2))


def test_special_readings():
    logic = window_logic.MeanAndMedian()
    state = logic.merge(logic.add(logic.create(), math.inf, 1.0), logic.add(logic.create(), 1.0, 2.0))
    [row] = logic.finish("x", window_logic._utc(0), window_logic._utc(60_000), state)
    assert row == ("00:00", "00:01", "x", math.inf, 1.5)


class Longest:
    """A logic of a test: the longest gap between readings that follow each other in size."""

    def create(self):
        return []

    def add(self, state, temperature, humidity):
        return [*state, temperature]

    def merge(self, state, other):
        return sorted(state + other)

    def finish(self, device_type, start, end, state):
        return [(device_type, max((b - a for a, b in zip(state, state[1:])), default=0.0))]


@pytest.fixture
def run(spark, device_types, tmp_path):
    (tmp_path / "messages").mkdir()

    def arrive(number, *texts, logic=None, rows=None, write=None):
        (tmp_path / "messages" / f"{number}.json").write_text("\n".join(texts))
        events = enrich(accepted(parse_events(stream_files(spark, str(tmp_path / "messages")))), device_types)
        more = {"logic": logic, "rows": rows} if logic else {}
        query = window_logic.start(
            spark, events, write or files_writer(str(tmp_path / "rows")), str(tmp_path / "checkpoint"), availableNow=True, **more
        )
        query.awaitTermination()
        return query, sorted(map(tuple, read_aggregates(spark, str(tmp_path / "rows")).collect()))

    return arrive


def at(text, **changes):
    return message(event_time=f'"2026-06-01T{text}Z"', **changes)


def test_windows_close_across_restarts_and_late_events_are_dropped(run, spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    other = ("23:58", "23:59", "unknown_device_type", 25.31, 60.57)
    closed = ("23:59", "00:00", "weather_station", 25.31, 2.0)
    first = [at("23:58:00", device_type_id="99"), at("23:59:04.999", humidity="1"), at("23:59:04.999", humidity="2")]
    assert run(1, *first)[1] == []
    assert run(2, at("23:59:59.999", humidity="3"))[1] == [other]
    assert run(3, message(event_time='"2026-06-02T00:00:05Z"'))[1] == [other, closed]
    assert run(4, at("23:59:58", humidity="9"))[1] == [other, closed]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_any_logic_and_schema(run, spark):
    seen = []

    def write(batch, batch_id):
        seen.extend(map(tuple, batch.collect()))

    texts = [at("10:00:10", temperature=t) for t in ("1", "9", "4.5")] + [at("10:05:00")]
    run(1, *texts, logic=Longest(), rows=StructType.fromDDL("device_type STRING, gap DOUBLE"), write=write)
    assert seen == [("weather_station", 4.5)]
