import datetime as dt
import math
import random
import statistics
from collections import defaultdict

from conftest import message, messages_frame
from pyspark.sql import functions as F

from tidegauge.operators.windows import aggregate_rows, tumbling, value_counts, window_means, window_stats
from tidegauge.plans.sensor_stats import enriched_events, select_from_view, sensor_stats
from tidegauge.schemas import AGGREGATE_SCHEMA, DICTIONARY_SCHEMA
from tidegauge.sources.dictionary import snapshot


def stats(spark, dictionary, *events):
    return sorted(map(tuple, sensor_stats(messages_frame(spark, [message(**e) for e in events]), dictionary).collect()))


def at(text, **changes):
    return {"event_time": f'"{text}"', **changes}


def test_documented_sample(spark, device_types):
    rows = sensor_stats(messages_frame(spark, [message()]), device_types)
    assert rows.schema.simpleString() == AGGREGATE_SCHEMA.simpleString()
    assert [tuple(r) for r in rows.collect()] == [("16:54", "16:55", "weather_station", 25.31, 60.57)]


def test_odd_median(spark, device_types):
    [row] = stats(spark, device_types, *[{"humidity": h} for h in ("60", "61", "10")])
    assert row[4] == 60


def test_even_median_is_rounded_on_its_binary_value(spark, device_types):
    events = [{"humidity": h} for h in ("60.57", "61.0")]
    assert stats(spark, device_types, *events)[0][4] == round(60.785, 2)
    raw = window_stats(enriched_events(messages_frame(spark, [message(**e) for e in events]), device_types))
    assert raw.first()["median_humidity"] == 60.785


def test_rounding_ties(spark, device_types):
    assert stats(spark, device_types, {"temperature": "2.675", "humidity": "0.515"})[0][3:] == (2.67, 0.52)


def test_unknown_ids_are_one_group(spark, device_types):
    events = [{"device_type_id": "8", "humidity": "1"}, {"device_type_id": "9", "humidity": "3"}]
    rows = stats(spark, device_types, *events)
    assert rows == [("16:54", "16:55", "unknown_device_type", 25.31, 2.0)]


def test_ids_that_share_a_name_are_one_group(spark):
    shared = snapshot(spark.createDataFrame([(1, "same"), (2, "same")], DICTIONARY_SCHEMA))
    rows = stats(spark, shared, {"device_type_id": "1", "humidity": "1"}, {"device_type_id": "2", "humidity": "3"})
    assert rows == [("16:54", "16:55", "same", 25.31, 2.0)]


def test_midnight_labels(spark, device_types):
    assert stats(spark, device_types, at("2026-06-02T23:59:10Z"))[0][:2] == ("23:59", "00:00")


def test_same_minute_of_two_days_stays_two_rows(spark, device_types):
    events = [at("2026-06-02T16:54:10Z", humidity="1"), at("2026-06-03T16:54:10Z", humidity="2")]
    rows = stats(spark, device_types, *events)
    assert [(r[0], r[4]) for r in rows] == [("16:54", 1.0), ("16:54", 2.0)]


def test_offset_decides_the_window(spark, device_types):
    assert stats(spark, device_types, at("2026-06-02T19:54:10+03:00"))[0][0] == "16:54"


def test_window_is_closed_at_its_start_and_open_at_its_end(spark, device_types):
    rows = stats(spark, device_types, at("2026-06-02T16:54:00Z"), at("2026-06-02T16:54:59.999999Z"),
                 at("2026-06-02T16:55:00Z"))
    assert [r[0] for r in rows] == ["16:54", "16:55"]


def test_empty_minutes_give_no_rows(spark, device_types):
    rows = stats(spark, device_types, at("2026-06-02T16:50:00Z"), at("2026-06-02T16:59:00Z"))
    assert [r[0] for r in rows] == ["16:50", "16:59"]


def test_no_accepted_events_give_no_rows(spark, device_types):
    assert sensor_stats(messages_frame(spark, ["x", ""]), device_types).collect() == []


def test_nan_reading(spark, device_types):
    [row] = stats(spark, device_types, {"temperature": "NaN"}, {"temperature": "1"})
    assert math.isnan(row[3]) and row[4] == 60.57


def test_random_events_equal_brute_force(spark, device_types):
    draw = random.Random(11)
    names = {1: "temperature_sensor", 2: "humidity_sensor", 3: "weather_station", 4: "smart_thermostat",
             5: "air_quality_sensor"}
    start = dt.datetime(2026, 6, 2, 23, 30, tzinfo=dt.timezone.utc)
    events, groups = [], defaultdict(lambda: ([], []))
    for _ in range(3000):
        # A third of all events falls into one minute of one type.
        hot = draw.random() < 1 / 3
        when = start + dt.timedelta(seconds=draw.randrange(60) if hot else draw.randrange(3600 * 2))
        kind = 3 if hot else draw.randrange(7)
        t, h = round(draw.uniform(15, 35), 2), round(draw.uniform(30, 90), 2)
        events.append(at(when.isoformat(), device_type_id=str(kind), temperature=str(t), humidity=str(h)))
        group = groups[when.replace(second=0), names.get(kind, "unknown_device_type")]
        group[0].append(t)
        group[1].append(h)
    expected = sorted(
        (w.strftime("%H:%M"), (w + dt.timedelta(minutes=1)).strftime("%H:%M"), name,
         round(math.fsum(t) / len(t), 2), round(statistics.median(h), 2))
        for (w, name), (t, h) in groups.items()
    )
    enriched = enriched_events(messages_frame(spark, [message(**e) for e in events]).repartition(6), device_types)
    for limits in ({}, {"large_group": 50, "range_rows": 100}):
        assert sorted(map(tuple, aggregate_rows(window_stats(enriched, **limits)).collect())) == expected


def test_other_aggregates_per_window(spark, device_types):
    events = enriched_events(messages_frame(spark, [message(temperature=t) for t in ("1", "5")]), device_types)
    [row] = tumbling(events, "1 hour", F.max("temperature").alias("high"), F.count("*").alias("n")).collect()
    assert (row["device_type"], row["high"], row["n"]) == ("weather_station", 5.0, 2)


def test_copies_are_one_count(spark, device_types):
    events = enriched_events(messages_frame(spark, [message()] * 500), device_types)
    [row] = value_counts(events).collect()
    assert (row["n"], row["exact_sum"], row["float_sum"]) == (500, 500 * int(25.31 * 2**48) * 2**15, 0.0)


def test_means_of_large_and_fine_readings_are_exact(spark, device_types):
    """One minute with readings out of the ordinary range, one without."""
    draw = random.Random(5)
    first = [draw.choice([-1, 1]) * math.ldexp(1 + draw.random(), draw.randint(-300, 300)) for _ in range(60)]
    first += [-x for x in first[:20]]
    second = [round(draw.uniform(-50, 50), 2) for _ in range(60)]
    messages = [message(**at(f"2026-06-02T16:5{k}:10Z", temperature=repr(x))) for k, values in ((4, first), (5, second)) for x in values]
    events = enriched_events(messages_frame(spark, messages).repartition(5), device_types)
    expected = [math.fsum(values) / len(values) for values in (first, second)]
    for stats_of in (window_means, window_stats):
        rows = stats_of(events).orderBy("window_start").collect()
        assert [r["avg_temperature"] for r in rows] == expected
        assert [r["events"] for r in rows] == [80, 60]


def test_view_projection(spark, device_types):
    rows = select_from_view(sensor_stats(messages_frame(spark, [message()]), device_types))
    assert rows.columns == AGGREGATE_SCHEMA.names
    assert spark.sql("SELECT count(*) FROM iot_aggregates_view").first()[0] == 1
