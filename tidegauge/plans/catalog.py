"""One runnable query per operator, each over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.event_time import event_time_millis, minute_label, parse_event_times
from tidegauge.functions.numeric import round2
from tidegauge.operators.enrich import enrich
from tidegauge.operators.parse import accepted, parse_events, quarantined
from tidegauge.operators.publish import event_json, event_messages, round_robin
from tidegauge.operators.windows import aggregate_rows, tumbling, window_means, window_stats
from tidegauge.plans.event_table import (
    damaged_messages,
    read_dictionary,
    read_events,
    region_dictionary,
    stream_events,
    to_events,
    to_messages,
)
from tidegauge.plans.sensor_stats import select_from_view, sensor_stats
from tidegauge.session import configure, shared_folder, written
from tidegauge.sources import archive, versions
from tidegauge.sources.dictionary import problems, read_table, replace_table, snapshot
from tidegauge.sources.messages import decode_value, stream_files
from tidegauge.sources.sinks import files_writer, read_aggregates
from tidegauge.streaming import arrivals, refreshed, sensor_stream, window_logic
from tidegauge.streaming.progress import DeliveryTotals
from tidegauge.streaming.state import open_windows

Query = Callable[[SparkSession, str], DataFrame]


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(to_events(read_events(spark, folder)), region_dictionary(spark, folder))


def _with_millis(df: DataFrame) -> DataFrame:
    return df.select(
        *[event_time_millis(F.col(c)).alias("event_time_ms") if c == "event_time" else c for c in df.columns]
    )


def _window_in_millis(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.unix_millis(c) for c in ("window_start", "window_end")})


# Messages

def publish_events(spark, folder):
    return event_messages(to_events(read_events(spark, folder)))


def decode_values(spark, folder):
    records = publish_events(spark, folder).withColumn("value", F.encode("value", "UTF-8"))
    return decode_value(records)


def parsed_events(spark, folder):
    return _with_millis(accepted(parse_events(to_messages(read_events(spark, folder)))))


def drop_malformed(spark, folder):
    parsed = parse_events(damaged_messages(read_events(spark, folder)))
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return parsed.groupBy(outcome).agg(F.count("*").alias("messages"))


def quarantine_messages(spark, folder):
    return quarantined(parse_events(damaged_messages(read_events(spark, folder))))


def quarantine_stream(spark, folder):
    """The rejected part of a stream that parses each message once for both outcomes."""
    out = shared_folder(spark)
    messages = damaged_messages(stream_events(spark, folder))
    sensor_stream.start_split(messages, f"{out}/split", f"{out}/checkpoint", availableNow=True).awaitTermination()
    return sensor_stream.read_rejected(spark, f"{out}/split")


def coerced_fields(spark, folder):
    """Numbers written as JSON strings, fractions, exponents and booleans, in turn by event id."""
    events = to_events(read_events(spark, folder), "event_id")
    turn = F.col("event_id") % 5
    type_id = F.col("device_type_id").cast("string")
    reading = F.col("temperature").cast("string")
    written_id = (
        F.when(turn == 0, F.concat(F.lit('" '), type_id, F.lit(' "')))
        .when(turn == 1, F.concat(type_id, F.lit(".9")))
        .when(turn == 2, "true")
        .when(turn == 3, F.concat(type_id, F.lit("e0")))
        .otherwise(F.concat(F.lit('"1_'), type_id, F.lit('"')))
    )
    written_reading = (
        F.when(turn == 0, F.concat(F.lit('"'), reading, F.lit('"')))
        .when(turn == 1, "true")
        .when(turn == 2, F.concat(F.lit('" '), reading, F.lit('e1"')))
        .when(turn == 3, F.concat(reading, F.lit("e2")))
        .otherwise(reading)
    )
    message = F.format_string(
        '{"device_id":%s,"device_type_id":%s,"event_time":"2024-01-01T00:00:00Z","temperature":%s,"humidity":1}',
        F.col("device_id"), written_id, written_reading,
    )
    parsed = parse_events(events.select("event_id", message.alias("value")))
    return parsed.select("event_id", "device_id", "device_type_id", "temperature", "reject_reason")


def event_time_formats(spark, folder):
    """Each event's time written in one of six accepted ways, read back as milliseconds."""
    at = F.col("ts").cast("timestamp")
    turn = F.col("event_id") % 6
    shifted = at + F.expr("INTERVAL '20:30' HOUR TO MINUTE")
    text = (
        F.when(turn == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(turn == 1, F.date_format(shifted, "yyyy-MM-dd HH:mm:ss.SSS'+20:30'"))
        .when(turn == 2, F.date_format(at, "yyyy-MM-dd_HH:mm:ss"))
        .when(turn == 3, F.date_format(at, "yyyy-MM-dd'T'HH:mm'+00:00'"))
        .when(turn == 4, F.date_format(at, "yyyy-MM-dd'T'HH"))
        .otherwise(F.date_format(at, "yyyy-MM-dd"))
    )
    texts = read_events(spark, folder).select("event_id", text.alias("text"))
    return _with_millis(parse_event_times(texts, "text"))


# Dictionary and lookup

def lookup_join(spark, folder):
    return _with_millis(_enriched(spark, folder))


def lookup_join_shuffled(spark, folder):
    """The same lookup as for a dictionary too large to broadcast."""
    dictionary = region_dictionary(spark, folder, broadcast_rows=0)
    return _with_millis(enrich(to_events(read_events(spark, folder)), dictionary))


def unknown_bucket(spark, folder):
    return _enriched(spark, folder).groupBy("device_type").agg(F.count("*").alias("events"))


def dictionary_roundtrip(spark, folder):
    path = shared_folder(spark)
    replace_table(read_dictionary(spark, folder), path)
    return read_table(spark, path)


def dictionary_snapshot(spark, folder):
    """The dictionary table is renamed after the snapshot; the lookup keeps the old names."""
    path = shared_folder(spark)
    names = read_dictionary(spark, folder)
    replace_table(names, path)
    dictionary = snapshot(read_table(spark, path))
    replace_table(names.withColumn("type_name", F.lower("type_name")), path)
    events = enrich(to_events(read_events(spark, folder)), dictionary)
    return events.groupBy("device_type").agg(F.count("*").alias("events"))


def shared_type_name(spark, folder):
    """Two ids under one name are one group."""
    names = read_dictionary(spark, folder).withColumn(
        "type_name", F.when(F.col("id") <= 1, "SHARED").otherwise(F.col("type_name"))
    )
    events = enrich(to_events(read_events(spark, folder)), snapshot(names))
    return aggregate_rows(window_stats(events, "1 hour"))


# Windows and aggregates

def tumbling_avg(spark, folder):
    return _window_in_millis(window_means(_enriched(spark, folder)))


def mean_of_all_magnitudes(spark, folder):
    """Mean of readings of one type in a day that lie up to 800 binades apart, with both signs."""
    number = F.col("event_id")
    power = F.pow(F.lit(2.0), 100 * (number % 9) - 400)
    sign = F.when(number % 2 == 0, 1).otherwise(-1)
    scaled = to_events(read_events(spark, folder), "event_id").withColumn("temperature", F.col("temperature") * power * sign)
    means = window_means(enrich(scaled, region_dictionary(spark, folder)), "1 day")
    return _window_in_millis(means).select("window_start", "device_type", "events", "avg_temperature")


def tumbling_median(spark, folder):
    stats = window_stats(_enriched(spark, folder), "1 hour")
    return _window_in_millis(stats).select("window_start", "window_end", "device_type", "events", "median_humidity")


def median_large_groups(spark, folder):
    """Median reading of 30-day windows, with limits so low that every group is split by value range."""
    readings = _enriched(spark, folder).withColumn("humidity", F.col("temperature"))
    stats = window_stats(readings, "30 days", large_group=50, range_rows=2000)
    return _window_in_millis(stats).select("window_start", "window_end", "device_type", "events", "median_humidity")


def window_labels(spark, folder):
    minutes = tumbling(to_events(read_events(spark, folder)), "1 minute", F.count("*").alias("events"), keys=())
    return minutes.select(
        F.unix_millis("window_start").alias("window_start_ms"),
        minute_label(F.col("window_start")).alias("window_start"),
        minute_label(F.col("window_end")).alias("window_end"),
        "events",
    )


def round2_values(spark, folder):
    """Every reading divided by eight: many lie exactly, or almost, between two hundredths."""
    return read_events(spark, folder).select("event_id", round2(F.col("value") / 8).alias("rounded"))


# The whole job

def window_stats_minute(spark, folder):
    """Flagship: JSON messages in, labelled and rounded minute statistics out."""
    return sensor_stats(to_messages(read_events(spark, folder)), region_dictionary(spark, folder))


def window_stats_hour(spark, folder):
    return sensor_stats(to_messages(read_events(spark, folder)), region_dictionary(spark, folder), "1 hour")


def sql_projection(spark, folder):
    rows = aggregate_rows(window_stats(_enriched(spark, folder), "1 hour"))
    return select_from_view(rows)


def aggregates_written(spark, folder):
    """The flagship rows written as JSON lines into four files in turn, and read back."""
    path = shared_folder(spark)
    files_writer(path, files=4)(window_stats_minute(spark, folder), 0)
    return read_aggregates(spark, path)


def round_robin_partitions(spark, folder):
    """Partition numbers dealt out to all event messages in seven tasks, how many messages got one, and whether evenly."""
    events = to_events(read_events(spark, folder)).select(event_json().alias("value"))
    dealt = round_robin(written(events.repartition(7, "value")), 4)
    counts = dealt.groupBy("partition").agg(F.count("*").alias("n"))
    even = F.max("n") - F.min("n") <= 1
    return counts.agg(F.count("*").alias("partitions"), F.sum("n").alias("messages"), even.alias("even"))


def window_stats_stream(spark, folder):
    out = shared_folder(spark)
    sensor_stream.start(
        to_messages(stream_events(spark, folder)),
        region_dictionary(spark, folder),
        files_writer(f"{out}/rows"),
        f"{out}/checkpoint",
        availableNow=True,
    ).awaitTermination()
    return read_aggregates(spark, f"{out}/rows")


def _run_arrivals(spark, folder, arrivals):
    """Append each arrival to a folder and run the job on it, stopping it in between."""
    out = shared_folder(spark)
    dictionary = region_dictionary(spark, folder)
    for arrival in arrivals:
        to_messages(arrival).write.mode("append").text(f"{out}/messages")
        sensor_stream.start(
            stream_files(spark, f"{out}/messages"),
            dictionary,
            files_writer(f"{out}/rows"),
            f"{out}/checkpoint",
            availableNow=True,
        ).awaitTermination()
    return read_aggregates(spark, f"{out}/rows")


def late_rows_dropped(spark, folder):
    """Every fifth event arrives after all others, when nearly all windows are closed."""
    events = read_events(spark, folder)
    late = F.col("event_id") % 5 == 0
    return _run_arrivals(spark, folder, [events.where(~late), events.where(late)])


def restart_no_duplicates(spark, folder):
    """Three arrivals, each a third of the time the events span, with a restart from the checkpoint before each."""
    events = read_events(spark, folder)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    third = F.floor((at - F.lit(first)) * 3 / F.lit(max(1, last - first + 1)))
    return _run_arrivals(spark, folder, [events.where(third == k) for k in range(3)])


def stream_delivery_report(spark, folder):
    """Counters of a streaming run over damaged messages: read, rejected, late, and rows written."""
    out = shared_folder(spark)
    rows_of_batches = []
    with DeliveryTotals(spark) as deliveries:
        query = sensor_stream.start(
            damaged_messages(stream_events(spark, folder)),
            region_dictionary(spark, folder),
            files_writer(f"{out}/rows"),
            f"{out}/checkpoint",
            on_written=lambda batch_id, rows: rows_of_batches.append(rows),
            availableNow=True,
        )
        totals = deliveries.wait(query) | {"rows_written": sum(rows_of_batches)}
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{name} LONG" for name in totals))


def window_logic_stream(spark, folder):
    """Mean and median as a user's own logic, with a state and a timer per window and type."""
    out = shared_folder(spark)
    events = enrich(to_events(stream_events(spark, folder)), region_dictionary(spark, folder))
    window_logic.start(
        spark, events, files_writer(f"{out}/rows"), f"{out}/checkpoint", availableNow=True
    ).awaitTermination()
    return read_aggregates(spark, f"{out}/rows")


def windows_left_open(spark, folder):
    """The hours that a job which waits three days for late events has not closed at the end of the table."""
    out = shared_folder(spark)
    sensor_stream.start(
        to_messages(stream_events(spark, folder)),
        region_dictionary(spark, folder),
        files_writer(f"{out}/rows"),
        f"{out}/checkpoint",
        size="1 hour",
        delay="3 days",
        availableNow=True,
    ).awaitTermination()
    return _window_in_millis(open_windows(spark, f"{out}/checkpoint"))


def _taken_in(spark, folder):
    """Two arrivals of messages, the second of every fifth event after all others."""
    out = shared_folder(spark)
    events = read_events(spark, folder)
    late = F.col("event_id") % 5 == 0
    for arrival in (events.where(~late), events.where(late)):
        damaged_messages(arrival).write.mode("append").text(f"{out}/messages")
        arrivals.start(
            stream_files(spark, f"{out}/messages"), f"{out}/taken", f"{out}/checkpoint", availableNow=True
        ).awaitTermination()
    return f"{out}/taken"


def late_events(spark, folder):
    """Every event that came after its window had closed, and how late it was."""
    late = arrivals.read(spark, _taken_in(spark, folder), arrivals.LATE)
    return _with_millis(late.select("device_id", "event_time", "temperature", "batch", "late_by_ms"))


def batch_receipts(spark, folder):
    """What each batch says it has written, and what is found of it."""
    found = arrivals.verified_receipts(spark, _taken_in(spark, folder))
    return found.groupBy("batch", "outcome").agg(
        F.sum("rows").alias("rows"),
        F.sum("readable").alias("readable"),
        F.unix_millis(F.min("oldest")).alias("oldest_ms"),
        F.unix_millis(F.max("newest")).alias("newest_ms"),
    )


def dictionary_refresh(spark, folder):
    """Two arrivals of events; between them the dictionary is replaced by one with lower-case names."""
    out = shared_folder(spark)
    names = read_dictionary(spark, folder)
    events = read_events(spark, folder)
    for k, dictionary in enumerate((names, names.withColumn("type_name", F.lower("type_name")))):
        versions.replace(dictionary, f"{out}/dictionary")
        events.where(F.col("event_id") % 2 == k).write.mode("append").parquet(f"{out}/events")
        arrived = spark.readStream.schema(events.schema).parquet(f"{out}/events")
        refreshed.start(
            to_events(arrived), f"{out}/dictionary", f"{out}/named", f"{out}/checkpoint", availableNow=True
        ).awaitTermination()
    named = refreshed.read(spark, f"{out}/named")
    return named.groupBy("batch", "version", "device_type").agg(F.count("*").alias("events"))


def dictionary_problems(spark, folder):
    """Events taken for a dictionary, with ids and names that it must not have: what is refused, and why."""
    number = F.col("event_id")
    source = read_events(spark, folder).select(
        F.when(number % 11 != 0, F.when(number % 7 == 0, number - 1).otherwise(number)).alias("id"),
        F.when(number % 13 != 0, F.repeat(F.lit("n"), F.when(number % 17 == 0, 101).otherwise(100))).alias("type_name"),
    )
    return problems(source)


def archived_ranges(spark, folder):
    """Events kept as a topic of four partitions, read up to a position of each, and from there on."""
    path = shared_folder(spark)
    events = read_events(spark, folder)
    number = F.col("event_id")
    records = to_events(events, "event_id").select(
        F.col("device_id").alias("key"), event_json().alias("value"), (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).alias("offset"), F.col("event_time").alias("timestamp"),
    )
    archive.append(records, path)
    last = events.agg(F.max("event_id")).first()[0] or 0
    # Partition 2 has no position of its own: all of it comes before.
    turn = {p: last // (8 + 4 * p) for p in (0, 1, 3)}
    before = archive.read(spark, path, ending=turn).withColumn("side", F.lit("before"))
    after = archive.read(spark, path, starting=turn).withColumn("side", F.lit("after")).where("partition != 2")
    messages = before.unionByName(after)
    size = F.sum(F.octet_length("value")).alias("value_bytes")
    return messages.groupBy("side", "partition").agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), size
    )


QUERIES: dict[str, Query] = {
    "publish_events": publish_events,
    "decode_values": decode_values,
    "parse_events": parsed_events,
    "drop_malformed": drop_malformed,
    "quarantine_messages": quarantine_messages,
    "quarantine_stream": quarantine_stream,
    "coerced_fields": coerced_fields,
    "event_time_formats": event_time_formats,
    "lookup_join": lookup_join,
    "lookup_join_shuffled": lookup_join_shuffled,
    "unknown_bucket": unknown_bucket,
    "dictionary_roundtrip": dictionary_roundtrip,
    "dictionary_snapshot": dictionary_snapshot,
    "shared_type_name": shared_type_name,
    "tumbling_avg": tumbling_avg,
    "mean_of_all_magnitudes": mean_of_all_magnitudes,
    "tumbling_median": tumbling_median,
    "median_large_groups": median_large_groups,
    "window_labels": window_labels,
    "round2_values": round2_values,
    "window_stats_minute": window_stats_minute,
    "window_stats_hour": window_stats_hour,
    "sql_projection": sql_projection,
    "read_aggregates": aggregates_written,
    "round_robin_partitions": round_robin_partitions,
    "window_stats_stream": window_stats_stream,
    "late_rows_dropped": late_rows_dropped,
    "restart_no_duplicates": restart_no_duplicates,
    "stream_delivery_report": stream_delivery_report,
    "window_logic_stream": window_logic_stream,
    "windows_left_open": windows_left_open,
    "late_events": late_events,
    "batch_receipts": batch_receipts,
    "dictionary_refresh": dictionary_refresh,
    "dictionary_problems": dictionary_problems,
    "archived_ranges": archived_ranges,
}


def runnable(query: Query) -> Query:
    """The query under the session settings its results depend on."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(configure(spark), folder)

    return run
